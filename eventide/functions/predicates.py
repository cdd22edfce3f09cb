"""Search-style predicates as Column builders.

They are ordinary Catalyst expressions, so simple ones (equality, ranges,
NULL tests) are pushed into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _with_negation(pred: Column, negation: Column) -> Column:
    """Remember how to negate ``pred`` in a form the scan can push down; a NULL
    field satisfies the negation."""
    pred.__dict__["negation"] = negation
    return pred


def term(col: Column | str, value) -> Column:
    """Exact equality on an un-analysed field (F1); nothing equals NULL."""
    c = _c(col)
    if isinstance(value, Column):
        return c == value
    if value is None:
        return _with_negation(F.lit(False), F.lit(True))
    return _with_negation(c == F.lit(value), c.isNull() | (c != F.lit(value)))


def terms(col: Column | str, values: Iterable) -> Column:
    """Equality with any of a list of values (F9 ``include``); a NULL in the
    list equals nothing, so it neither adds rows nor takes any from ``must_not``."""
    c = _c(col)
    values = list(values)
    if any(isinstance(v, Column) for v in values):
        return c.isin(values)
    values = [v for v in values if v is not None]
    if not values:
        return _with_negation(F.lit(False), F.lit(True))
    pred = c.isin(values)
    return _with_negation(pred, c.isNull() | ~pred)


def range_between(col: Column | str, lo=None, hi=None) -> Column:
    """Range with both ends inclusive (F6); an open end is ``None``."""
    c = _c(col)
    out = c.isNull()
    if lo is not None:
        out = out | (c < F.lit(lo))
    if hi is not None:
        out = out | (c > F.lit(hi))
    if lo is not None and hi is not None:
        return _with_negation(c.between(F.lit(lo), F.lit(hi)), out)
    if lo is not None:
        return _with_negation(c >= F.lit(lo), out)
    if hi is not None:
        return _with_negation(c <= F.lit(hi), out)
    return _with_negation(c.isNotNull(), out)


def exists(col: Column | str) -> Column:
    """Field present (F7).  An empty string counts as present."""
    return _with_negation(_c(col).isNotNull(), _c(col).isNull())


def match_all() -> Column:
    """No restriction (F8)."""
    return F.lit(True)


def must(*preds: Column) -> Column:
    """All clauses hold (F3, F5): plain conjunction, so that each clause can
    reach the scan.  A NULL clause makes it NULL or false, which a filter
    rejects alike."""
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def must_not(*preds: Column) -> Column:
    """No clause holds (F4).  A row lacking the field (NULL) satisfies it.
    Clauses built in this module are negated in a form the scan can take."""
    if not preds:
        return F.lit(True)
    return reduce(lambda a, b: a & b, [p.__dict__.get("negation", ~F.coalesce(p, F.lit(False))) for p in preds])


def bool_query(must_: Iterable[Column] = (), must_not_: Iterable[Column] = (),
               filter_: Iterable[Column] = ()) -> Column:
    """Boolean query: ``must`` and ``filter`` are ANDed, ``must_not`` negated."""
    clauses = [*must_, *filter_]
    parts = ([must(*clauses)] if clauses else []) + ([must_not(*must_not_)] if must_not_ else [])
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)
