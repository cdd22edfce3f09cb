"""Fill-in-the-middle transformation with a piece table.

A document is never copied while it is rearranged.  It starts as one
descriptor ``(buffer, start, length)`` over its immutable text; cutting splits
descriptors, sentinels are descriptors over a second immutable buffer, and an
arrangement is a permutation of descriptors.  The output is the buffers' spans
read in table order; digests take them span by span.  The way back needs only
the output and its form: the output becomes the text buffer of a new table, is
cut at its sentinels, and the inverse permutation puts the parts in order.

Every row is handled alone, so the work is one pass without a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_by_value, slices, table

ship_by_value()

SEED = 1
RATE = 90               # of 100 documents, so many are rearranged
SPM = 20                # of 100 of these, so many with the suffix first
SENTINELS = ("<P>", "<S>", "<M>")
BLOCK = 1 << 20         # code points encoded at a time

TEXT, MARKS = 0, 1      # the buffers
# Table order of (prefix, middle, suffix) behind their sentinels, and its inverse.
ORDER = {"psm": (0, 2, 1), "spm": (2, 0, 1)}


class PieceTable:
    """Descriptors ``(buffer, start, length)`` in code points over immutable
    strings; no method copies text but ``text()``, which makes the output."""

    def __init__(self, text: str, marks: str = ""):
        self.buffers = (text, marks)
        self.rows = [(TEXT, 0, len(text))]

    def cut(self, *at: int) -> None:
        """Split so that a descriptor starts at each position ``at`` (ascending)
        of the table's contents; descriptors of length 0 are kept apart."""
        out, pos, todo = [], 0, list(at)
        for buffer, start, length in self.rows:
            end = pos + length
            while todo and todo[0] <= end:
                size = todo.pop(0) - pos
                out.append((buffer, start, size))
                start, pos = start + size, pos + size
            out.append((buffer, start, end - pos))
            pos = end
        self.rows = out

    def permute(self, order: tuple[int, ...]) -> None:
        """Row ``order[k]`` becomes row ``k``; rows that are not named go."""
        self.rows = [self.rows[k] for k in order]

    def insert(self, row: int, start: int, length: int) -> None:
        """A span of the sentinel buffer before descriptor ``row``."""
        self.rows.insert(row, (MARKS, start, length))

    def blocks(self) -> Iterator[bytes]:
        """The contents in UTF-8, a bounded block at a time."""
        for buffer, start, length in self.rows:
            for lo in range(start, start + length, BLOCK):
                yield self.buffers[buffer][lo:min(lo + BLOCK, start + length)].encode()

    def sha256(self) -> str:
        h = hashlib.sha256()
        for block in self.blocks():
            h.update(block)
        return h.hexdigest()

    def text(self) -> str:
        return "".join(self.buffers[b][s:s + n] for b, s, n in self.rows)


def inverse(order: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(sorted(range(len(order)), key=order.__getitem__))


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers below 2**32 from the seed and the decimal id (null: no digits)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]


def arrange(doc_id: int | None, text: str, seed: int = SEED, rate: int = RATE, spm: int = SPM,
            sentinels: tuple[str, str, str] = SENTINELS) -> tuple[PieceTable, str, int | None, int | None]:
    """The table of one document, its form, and the lengths of prefix and middle."""
    marks, n = "".join(sentinels), len(text)
    out = PieceTable(text, marks)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= rate or any(m in text for m in sentinels):
        return out, "plain", None, None
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    form = "spm" if h4 % 100 < spm else "psm"
    out.cut(lo, hi)
    out.permute(ORDER[form])
    at = {0: (0, len(sentinels[0])), 2: (len(sentinels[0]), len(sentinels[1])),
          1: (len(sentinels[0]) + len(sentinels[1]), len(sentinels[2]))}      # the sentinel of each part
    for k in (2, 1, 0):
        out.insert(k, *at[ORDER[form][k]])
    return out, form, lo, hi - lo


def restore(output: str, form: str, sentinels: tuple[str, str, str] = SENTINELS) -> PieceTable:
    """The table of the text that ``arrange`` was given, from its output alone."""
    back = PieceTable(output)
    if form == "plain":
        return back
    marks = dict(zip((0, 2, 1), sentinels))     # the sentinel before each part
    at, where = 0, []
    for part in ORDER[form]:
        at = output.index(marks[part], at)
        where += [at, at + len(marks[part])]
        at = where[-1]
    back.cut(*where)                            # empty, mark, part, mark, part, mark, part
    back.permute((2, 4, 6))
    back.permute(inverse(ORDER[form]))
    return back


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE,
                spm: int = SPM, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output, output_sha256)``
    per row, ``n`` the text's code points.

    Null texts are empty; empty texts and texts that contain a sentinel are
    plain: the text itself, part lengths null.  Null ids draw from the seed
    alone.  Repeated rows are transformed alike; cuts that tie give an empty
    middle; other columns, whatever their names, are ignored; an empty table
    gives no rows.  Very long texts are cut by position like any other: the
    table holds seven descriptors at most, and digests encode a block of
    ``BLOCK`` code points at a time.  Sentinels must not be empty, contain one
    another, or begin as they end (a part's last characters and its sentinel
    could then be misread).
    """
    for i, a in enumerate(sentinels):
        if not a or any(a in b for j, b in enumerate(sentinels) if j != i) or any(a.startswith(a[k:]) for k in range(1, len(a))):
            raise ValueError(f"{a!r} can't be a sentinel beside {sentinels}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for b in slices(batches):
            out = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                pieces, form, prefix, middle = arrange(doc, text or "", seed, rate, spm, sentinels)
                out.append((doc, len(text or ""), form, prefix, middle, pieces.text(), pieces.sha256()))
            cols = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string"))


def restored(rows: DataFrame, sentinels: tuple[str, str, str] = SENTINELS, digest_only: bool = False) -> DataFrame:
    """``rows`` of :func:`fill_middle` (its columns ``output`` and ``form`` are
    read) with ``restored_sha256`` and, unless ``digest_only``, the text
    ``restored`` in place of ``output``.  Null outputs are empty."""
    keep = [f for f in rows.schema.fields if f.name not in ("output", "restored", "restored_sha256")]
    at = [rows.columns.index(f.name) for f in keep]
    i, j = rows.columns.index("output"), rows.columns.index("form")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            back = [restore(o or "", f, sentinels) for o, f in zip(b.column(i).to_pylist(), b.column(j).to_pylist())]
            new = {"restored_sha256": pa.array([t.sha256() for t in back], pa.string())}
            if not digest_only:
                new["restored"] = pa.array([t.text() for t in back], pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in at), *new.values()], [*(f.name for f in keep), *new])

    added = ["restored_sha256"] if digest_only else ["restored_sha256", "restored"]
    return rows.mapInArrow(run, T.StructType([*keep, *(T.StructField(a, T.StringType()) for a in added)]))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rearranged, and restored from its output; digests of both."""
    rows = fill_middle(table(spark, sf_dir, "documents", "doc_id", "text"))
    return restored(rows, digest_only=True).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


ORACLE = """
with t as (
    select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n, sha256('1:' || doc_id) as d
    from documents),
h as (
    select doc_id, text, n, ('0x' || d[1:8])::bigint as h1, ('0x' || d[9:16])::bigint as h2,
           ('0x' || d[17:24])::bigint as h3, ('0x' || d[25:32])::bigint as h4
    from t),
c as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
           case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
                when h4 % 100 < 20 then 'spm' else 'psm' end as form
    from h),
p as (
    select *, substring(text, 1, a) as pre, substring(text, a + 1, b - a) as mid, substring(text, b + 1, n - b) as suf
    from c)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
                        else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
       sha256(text) as restored_sha256
from p
"""
