"""Secret scans: three fixed patterns, and a randomness test battery with
length-aware false-discovery control for strings no pattern names.

Every run of 20 or more key characters is a candidate, and so is every part of
20 or more that is left of it between slashes, between the separators of one
base64 alphabet or the other, or between all of them: keys stand in URLs and
paths.  From its characters an encoding is inferred (hex, base32, one-case letters, letters and digits,
base64), and over that alphabet three tests ask how far it is from a uniform
random string: chi-squared of the symbol counts, Wald-Wolfowitz runs above and
below the middle symbol, and lag-1 serial correlation.  Fisher's sum joins
them to one p-value of randomness.  Short strings pass such tests easily, so
what also counts is how rarely ordinary text of the same length does as well:
the letters of every document, cut into stretches of each of the candidate
lengths, give that null distribution (a length with fewer than LEAST stretches
is made up to it from a fixed one: letters drawn by their frequency in English,
which look more random than text does), and Benjamini-Hochberg over all candidates sets the
cut for each alphabet and length.  Only histograms of fixed size leave the scan.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, ship_by_value, slices, table

ship_by_value()

KINDS = ("assign", "access", "hex", "random")
FALSE_DISCOVERY = 0.05
LENGTHS = (20, 28, 40, 56, 80)      # least lengths of the length classes
GROUPS = (16, 26, 32, 36, 64)       # alphabet sizes; 62 counts as 64
CELLS = 48                          # of -log10 of the randomness p-value, a quarter each
RANDOM = 12                         # cells in which the battery itself does not reject randomness (p >= 0.001)
HISTOGRAM = len(GROUPS) * len(LENGTHS) * CELLS
LEAST = 20_000                      # stretches of ordinary text behind the p-values of a length class
# Per 10,000 letters of English text, a to z.
FREQUENCIES = (820, 150, 280, 430, 1270, 220, 200, 610, 700, 15, 77, 400, 240, 670, 750, 190, 10, 600, 630, 910, 280, 98, 240, 15, 200, 7)
MARK = "[SECRET]"

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
_PARTS = tuple(re.compile(f"[^{c}]{{20,}}") for c in ("/", "+/", "_-", "+/_-"))
_ALPHABETS = tuple((re.compile(f"[{c}]+"), len(a), {ord(x): i for i, x in enumerate(a)}) for c, a in (
    ("0-9a-f", "0123456789abcdef"), ("0-9A-F", "0123456789ABCDEF"),
    ("A-Z2-7", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), ("a-z", "abcdefghijklmnopqrstuvwxyz"),
    ("a-z0-9", "0123456789abcdefghijklmnopqrstuvwxyz"), ("A-Z0-9", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("A-Za-z0-9", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("A-Za-z0-9+/", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("A-Za-z0-9_-", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_")))
_NO_LETTERS = bytes(x for x in range(256) if not (97 <= x < 123 or 65 <= x < 91))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, in order."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def battery(rows: np.ndarray, top: int, sizes: tuple[int, ...]) -> dict[int, np.ndarray]:
    """-log10 of the randomness p-value of each row of symbols below ``top``,
    by alphabet size: the symbols as part of an alphabet of at least ``top``,
    or folded into a smaller one."""
    m, n = rows.shape
    high = rows * 2 >= top
    p = (top // 2) / top
    change = 2 * p * (1 - p)
    runs = (high[:, 1:] != high[:, :-1]).sum(1)
    zr = (runs - (n - 1) * change) / math.sqrt(max((n - 1) * change * (1 - change), 1e-9))
    x = rows - (top - 1) / 2
    zs = (x[:, 1:] * x[:, :-1]).sum(1) / ((top * top - 1) / 12 * math.sqrt(n - 1))
    order = _log_tail(np.abs(zr), 2) + _log_tail(np.abs(zs), 2)
    squares = {}
    for width in {min(k, top) for k in sizes}:
        counts = np.bincount((rows % width + np.arange(m)[:, None] * width).ravel(), minlength=m * width).reshape(m, width)
        squares[width] = (counts * counts).sum(1)
    return {k: _join(_chi(squares[min(k, top)], n, k) + order) for k in sizes}


def _chi(squares: np.ndarray, n: int, k: int) -> np.ndarray:
    """Log tail of the chi-squared uniformity test, from the sum of squared counts."""
    df = k - 1                                              # Wilson and Hilferty's cube root
    chi = np.maximum(0.0, squares * (k / n) - n)
    return _log_tail(((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))


def _join(logs: np.ndarray) -> np.ndarray:
    """Fisher's sum of three log p-values: half a chi-squared of six degrees."""
    half = -logs
    return np.maximum(0.0, (half - np.log1p(half + half * half / 2)) / math.log(10))


def _log_tail(z: np.ndarray, sides: int = 1) -> np.ndarray:
    """Log of the normal upper tail (Abramowitz and Stegun 26.2.17, Mills beyond 5)."""
    z = np.asarray(z, float)
    a = np.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = np.log(np.maximum(poly, 1e-300)) - a * a / 2 - 0.5 * math.log(2 * math.pi)
    both = np.where(z >= 0, tail, np.log1p(-np.minimum(np.exp(tail), 1 - 1e-12)))
    return np.minimum(0.0, both + math.log(sides))


def length_class(n: int) -> int:
    return sum(n >= x for x in LENGTHS) - 1


def _cell(u: np.ndarray) -> np.ndarray:
    return np.minimum(CELLS - 1, (u * 4).astype(np.int64))


def candidates(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, cell)`` of every string tested: the runs that one
    alphabet holds, and the parts of all runs, which may overlap; cell =
    alphabet group, length class and randomness.  Strings of digits only are
    not tested."""
    out = []
    for m in _CANDIDATE.finditer(text):
        spans = {m.span()}
        if not m[0].isalnum():
            spans.update(x.span() for p in _PARTS for x in p.finditer(text, *m.span()))
        for start, end in sorted(spans):
            word = text[start:end]
            if word.isdigit():
                continue
            for pattern, k, index in _ALPHABETS:
                if pattern.fullmatch(word):
                    rows = np.array([[index[ord(c)] for c in word]])
                    out.append((start, end, _cells(GROUPS.index(min(64, k + 2 * (k == 62))), length_class(len(word)), battery(rows, k, (k,))[k])[0]))
                    break
    return out


def _cells(group: int, length: int, u: np.ndarray) -> list[int]:
    return ((group * len(LENGTHS) + length) * CELLS + np.minimum(CELLS - 1, (u * 4).astype(np.int64))).tolist()


def reference(texts: list[str], into: np.ndarray) -> None:
    """Add the texts' letters, each text cut into stretches of every length
    on its own, to the histogram of ordinary text: the same letters seen as
    symbols of every alphabet (folded for hex)."""
    letters = [np.frombuffer(t.encode("ascii", "ignore").lower().translate(None, _NO_LETTERS), np.uint8) - 97 for t in texts]
    for c, n in enumerate(LENGTHS):
        rows = [x[:len(x) // n * n].reshape(-1, n) for x in letters if len(x) >= n]
        if rows:
            _add(np.concatenate(rows), c, into)


def _add(rows: np.ndarray, c: int, into: np.ndarray) -> None:
    for lo in range(0, len(rows), 4096):
        got = battery(rows[lo:lo + 4096].astype(np.int64), 26, GROUPS)
        for g, k in enumerate(GROUPS):
            into += np.bincount(_cells(g, c, got[k]), minlength=HISTOGRAM)


def fixed_null() -> np.ndarray:
    """The histogram of ``LEAST`` stretches of each length, letters drawn
    independently by ``FREQUENCIES``; the same on every call."""
    rng, out = np.random.default_rng(3), np.zeros(HISTOGRAM, np.int64)
    share = np.cumsum(FREQUENCIES) / sum(FREQUENCIES)
    for c, n in enumerate(LENGTHS):
        _add(np.searchsorted(share, rng.random((LEAST, n)), side="right"), c, out)
    return out


def cuts(null: np.ndarray, seen: np.ndarray, rate: float = FALSE_DISCOVERY) -> np.ndarray:
    """For each alphabet group and length class, the number of cells (from the
    most random) that are discoveries: Benjamini-Hochberg over the candidates
    ``seen``, with p-values from the histogram ``null`` of ordinary text, made
    up to ``LEAST`` stretches, and the battery does not reject randomness."""
    null, seen = null.reshape(-1, CELLS), seen.reshape(-1, CELLS)
    short = np.maximum(0, LEAST - null.sum(1, keepdims=True))
    if short.any() and seen.any():
        null = null + fixed_null().reshape(-1, CELLS) * (short / LEAST)
    p = (np.cumsum(null, 1) + 1) / (null.sum(1, keepdims=True) + 1)
    order = np.argsort(p, axis=None, kind="stable")
    rank = np.cumsum(seen.ravel()[order])
    good = (seen.ravel()[order] > 0) & (p.ravel()[order] <= rate * rank / max(1, seen.sum()))
    limit = p.ravel()[order][good].max() if good.any() else 0.0
    return np.minimum((p <= limit).sum(1), RANDOM)


@dataclass
class Rules:
    """What the corpus decided: cells that count, by length class."""
    cells: np.ndarray = field(default_factory=lambda: np.zeros(len(GROUPS) * len(LENGTHS), np.int64))

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        base = base_spans(text)
        return sorted(base + self.more(base, candidates(text)))

    def more(self, base: list[tuple[int, int, int]], found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """The tested strings that are discoveries, unless a base span covers
        them; those that overlap are one."""
        out: list[tuple[int, int, int]] = []
        for s, e, c in sorted(found):
            if c % CELLS < self.cells[c // CELLS] and not any(x <= s and e <= y for x, _, y in base):
                if out and s < out[-1][2]:
                    out[-1] = (out[-1][0], 3, max(e, out[-1][2]))
                else:
                    out.append((s, 3, e))
        return out

    def redact(self, text: str | None, mark: str = MARK) -> str | None:
        if text is None:
            return None
        out, at = [], 0
        for s, _, e in self.spans(text):
            if s >= at:
                out += [text[at:s], mark]
            at = max(at, e)
        return "".join(out) + text[at:] if out else text


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Rules]:
    """One pass over the texts: a written row per document with base spans and
    candidates, and the rules that follow from all of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2048):     # one histogram row each
            null, seen = np.zeros(HISTOGRAM, np.int64), np.zeros(HISTOGRAM, np.int64)
            texts = [t or "" for t in b.column(1).to_pylist()]
            base, more = [base_spans(t) for t in texts], [candidates(t) for t in texts]
            for lo in range(0, len(texts), 200):
                reference(texts[lo:lo + 200], null)
            np.add.at(seen, np.array([c for row in more for _, _, c in row], np.int64), 1)
            n = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([b.column(0), pa.nulls(1, pa.int64())]), pa.array([False] * n + [True]),
                 pa.array([[x for s in row for x in s] for row in base] + [[]], pa.list_(pa.int64())),
                 pa.array([[x for s in row for x in s] for row in more] + [[]], pa.list_(pa.int64())),
                 pa.array([[]] * n + [null.tolist() + seen.tolist()], pa.list_(pa.int64()))],
                ["doc_id", "is_histogram", "base", "more", "histogram"])

    rows = materialize(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                       .mapInArrow(run, "doc_id long, is_histogram boolean, base array<long>, more array<long>, histogram array<long>"),
                       "secrets")
    return rows.where(~F.col("is_histogram")), _rules(rows.where("is_histogram"))


def _rules(histograms: DataFrame) -> Rules:
    """Sum of the histograms: as many rows as it has cells reach the driver."""
    total = np.zeros(2 * HISTOGRAM, np.int64)
    for r in histograms.select(F.posexplode("histogram").alias("cell", "n")).groupBy("cell").agg(F.sum("n").alias("n")).collect():
        total[r["cell"]] = r["n"]
    return Rules(cuts(*np.split(total, 2)))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256,
    spans, n_random``.  Null texts are empty and have no spans; very long
    ones are searched whole, in memory in proportion to them; null and
    repeated ids stay as they are; an empty table gives no rows; other columns
    are ignored."""
    rows, rules = scan(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            for i, base, more in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                base = list(zip(base[::3], base[1::3], base[2::3]))
                extra = rules.more(base, list(zip(more[::3], more[1::3], more[2::3])))
                kinds = [k for _, k, _ in base]
                out.append((i, kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(spell(base).encode()).hexdigest(),
                            spell(sorted(base + extra)), len(extra)))
            cols, names = list(zip(*out)) or [()] * 7, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k in (4, 5) else pa.int64()) for k, c in enumerate(cols)], names)

    return rows.select("doc_id", "base", "more").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")


def redact(docs: DataFrame, text_col: str = "text", size_col: str | None = "n_chars", mark: str = MARK) -> DataFrame:
    """The documents, all rows and columns, with every span replaced by
    ``mark`` (and ``size_col``, where there is one, set to the new length of
    the texts that changed)."""
    _, rules = scan(docs.withColumn("_no", F.lit(None).cast("long")), "_no", text_col)
    t = docs.columns.index(text_col)
    n = docs.columns.index(size_col) if size_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            cols, old = list(b.columns), b.column(t).to_pylist()
            new = [rules.redact(x, mark) for x in old]
            cols[t] = pa.array(new, b.schema.field(t).type)
            if n is not None:
                cols[n] = pa.array([size if x is y or x == y else len(y) for x, y, size in zip(old, new, cols[n].to_pylist())], b.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return find_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))
