"""Quality classifier: a factorisation machine over hashed words, hashed
punctuation tokens, binned structure statistics and length metadata.

The score is ``sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 -
sum_i v_if^2 x_i^2))``: all pairwise interactions in time linear in the
features.  The model is fitted on at most ``TRAIN_ROWS`` labelled documents
(chosen by hash), whose ids are broadcast to the scan, so texts are never
shuffled; scoring covers every row.
"""

from __future__ import annotations

import math
import operator
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Shared, ship_by_value, slices, table

ship_by_value()

TRAIN_ROWS = 8_000      # labelled documents the model is fitted on
WORD_BINS = 1 << 16
MARK_BINS = 1 << 12
STAT_BINS = 16          # per statistic
FACTORS = 8
EPOCHS = 8
REJECT_BELOW = 0.7

# byte classes: 0 lower, 1 upper, 2 digit, 3 blank, 4 line end, 5 mark, 6 above ASCII
_CLASS = np.full(256, 5, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 6
_CLASS[[32, 9, 11, 12, 13]], _CLASS[10] = 3, 4
_LETTERS = bytes([*range(97, 123), *range(65, 91), *range(128, 256)])
_STATS = 15
SIZE = WORD_BINS + MARK_BINS + (_STATS + 1) * STAT_BINS


def _statistics(data: bytes, words: list[bytes], counts: Counter, marks: list[bytes]) -> list[float]:
    """Structure statistics, each scaled to 0..1."""
    n = max(1, len(data))
    by = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=7) / n
    lines = data.split(b"\n")
    per_line = Counter(lines)
    nw, nl = max(1, len(words)), len(lines)
    squash = lambda x, at: x / (x + at)
    ends = sum(c for w, c in counts.items() if w[-1] in b".,;:!?")
    return [by[1], by[2], by[5], by[3] + by[4], math.sqrt(by[5]),
            squash((1 - by[3] - by[4]) * n / nw, 8), len(counts) / nw,
            max(counts.values(), default=0) / nw,
            1 - len(per_line) / nl, sum(c * len(x) for x, c in per_line.items() if c > 1) / n,
            squash(n / nl, 200), len(marks) / nw, ends / nw,
            sum(c for w, c in counts.items() if len(w) == 1) / nw,
            sum(map(operator.eq, words, words[1:])) / nw]


def features(text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features of a text (null: empty): indices and values."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.lower().split()
    marks = data.translate(None, _LETTERS).split()
    counts, mark_counts = Counter(words), Counter(marks)
    idx, val = [], []
    for found, base, bins, scale in ((counts, 0, WORD_BINS, 1.0), (mark_counts, WORD_BINS, MARK_BINS, 1.0)):
        if found:
            v = np.log1p(np.fromiter(found.values(), np.float32, len(found)))
            idx.append(np.fromiter((zlib.crc32(w) for w in found), np.int64, len(found)) % bins + base)
            val.append(v * np.float32(scale / math.sqrt(float(v @ v))))
    stats = _statistics(data, words, counts, marks)
    length = n_chars if n_chars is not None and n_chars >= 0 else len(text or "")
    cell = [min(STAT_BINS - 1, int(s * STAT_BINS)) for s in stats] + [min(STAT_BINS - 1, int(length).bit_length() * STAT_BINS // 24)]
    idx.append(WORD_BINS + MARK_BINS + np.arange(_STATS + 1) * STAT_BINS + np.array(cell))
    val.append(np.full(_STATS + 1, 0.5, np.float32))
    return np.concatenate(idx), np.concatenate(val)


@dataclass
class Model:
    prior: float                        # score where nothing could be learnt
    bias: float = 0.0
    linear: np.ndarray | None = None
    factors: np.ndarray | None = None

    def raw(self, idx: np.ndarray, val: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of rows that begin at ``start``, the factor sums and terms."""
        terms = self.factors[idx] * val[:, None]
        sums = np.add.reduceat(terms, start, axis=0)
        pairs = 0.5 * ((sums * sums).sum(1) - np.add.reduceat((terms * terms).sum(1), start))
        return self.bias + np.add.reduceat(self.linear[idx] * val, start) + pairs, sums, terms

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        if self.linear is None or not rows:
            return np.full(len(rows), self.prior)
        start = np.cumsum([0, *(len(i) for i, _ in rows[:-1])])
        z = self.raw(np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]), start)[0]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, factors: int = FACTORS,
        rate: float = 0.1, decay: float = 1e-5, batch: int = 128, seed: int = 17) -> Model:
    """Logistic loss by AdaGrad mini-batches."""
    model = Model(float((labels.sum() + 1) / (len(labels) + 1)))
    if len(labels) == 0 or labels.min() == labels.max():
        return model
    rng = np.random.default_rng(seed)
    model.bias = float(math.log(model.prior / (1 - model.prior + 1e-9))) if model.prior < 1 else 0.0
    model.linear = np.zeros(SIZE, np.float32)
    model.factors = rng.normal(0, 0.02, (SIZE, factors)).astype(np.float32)
    g_lin, g_fac = np.full(SIZE, 1e-3, np.float32), np.full((SIZE, factors), 1e-3, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), batch):
            pick = order[lo:lo + batch]
            idx, val = np.concatenate([rows[i][0] for i in pick]), np.concatenate([rows[i][1] for i in pick])
            size = np.array([len(rows[i][0]) for i in pick])
            start = np.concatenate([[0], np.cumsum(size)[:-1]])
            z, sums, terms = model.raw(idx, val, start)
            err = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[pick]) / len(pick)).astype(np.float32)
            row = np.repeat(np.arange(len(pick)), size)
            scale = err[row] * val
            uniq, inv = np.unique(idx, return_inverse=True)
            gl = np.bincount(inv, scale, len(uniq)).astype(np.float32) + decay * model.linear[uniq]
            each = scale[:, None] * (sums[row] - terms)
            gf = np.stack([np.bincount(inv, each[:, f], len(uniq)) for f in range(factors)], 1).astype(np.float32) + decay * model.factors[uniq]
            g_lin[uniq] += gl * gl
            g_fac[uniq] += gf * gf
            model.linear[uniq] -= rate * gl / np.sqrt(g_lin[uniq])
            model.factors[uniq] -= rate * 0.5 * gf / np.sqrt(g_fac[uniq])
            model.bias -= rate * float(err.sum())
    return model


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on up to ``train_rows`` labelled documents that are not held out;
    several labels of an id count by their largest, null labels not at all."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("_label")))
    # wide enough that labels of missing documents do not matter; a bounded table by construction
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            f = [features(t, n) for t, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(3), pa.array([x[0].astype(np.int32) for x in f], pa.list_(pa.int32())),
                 pa.array([x[1] for x in f], pa.list_(pa.float32())), b.column(4)], ["doc_id", "label", "idx", "val", "key"])

    # one row of each id, however often it occurs: TRAIN_ROWS bounds rows, too
    got = (_source(docs).join(F.broadcast(picked), "doc_id").select("doc_id", "text", "n_chars", "_label", F.xxhash64("text", "n_chars").alias("_key"))
           .mapInArrow(run, "doc_id long, label int, idx array<int>, val array<float>, key long")
           .groupBy("doc_id").agg(F.min_by(F.struct("label", "idx", "val"), "key").alias("_r")).select("doc_id", "_r.*").toArrow())
    order = np.argsort(got.column("doc_id").to_numpy(), kind="stable")
    idx, val = got.column("idx").combine_chunks(), got.column("val").combine_chunks()
    rows = [(idx[int(i)].values.to_numpy().astype(np.int64), val[int(i)].values.to_numpy()) for i in order]
    return fit(rows, got.column("label").to_numpy()[order].astype(np.float32))


def _source(docs: DataFrame) -> DataFrame:
    n = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), n.alias("n_chars"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of every row, repeated and null ids included, very
    long texts whole; columns other than doc_id, text and n_chars are ignored; null
    text is empty, and empty texts have a score like any other."""
    shared = Shared(docs.sparkSession, model)    # SIZE rows, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            f = [features(t, n) for t, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shared.value.score(f), pa.float64())], ["doc_id", "score"])

    return _source(docs).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, below: float = REJECT_BELOW) -> DataFrame:
    """The documents, all columns, that score ``below`` or more."""
    shared = Shared(docs.sparkSession, model)
    t, n = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sizes = b.column(n).to_pylist() if n is not None else [None] * b.num_rows
            f = [features(x, m) for x, m in zip(b.column(t).to_pylist(), sizes)]
            yield b.filter(pa.array(shared.value.score(f) >= below))

    return docs.mapInArrow(run, docs.schema)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "n_chars")
    model = train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                     (F.col("score") >= REJECT_BELOW).cast("int").alias("predicted"))
