"""Language identification by hierarchical discrimination.

Texts become hashed counts of byte 2-, 3- and 4-grams.  One-versus-one linear
support vector machines first tell the language families apart; those of the
chosen family then separate its languages, so that close relatives are told
apart by machines that have seen nothing else.  The machines are fitted on the
driver on about ``PER_LANGUAGE`` documents of each language, drawn by hash of
the id; counting, drawing and prediction run over all rows, texts unshuffled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Shared, ship_by_value, slices, table

ship_by_value()

PER_LANGUAGE = 600      # documents of a language that the machines see, about,
TRAIN_ROWS = 24_000     # and of all languages; many share this evenly
MAX_LANGUAGES = 2_000   # more are refused: such a column does not hold languages
OWN_FAMILY = 12         # unlisted codes that are families of their own; more are grouped by their profiles
BINS = ((2, 11), (3, 12), (4, 12))      # gram length, bits of its hash
SIZE = sum(1 << b for _, b in BINS)

# Families of ISO 639-1 codes.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fo af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la co rm sc wa an ht",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg cu",
    "baltic": "lt lv",
    "celtic": "ga gd cy br kw gv",
    "uralic": "fi et hu se",
    "turkic": "tr az kk ky uz tk tt ba cv ug",
    "iranian": "fa ps ku tg os",
    "indic": "hi ur bn pa gu mr ne or as sd si sa",
    "dravidian": "ta te kn ml",
    "semitic": "ar he am mt ti",
    "austronesian": "id ms tl jv su mg mi sm to fj haw ceb",
    "bantu": "sw zu xh st tn sn rw rn lg ln ny",
    "sinitic": "zh yue",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_LETTER = regex.compile(r"\p{L}")
_BLANK = bytes(b if 97 <= b < 123 or 65 <= b < 91 or b >= 128 else 32 for b in range(256))


def families_of(langs: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The family of each row's language: by its code without region or script
    (``en-US`` is ``en``), and for codes not listed its own, or, if these are
    many, that of the nearest of a few of them, spread out by their profiles."""
    names, row = np.unique(langs.astype(str), return_inverse=True)
    family = [_FAMILY.get(re.split("[-_]", n.lower())[0], "") for n in names]
    lone = [k for k, f in enumerate(family) if not f]
    if len(lone) <= OWN_FAMILY:
        for k in lone:
            family[k] = f"only {names[k]}"
    else:
        mean = np.stack([x[row == k].mean(axis=0) for k in lone])
        mean /= np.maximum(np.linalg.norm(mean, axis=1, keepdims=True), 1e-9)
        centres = [0]
        near = mean @ mean[0]
        while len(centres) < math.isqrt(len(lone)):        # the one farthest from all centres so far
            centres.append(int(near.argmin()))
            near = np.maximum(near, mean @ mean[centres[-1]])
        for k, c in zip(lone, (mean @ mean[centres].T).argmax(axis=1).tolist()):
            family[k] = f"like {names[lone[centres[c]]]}"
    return np.array(family, dtype=object)[row]


def features(text: str) -> np.ndarray:
    """Square roots of hashed gram counts of the whole text, unit length per
    gram length; white space, digits and marks between words count as one blank."""
    words = text.lower().encode("utf-8", "surrogatepass").translate(_BLANK).split()
    x = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    out, at = np.zeros(SIZE, np.float32), 0
    for n, bits in BINS:
        if len(x) >= n:
            code = x[:len(x) - n + 1].copy()
            for k in range(1, n):
                code = code << np.uint32(8) | x[k:len(x) - n + 1 + k]
            count = np.bincount((code * np.uint32(2654435761)) >> np.uint32(32 - bits), minlength=1 << bits)
            out[at:at + (1 << bits)] = np.sqrt(count / count.sum())
        at += 1 << bits
    return out


def svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 120) -> tuple[np.ndarray, float]:
    """Linear machine ``(weights, bias)`` for labels -1 and 1: squared hinge
    loss, classes weighted alike, by accelerated gradient steps."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    v, vb, t = w.copy(), b, 1.0
    step = 1 / (1 + 2 * c * (float((x * x).sum(1).max()) + 1))
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ v + vb)) * weight * y
        new, nb = v - step * (v - 2 * c * (slack @ x)), vb + step * 2 * c * float(slack.sum())
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, vb, w, b, t = new + (t - 1) / nt * (new - w), nb + (t - 1) / nt * (nb - b), new, nb, nt
    return w, b


@dataclass
class Duels:
    """One-versus-one machines among ``names``."""
    names: list[str]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray | None = None
    bias: np.ndarray | None = None

    @staticmethod
    def fit(x: np.ndarray, names: np.ndarray) -> Duels:
        own = sorted(set(names))
        pairs = [(i, j) for i in range(len(own)) for j in range(i)]
        made = [svm(x[(s := (names == own[i]) | (names == own[j]))], np.where(names[s] == own[i], 1, -1).astype(np.float32)) for i, j in pairs]
        return Duels(own, pairs, np.stack([m[0] for m in made], 1) if made else None, np.array([m[1] for m in made]))

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Most duels won, then the larger sum of margins, then the first name:
        ``(index, confidence)``."""
        n = len(x)
        if not self.pairs:
            return np.zeros(n, int), np.ones(n)
        margin = x @ self.weights + self.bias
        votes, total, least = np.zeros((n, len(self.names))), np.zeros((n, len(self.names))), np.full((n, len(self.names)), np.inf)
        for k, (i, j) in enumerate(self.pairs):
            m = np.clip(margin[:, k], -20, 20)
            votes[:, i] += m > 0
            votes[:, j] += m <= 0
            for a, s in ((i, m), (j, -m)):
                total[:, a] += s
                least[:, a] = np.minimum(least[:, a], s)
        best = np.argmax(votes + np.tanh(total / (40 * len(self.names))) / 2, axis=1)
        return best, 1 / (1 + np.exp(-2 * least[np.arange(n), best]))


@dataclass
class Model:
    families: Duels | None = None
    within: dict[str, Duels] = field(default_factory=dict)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        some = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if self.families else []
        for lo in range(0, len(some), 64):
            rows = some[lo:lo + 64]
            x = np.stack([features(texts[i]) for i in rows])
            best, sure = self.families.decide(x)
            for f in set(best.tolist()):
                inside = np.flatnonzero(best == f)
                duels = self.within[self.families.names[f]]
                which, own = duels.decide(x[inside])
                for k, w, p in zip(inside.tolist(), which.tolist(), own.tolist()):
                    langs[rows[k]], scores[rows[k]] = duels.names[w], float(p * sure[k])
        return langs, scores


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on documents that are not held out and have an id, a lang and a letter.

    At most about ``per_language`` documents of a language and ``TRAIN_ROWS`` of
    all are drawn, by hash of id and text; a repeated row counts once.  Every
    value of lang is learnt; more than ``MAX_LANGUAGES`` are an error."""
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES + 1).collect()}
    if not counts:
        return Model()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"lang has more than {MAX_LANGUAGES} values")
    each = min(per_language, max(1, TRAIN_ROWS // len(counts)))
    rate = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, each / n)))])
    key = F.xxhash64("doc_id", "text")
    draw = F.pmod(key, F.lit(1 << 40)) / float(1 << 40)
    drawn = rows.where(draw < F.try_element_at(rate, F.col("lang")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            keep = [i for i, t in enumerate(b.column(1).to_pylist()) if t and _LETTER.search(t)]
            for lo in range(0, len(keep), 200):
                part = b.take(pa.array(keep[lo:lo + 200]))
                x = [features(t) for t in part.column(1).to_pylist()]
                at = [np.flatnonzero(v) for v in x]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([a.astype(np.int16) for a in at], pa.list_(pa.int16())),
                                                  pa.array([v[a] for v, a in zip(x, at)], pa.list_(pa.float32())), part.column(3)],
                                                 ["doc_id", "lang", "at", "x", "key"])

    got = (drawn.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), key.alias("key"))
           .mapInArrow(run, "doc_id long, lang string, at array<short>, x array<float>, key long")
           .groupBy("doc_id", "lang", "key").agg(F.first("at").alias("at"), F.first("x").alias("x"))       # a repeated row once
           .orderBy("key", "doc_id", "lang").limit(2 * TRAIN_ROWS).toArrow()).sort_by([("doc_id", "ascending"), ("key", "ascending"), ("lang", "ascending")])
    langs, x = np.array(got.column("lang").to_pylist(), dtype=object), np.zeros((got.num_rows, SIZE), np.float32)
    for i, (a, v) in enumerate(zip(got.column("at"), got.column("x"))):
        x[i, a.values.to_numpy()] = v.values.to_numpy()
    if not len(langs):
        return Model()
    families = families_of(langs, x)
    return Model(Duels.fit(x, families), {f: Duels.fit(x[families == f], langs[families == f]) for f in sorted(set(families))})


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row.  Null texts and texts without
    a letter are ``und`` with score 0, as is everything if there was nothing to
    learn from; very long texts are read whole; null and repeated ids stay;
    columns but doc_id and text are ignored; an empty table gives no rows."""
    shared = Shared(docs.sparkSession, model)    # by number of languages, at most MAX_LANGUAGES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            langs, scores = shared.value.predict(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents."""
    model = train(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return identify(table(spark, sf_dir, "documents", "doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
