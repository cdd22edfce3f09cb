"""Target-distribution importance resampling over hashed word n-grams, with an
Aho-Corasick dictionary.

Documents are weighted by how much likelier a target's bag of hashed n-grams
makes them than the corpus's own, and a share of them is drawn without
replacement by adding Gumbel noise to the weights.

1. Dictionary: the frequent distinct words of corpus and target become the
   patterns of an automaton, each bounded by delimiters on both sides and
   carrying the CRC-32 and the byte length of the word as its payload.
2. Scan: texts are mapped to delimiter-separated lower-case bytes and run
   through the automaton, which emits the payloads of the words in order.
   Words outside the dictionary are found by their delimiters and hashed on
   the spot, so the dictionary decides the speed, never the result.
3. Composition: the CRC of a run of words follows from the payloads next to
   each other, ``crc(a + b) = shift(crc(a), len(b)) xor crc(b)``; no n-gram is
   ever spelt out.  Modulo the number of buckets it is the feature's bucket.
4. Counts per bucket are summed in the tasks and then over tasks; the gains,
   one number a bucket, are broadcast, and every document is scored.

Text is read twice (dictionary, scan); the buckets of each document are written
to the shared folder, two bytes a feature, and counted and scored from there.
"""

from __future__ import annotations

import itertools
import math
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Shared, materialize, offsets_by_order, per_worker, ship_by_value, slices, table

ship_by_value()

BUCKETS = 10_000
MAX_WORDS = 1           # longest run of words that is a feature
PERCENT = 10
MIN_WORDS = 20
SEED = 2024
DICTIONARY = 65_536     # words of the automaton; bounds its memory at some 20 MB
WORD_BYTES = 64         # longest word of the dictionary
WINDOW = 1 << 20        # bytes the automaton is run over at a time

_SPACE = 0x20
# A-Z to a-z; every other ASCII character that is no digit or letter is a delimiter.
_MAP = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else _SPACE for c in range(256))


def delimited(texts: list[bytes | None]) -> tuple[bytes, np.ndarray]:
    """The texts as one delimited buffer, and where each one starts in it (and the end)."""
    own = [(t or b"").translate(_MAP) for t in texts]
    starts = np.cumsum([0] + [len(t) + 1 for t in own])
    return b" " + b" ".join(own) + b" ", starts


def word_bounds(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of a delimited buffer."""
    inside = np.frombuffer(buffer, np.uint8) != _SPACE
    turn = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    return turn[::2], turn[1::2]


class Dictionary:
    """Automaton over delimiter-bounded words; a match emits ``length << 32 | crc``."""

    def __init__(self, words: list[bytes]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for w in words:     # one character a byte
            self.automaton.add_word(f" {w.decode('latin-1')} ", len(w) << 32 | zlib.crc32(w))
        if words:
            self.automaton.make_automaton()
        self.size = len(words)

    def payloads(self, buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The payload of every word of ``buffer``."""
        out = np.zeros(len(starts), np.int64)
        lo = 0
        while self.size and lo < len(starts):      # whole words, about a window at a time
            hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + WINDOW)))
            base = int(starts[lo]) - 1
            window = buffer[base:int(ends[hi - 1]) + 1].decode("latin-1")
            found = np.fromiter(itertools.chain.from_iterable(self.automaton.iter(window)), np.int64).reshape(-1, 2)
            out[np.searchsorted(ends, found[:, 0] + base)] = found[:, 1]    # a match ends on the delimiter after its word
            lo = hi
        for k in np.flatnonzero(out == 0).tolist():
            w = buffer[starts[k]:ends[k]]
            out[k] = len(w) << 32 | zlib.crc32(w)
        return out


def _shift_tables(powers: int) -> np.ndarray:
    """``[p, byte, value]``: the CRC register ``value << 8 * byte`` after ``2 ** p``
    more zero bytes, for CRC-32 (the reflected polynomial EDB88320)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> np.uint32(1)), table >> np.uint32(1))
    out = np.zeros((powers, 4, 256), np.uint32)
    for byte in range(4):
        value = np.arange(256, dtype=np.uint32) << np.uint32(8 * byte)
        out[0, byte] = table[value & np.uint32(255)] ^ (value >> np.uint32(8))
    for p in range(1, powers):
        for byte in range(4):
            out[p, byte] = _apply(out[p - 1], out[p - 1, byte])
    return out


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (tables[0][crc & np.uint32(255)] ^ tables[1][crc >> np.uint32(8) & np.uint32(255)]
            ^ tables[2][crc >> np.uint32(16) & np.uint32(255)] ^ tables[3][crc >> np.uint32(24)])


_SHIFTS = _shift_tables(31)
_BLANK = np.uint32(zlib.crc32(b" "))


def shifted(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The CRCs moved up by ``size`` bytes each."""
    crc, size = crc.astype(np.uint32), size.astype(np.int64)
    for p in range(int(size.max(initial=0)).bit_length()):
        on = np.flatnonzero(size >> p & 1)
        crc[on] = _apply(_SHIFTS[p], crc[on])
    return crc


def compose(payloads: np.ndarray, last: np.ndarray, words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1 to ``words`` words: ``(first, crc)``, the index of a run's
    first word and its CRC, words joined by one space.  ``last[i]`` is the end
    (exclusive) of the document that word ``i`` is in."""
    crc, size = (payloads & 0xFFFFFFFF).astype(np.uint32), payloads >> 32
    first, run = np.arange(len(payloads)), crc
    yield first, run
    for n in range(2, words + 1):
        fits = first + n <= last[first]
        first, run = first[fits], run[fits]
        own = first + n - 1
        run = shifted(shifted(run, np.ones(len(run), np.int64)) ^ _BLANK, size[own]) ^ crc[own]
        yield first, run


def frequent_words(texts: DataFrame, limit: int = DICTIONARY) -> list[bytes]:
    """The words of one text column that are most frequent by the tasks' own
    lists of at most ``limit``; a bounded list, which only the speed depends on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in slices(batches):
            for t in b.column(0).cast(pa.binary()).to_pylist():
                for lo in range(0, len(t or b""), WINDOW):      # a cut word counts as two; it decides nothing
                    seen.update(t[lo:lo + WINDOW].translate(_MAP).split())
                if len(seen) > 4 * limit:
                    seen = Counter(dict(seen.most_common(limit)))
        top = [(w, n) for w, n in seen.most_common(limit) if len(w) <= WORD_BYTES]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.binary()), pa.array([n for _, n in top], pa.int64())], ["word", "n"])

    rows = texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [bytes(r.word) for r in rows.orderBy(F.desc("n"), "word").limit(limit).collect()]


def features(texts: DataFrame, words: Shared, uid: str, buckets: int, max_words: int, text_col: str = "text") -> DataFrame:
    """``texts`` with ``n_words``, ``n_features`` and the packed bucket numbers
    ``features`` (little-endian, two bytes, or four beyond 65,536 buckets) in
    place of the text column."""
    if not 1 <= buckets <= 1 << 22:
        raise ValueError("between 1 and 4,194,304 buckets")
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    at = texts.columns.index(text_col)
    rest = [i for i, c in enumerate(texts.columns) if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = per_worker("dictionary", dict)       # one at a time
        if held.get("uid") != uid:
            held.update(uid=uid, made=Dictionary(words.value))
        for b in slices(batches):
            buffer, docs = delimited(b.column(at).cast(pa.binary()).to_pylist())
            starts, ends = word_bounds(buffer)
            payloads = held["made"].payloads(buffer, starts, ends)
            cut = np.searchsorted(starts, docs + 1)     # the first word of each document
            last = np.repeat(cut[1:], np.diff(cut))
            parts: list[list[np.ndarray]] = [[] for _ in range(b.num_rows)]
            sizes = np.zeros(b.num_rows, np.int64)
            for first, crc in compose(payloads, last, max_words):
                ids, own = (crc % np.uint32(buckets)).astype(kind), np.searchsorted(first, cut)
                sizes += np.diff(own)
                for k in range(b.num_rows):
                    parts[k].append(ids[own[k]:own[k + 1]])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in rest), pa.array(np.diff(cut), pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array([b"".join(x.tobytes() for x in p) for p in parts], pa.binary())],
                [*(b.schema.names[i] for i in rest), "n_words", "n_features", "features"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema.fields if f.name != text_col)
    return texts.mapInArrow(run, f"{kept + ', ' if kept else ''}n_words long, n_features long, features binary")


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """How many features each bucket holds; a task sends one number a bucket."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in slices(batches):
            for x in b.column(0).to_pylist():
                total += np.bincount(np.frombuffer(x, kind), minlength=buckets) if len(x) > buckets else 0
            small = b"".join(x for x in b.column(0).to_pylist() if len(x) <= buckets)
            total += np.bincount(np.frombuffer(small, kind), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    sums = rows.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in sums:
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, 1000 times the log of the target's smoothed share over the
    corpus's, rounded down."""
    s, t, n = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((b + 1) * (s + n) / ((a + 1) * (t + n))))
                     for a, b in zip(corpus.astype(float).tolist(), target.astype(float).tolist())], np.int64)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, buckets: int = BUCKETS,
             max_words: int = MAX_WORDS, dictionary: int = DICTIONARY) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` for every row of ``docs``;
    ``rank`` counts the drawn rows, ``percent`` of those with ``min_words``
    words, by falling score; it is null for all others.

    Null and empty texts and texts without words have no features and weight
    0.  Null ids draw their noise from the seed alone and lose ties.  Rows that
    tie on score go by smaller id; rows that tie on the id too are drawn in an
    arbitrary but fixed order, each a row of its own.  Other columns, whatever
    their names, are ignored.  An empty corpus gives no rows, an empty target
    the weights of a target without features.  Very long texts are scanned
    whole, a window of ``WINDOW`` bytes at a time; a task then holds eight
    bytes for each of their words.
    """
    spark = docs.sparkSession
    corpus = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    aim = target.select(F.col(target_col).cast("string").alias("text"))
    words = Shared(spark, frequent_words(corpus.select("text").unionByName(aim), dictionary))
    uid = uuid.uuid4().hex
    rows = materialize(features(corpus, words, uid, buckets, max_words)
                       .select(F.monotonically_increasing_id().alias("uid"), "*"), "features")
    gain = Shared(spark, gains(bucket_counts(rows, buckets), bucket_counts(features(aim, words, uid, buckets, max_words), buckets)))
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            own = [int(gain.value[np.frombuffer(x, kind)].sum()) for x in b.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(own, pa.int64())], ["uid", "doc_id", "n_words", "n_features", "weight"])

    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = materialize(rows.select("uid", "doc_id", "n_words", "n_features", "features")
                         .mapInArrow(weigh, "uid long, doc_id long, n_words long, n_features long, weight long")
                         .withColumn("score", F.col("weight") + noise), "scores")
    few = F.col("n_words") < min_words
    drawn = scored.where(~few).count() * percent // 100
    ranked = offsets_by_order(scored.where(~few).withColumn("one", F.lit(1).cast("long")),
                              [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("uid")], "one", "before")
    rank = F.when(F.col("before") < drawn, F.col("before") + 1)
    cols = ("doc_id", "n_features", "weight", "score")
    return ranked.select(*cols, rank.alias("rank")).unionByName(scored.where(few).select(*cols, F.lit(None).cast("long").alias("rank")))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored against the benchmark's texts, a tenth of them drawn."""
    return resample(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text"))


ORACLE = r"""
with poly as (
    select list(list_reduce(list_prepend(n, range(8)), lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) order by n) as tab
    from (select unnest(range(256)) as n)),
d as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents),
b as (
    select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w
    from benchmark),
f as (select doc_id, w, count(*) as n from (select doc_id, unnest(w) as w from d) group by 1, 2),
v as (
    select w, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::bigint)),
                              lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295::bigint) % 10000 as bucket
    from (select distinct w from (select w from f union all select w from b)), poly),
s as (select bucket, sum(n)::double as n from f join v using (w) group by 1),
t as (select bucket, count(*)::double as n from b join v using (w) group by 1),
g as (
    select bucket, floor(1000 * ln((coalesce(t.n, 0) + 1) * ((select coalesce(sum(n), 0) from s) + 10000)
                                   / ((coalesce(s.n, 0) + 1) * ((select coalesce(sum(n), 0) from t) + 10000))))::bigint as gain
    from (select distinct bucket from v) left join s using (bucket) left join t using (bucket)),
p as (select doc_id, sum(n * gain)::bigint as weight from f join v using (w) join g using (bucket) group by 1),
r as (
    select doc_id, len(w)::bigint as n_features, coalesce(weight, 0) as weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::bigint + 0.5::double) / 4294967296)))::bigint as score
    from d left join p using (doc_id)),
o as (select doc_id, row_number() over (order by score desc, doc_id) as k, count(*) over () as n from r where n_features >= 20)
select doc_id, n_features, weight, score, case when k <= 10 * n // 100 then k end as rank
from r left join o using (doc_id)
"""
