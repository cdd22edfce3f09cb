"""Removal of byte strings that repeat anywhere, by sharded suffix arrays.

Every ``WINDOW``-byte string has an anchor: of the ``GRAM``-byte grams inside
it the one with the smallest hash, the leftmost on ties.  Equal strings have
equal anchors, so strings can only be equal within an anchor's group, and the
strings of a document that share an anchor form one segment of at most 350
bytes.  That gives shards that need no pair of shards to be compared:

1. anchors whose hash occurs once are dropped (count, then join, on the hash);
2. equal segments are collapsed with their counts before any text moves; a
   group with one segment text needs no sorting;
3. the distinct segments of the other groups are dealt into shards by anchor.
   A shard sorts their suffixes with Larsson-Sadakane refinement in numpy and
   takes common prefixes with Kasai's algorithm, one lane per segment; runs
   with a common prefix of ``WINDOW`` bytes and two or more places are repeats;
4. an anchor with very many distinct segments is split over sub-shards; each
   sends its sorted strings' digests, cut by range, and the ranges are merged
   across sub-shards by binary search;
5. repeats become byte ranges of the documents that hold the segment.

Keys are 96-bit hashes of id and text, anchors and segments 64 bits each
(joint 128); hashes only group, except that segments equal in both are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, ship_by_value, slices, table

ship_by_value()

WINDOW = 200
GRAM = 50
PART = 1 << 18          # bytes hashed at a time
SHARD_BYTES = 1 << 18   # of segments sorted at a time
SPLIT = 500             # distinct segments of an anchor in one sub-shard
FILTER_BITS = 22        # of the filter of documents that take part, whatever their number

_U = np.uint64


class Hasher:
    """Rolling polynomial hashes of bytes modulo 2**64, over a table of random
    byte values; the base is odd, so prefix sums can be shifted back."""

    def __init__(self, window: int = WINDOW, gram: int = GRAM, part: int = PART):
        rng = np.random.default_rng(20)
        self.window, self.gram = window, gram
        self.values = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
        base = 0x9E3779B97F4A7C15
        self.power = self._powers(base, part + window)
        self.inverse = self._powers(pow(base, -1, 1 << 64), part + window)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n + 1, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    @staticmethod
    def _mix(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
        x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
        return x ^ (x >> _U(32))

    def segments(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of documents laid end to end in ``data``: ``(document, a, n, anchor
        hash, segment hash)``; the segment holds the ``n`` strings that begin at
        ``a, a + 1, ...`` of its document."""
        long = np.flatnonzero(size >= self.window)
        if not len(long):
            return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
        total = len(data)
        prefix = np.zeros(total + 1, np.uint64)
        np.cumsum(self.values[data] * self.power[:total], out=prefix[1:])
        grams = self._mix((prefix[self.gram:] - prefix[:-self.gram]) * self.inverse[:total - self.gram + 1])
        low = (grams & _U(~0xFFFFFF & (1 << 64) - 1)) | np.arange(len(grams), dtype=np.uint64)
        span, width = 1, self.window - self.gram + 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
        count = size[long] - self.window + 1
        doc = np.repeat(long, count)
        at = np.arange(count.sum()) + np.repeat(start[long] - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        anchor = (low[at] & _U(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]))
        n = np.diff(np.concatenate([first, [len(at)]]))
        a = at[first]
        text = self._mix((prefix[a + n + self.window - 1] - prefix[a]) * self.inverse[a] + n.astype(np.uint64))
        return doc[first], a - start[doc[first]], n, grams[anchor[first]], text


def _parts(texts: list[bytes], part: int, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts laid end to end in parts of bounded size; a longer text is cut so
    that each of its strings lies in one part.  ``(data, text, offset in it, size)``."""
    held, used = [], 0
    step = part - window + 1
    for i, t in enumerate(texts):
        for lo in range(0, max(1, len(t) - window + 1), step):
            piece = t[lo:lo + part]
            if used + len(piece) > part and held:
                yield _lay(held)
                held, used = [], 0
            held.append((i, lo, piece))
            used += len(piece)
    if held:
        yield _lay(held)


def _lay(held):
    return (np.frombuffer(b"".join(p for _, _, p in held), np.uint8), np.array([i for i, _, _ in held]),
            np.array([lo for _, lo, _ in held]), np.array([len(p) for _, _, p in held]))


def suffix_array(data: np.ndarray, end: np.ndarray, longest: int) -> np.ndarray:
    """Positions of ``data`` in the order of the suffixes of their segments,
    equal ones in the order of position (Kasai's step relies on both);
    ``end[i]`` is where the segment of position ``i`` ends (seven or more bytes
    of padding follow it), ``longest`` the length of the longest.  Larsson-Sadakane: each round
    doubles the sorted depth and sorts only the groups that are still tied."""
    m = len(data)
    symbol = np.zeros(m + 7, np.uint64)                     # 1 to 256; 0 past the end of a segment
    symbol[:m] = np.where(np.arange(m) < end, data.astype(np.uint64) + _U(1), _U(0))
    key = np.zeros(m, np.uint64)
    for k in range(7):
        key = (key << _U(9)) | symbol[k:k + m]
    sa = np.argsort(key, kind="stable")
    key = key[sa]
    head = np.concatenate([[True], key[1:] != key[:-1]])
    h = 7
    while True:
        rank = np.empty(m, np.int64)
        rank[sa] = np.maximum.accumulate(np.where(head, np.arange(m), 0)) + 1
        if h >= longest:
            return sa
        tied = np.flatnonzero(~(head & np.concatenate([head[1:], [True]])))
        if not len(tied):
            return sa
        pos = sa[tied]
        later = np.where(pos + h < end[pos], rank[np.minimum(pos + h, m - 1)], 0)
        own = rank[pos]
        key = own * (m + 1) + later
        by = np.argsort(key, kind="stable")
        sa[tied] = pos[by]
        own, later = own[by], later[by]
        head[tied] = np.concatenate([[True], (own[1:] != own[:-1]) | (later[1:] != later[:-1])])
        h *= 2


def common_prefixes(data: np.ndarray, sa: np.ndarray, start: np.ndarray, n: np.ndarray, end: np.ndarray, depth: int) -> np.ndarray:
    """For each position that begins a string, the common prefix with the one
    before it in ``sa``, up to ``depth``.  Kasai's algorithm with a lane per
    segment: the prefix of the next position is at most one shorter."""
    m = len(data)
    before = np.full(m, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    out = np.zeros(m, np.int64)
    words = np.concatenate([data, np.zeros(8, np.uint8)])
    have = np.zeros(len(start), np.int64)
    lanes = np.arange(len(start))
    for step in range(int(n.max(initial=0))):
        lanes = lanes[n[lanes] > step]
        i = start[lanes] + step
        j = before[i]
        known = np.where(j >= 0, np.maximum(have[lanes] - 1, 0), 0)
        most = np.where(j >= 0, np.minimum(depth, np.minimum(end[i] - i, end[j] - j)), 0)
        known = np.minimum(known, most)
        live = np.flatnonzero(known < most)
        while len(live):
            x, y = i[live] + known[live], j[live] + known[live]
            room = np.minimum(most[live] - known[live], 16)
            same = words[np.minimum(x[:, None] + np.arange(16), m + 7)] == words[np.minimum(y[:, None] + np.arange(16), m + 7)]
            run = np.minimum(np.where(same.all(1), 16, same.argmin(1)), room)
            known[live] += run
            live = live[(run == 16) & (known[live] < most[live])]
        have[lanes] = known
        out[i] = known
    return out


def shard_classes(segments: list[bytes], n: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Equal strings of a shard: ``(position, class)`` of every string that
    begins in a segment, in suffix order; position counts strings segment by
    segment."""
    size = np.array([len(s) + 8 for s in segments])
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    data = np.frombuffer(b"".join(s + bytes(8) for s in segments), np.uint8)
    end = np.repeat(start + size - 8, size)
    sa = suffix_array(data, end, int(size.max()) - 8)
    prefix = common_prefixes(data, sa, start, n, end, window)
    begins = np.full(len(data), -1, np.int64)
    begins[np.arange(n.sum()) + np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n)] = np.arange(n.sum())
    # a suffix that begins no string is shorter than the window: it ends a run
    first = prefix[sa] < window
    group = np.cumsum(first)
    keep = begins[sa] >= 0
    return begins[sa][keep], group[keep]


def ranges(hits: np.ndarray, window: int) -> list[int]:
    """Bytes covered by strings that begin where ``hits``: flat ``lo, hi`` pairs."""
    at = np.flatnonzero(hits)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > window)
    lo = at[np.concatenate([[0], cut + 1])]
    hi = at[np.concatenate([cut, [len(at) - 1]])] + window
    return np.stack([lo, hi], 1).ravel().tolist()


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(k, k2, text)``: equal rows share a key, and are interchangeable."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.xxhash64(text, F.col(id_col).cast("long")).alias("k"),
                       F.crc32(F.concat_ws("\x01", F.col(id_col).cast("string"), text).cast("binary")).alias("k2"),
                       F.col(id_col).cast("long").alias("doc_id"), text.cast("binary").alias("text"))


def _picked(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows that may have a key in ``keys``, text compressed: a filter of fixed
    size spares the shuffle of the others while it is not full."""
    mask = (1 << FILTER_BITS) - 1
    got = keys.select((F.col("k").bitwiseAND(F.lit(mask))).cast("int").alias("b")).distinct().toPandas()["b"].to_numpy()
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[got] = True
    packed = np.packbits(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there, press = np.unpackbits(packed).astype(bool), zstandard.ZstdCompressor(level=3)
        for b in slices(batches):
            b = b.filter(pa.array(there[b.column(0).to_numpy(zero_copy_only=False) & mask]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([press.compress(t) for t in b.column(2).to_pylist()], pa.binary())],
                                             ["k", "k2", "packed"])

    return keyed.select("k", "k2", "text").mapInArrow(run, "k long, k2 long, packed binary")


def _segments(keyed: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(window, gram)
        for b in slices(batches):
            texts = b.column(2).to_pylist()
            k, k2 = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            for data, text, offset, size in _parts(texts, PART, window):
                piece, a, n, h, s = hasher.segments(data, np.concatenate([[0], np.cumsum(size)[:-1]]), size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(s.view(np.int64)), pa.array(k[text[piece]]), pa.array(k2[text[piece]]),
                     pa.array(a + offset[piece]), pa.array(n.astype(np.int32))], ["h", "s", "k", "k2", "a", "n"])

    return keyed.where(F.octet_length("text") >= window).select("k", "k2", "text").mapInArrow(
        run, "h long, s long, k long, k2 long, a long, n int")


def removals(keyed: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, split: int = SPLIT) -> DataFrame:
    """``(k, k2, lo, hi)``: byte ranges covered by strings that also begin
    elsewhere; ranges of a document may overlap."""
    segments = _segments(keyed, window, gram)
    often = materialize(segments.groupBy("h").count().where("count > 1").select("h"), "often")
    places = materialize(segments.join(often, "h").select("h", "s", "k", "k2", "a", "n"), "places")
    groups = materialize(places.groupBy("h", "s").agg(F.count(F.lit(1)).alias("w"), F.min(F.struct("k", "k2", "a", "n")).alias("rep")), "groups")
    sizes = materialize(groups.groupBy("h").agg(F.count(F.lit(1)).alias("texts")), "sizes")
    # one text under an anchor: all its strings repeat
    known = groups.join(sizes, "h")
    alone = known.where("texts = 1 and w > 1").select("h", "s", F.array(F.lit(0).cast("long"), (F.col("rep.n") + (window - 1)).cast("long")).alias("spans"))
    subs = F.ceil(F.col("texts") / F.lit(split)).cast("int")
    many = (known.where("texts > 1").select("h", "s", "w", subs.alias("subs"), F.pmod(F.xxhash64("s"), subs).cast("int").alias("sub"), "rep.*"))
    wanted = materialize(many.groupBy("k", "k2").agg(F.collect_list(F.struct("h", "s", "w", "subs", "sub", "a", "n")).alias("own")), "wanted")
    texts = _picked(keyed, wanted).join(wanted, ["k", "k2"])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                rows = [(o["h"], o["s"], o["w"], o["subs"], o["sub"], o["n"], text[o["a"]:o["a"] + o["n"] + window - 1])
                        for packed, own in zip(b.column(0).slice(lo, 64).to_pylist(), b.column(1).slice(lo, 64).to_pylist())
                        for text in [press.decompress(packed)] for o in own]
                cols = list(zip(*rows)) or [()] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    names = ["h", "s", "w", "subs", "sub", "n", "text"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    # rows that repeat id and text come once each: the first is enough
    dealt = (texts.select("packed", "own").mapInArrow(take, "h long, s long, w long, subs int, sub int, n int, text binary")
             .repartition("h", "sub").sortWithinPartitions("h", "sub", "s"))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        held, used, last = [], 0, None
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if held and r[:2] == held[-1][:2]:
                    continue
                if used >= shard_bytes and (r[0], r[4]) != last:
                    yield held
                    held, used = [], 0
                held.append(r)
                used += len(r[6])
                last = r[0], r[4]
        if held:
            yield held

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in shards(batches):
            n = np.array([r[5] for r in held])
            where, group = shard_classes([r[6] for r in held], n, window)
            seg = np.repeat(np.arange(len(held)), n)[where]
            weight = np.bincount(group, np.array([r[2] for r in held], float)[seg])
            hit = np.zeros(int(n.sum()), bool)
            hit[where] = weight[group] >= 2
            out = []
            base = np.concatenate([[0], np.cumsum(n)])
            hot = np.array([r[3] > 1 for r in held])
            for i, r in enumerate(held):
                out.append((r[0], r[1], ranges(hit[base[i]:base[i + 1]], window), None, None, None, None))
            if hot.any():       # one string of each class goes to the merge
                mine = np.flatnonzero(hot[seg])
                lone = mine[np.unique(group[mine], return_index=True)[1]]
                digest, place = {}, {}
                for w, i in zip(where[lone].tolist(), seg[lone].tolist()):
                    at = w - int(base[i])
                    d = xxhash.xxh3_128_digest(held[i][6][at:at + window])
                    cell = d[0] * 256 + d[1] >> max(0, 16 - (4 * held[i][3]).bit_length())
                    key = held[i][0], held[i][4], cell
                    digest.setdefault(key, []).append(d)
                    place.setdefault(key, []).append((i, at))
                for (h, sub, cell), ds in digest.items():
                    order = sorted(range(len(ds)), key=ds.__getitem__)
                    out.append((h, None, None, sub, cell, b"".join(ds[o] for o in order),
                                [x for o in order for x in (held[place[h, sub, cell][o][0]][1], place[h, sub, cell][o][1])]))
            for lo in range(0, len(out), 2000):
                cols = list(zip(*out[lo:lo + 2000]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())))],
                    ["h", "s", "spans", "sub", "cell", "digests", "places"])

    sorted_ = materialize(dealt.select(*names).mapInArrow(
        sort, "h long, s long, spans array<long>, sub int, cell int, digests binary, places array<long>"), "sorted")

    def merge(t: pa.Table) -> pa.Table:
        """Strings of one range that lie in more than one sub-shard: each
        sub-shard's sorted digests are looked up in every other's."""
        runs = [np.frombuffer(d, ">u8").reshape(-1, 2) for d in t.column("digests").to_pylist()]
        places = [np.array(p, np.int64).reshape(-1, 2) for p in t.column("places").to_pylist()]
        h = t.column("h")[0].as_py()
        keys = [r[:, 0].astype(np.uint64) for r in runs]
        got = []
        if len(runs) > 1:
            every = np.sort(np.concatenate(keys))
            for r, k, p in zip(runs, keys, places):
                # in all ranges together more often than in the own one
                more = (np.searchsorted(every, k, "right") - np.searchsorted(every, k, "left")) > (
                    np.searchsorted(k, k, "right") - np.searchsorted(k, k, "left"))
                got.append((r[more], p[more]))
            whole = np.concatenate([g[0] for g in got])
            _, back, times = np.unique(whole, axis=0, return_inverse=True, return_counts=True)
            p = np.concatenate([g[1] for g in got])[times[back.ravel()] > 1]
        else:
            p = np.zeros((0, 2), np.int64)
        return pa.table({"h": pa.array([h] * len(p), pa.int64()), "s": pa.array(p[:, 0]),
                         "spans": pa.array([[x, x + window] for x in p[:, 1].tolist()], pa.list_(pa.int64()))})

    across = (sorted_.where("sub is not null").select("h", "cell", "digests", "places")
              .groupBy("h", "cell").applyInArrow(merge, "h long, s long, spans array<long>"))
    marks = (alone.unionByName(sorted_.where("sub is null and size(spans) > 0").select("h", "s", "spans"))
             .unionByName(across))
    found = materialize(marks, "marks").join(places.select("h", "s", "k", "k2", "a"), ["h", "s"])
    pair = F.explode(F.expr("transform(sequence(0, size(spans) - 1, 2), i -> struct(spans[i] + a as lo, spans[i + 1] + a as hi))"))
    return found.select("k", "k2", pair.alias("r")).select("k", "k2", "r.lo", "r.hi")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
                   keep_text: bool = False, **kw) -> DataFrame:
    """A row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``
    (and ``kept``, the bytes left, on request).

    Null texts are empty; texts shorter than the window stay whole; null and
    repeated ids and repeated rows are documents of their own; other columns
    are ignored; an empty table gives no rows.
    """
    keyed = _keyed(docs, id_col, text_col)
    cuts = materialize(removals(keyed, window, gram, **kw).groupBy("k", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias("cuts")), "cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for b in slices(batches):
            out = []
            for k, k2, packed, own in zip(*(c.to_pylist() for c in b.columns)):
                text, left, at, spans, gone = press.decompress(packed), [], 0, 0, 0
                for lo, hi in sorted((c["lo"], c["hi"]) for c in own):
                    if lo > at or not spans:
                        left.append(text[at:lo])
                        spans, gone, at = spans + 1, gone + hi - lo, hi
                    elif hi > at:
                        gone, at = gone + hi - at, hi
                left.append(text[at:])
                kept = b"".join(left)
                out.append((k, k2, gone, spans, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            cols = list(zip(*out)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["k", "k2", "n_removed", "n_spans", "sha", "kept"])

    # rows that repeat id and text give equal results: one is kept
    done = (_picked(keyed, cuts).join(cuts, ["k", "k2"]).select("k", "k2", "packed", "cuts")
            .mapInArrow(run, "k long, k2 long, n_removed long, n_spans long, sha string, kept binary"))
    done = materialize(done, "done").dropDuplicates(["k", "k2"])
    base = keyed.select("k", "k2", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"),
                        *([F.col("text").alias("all")] if keep_text else []))
    zero = F.lit(0).cast("long")
    cols = ["doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
            F.coalesce("sha", "whole").alias("kept_sha256")]
    if keep_text:
        cols.append(F.coalesce("kept", "all").alias("kept"))
    return base.join(materialize(done, "results"), ["k", "k2"], "left").select(*cols)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 200-byte strings removed from all documents."""
    return remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
