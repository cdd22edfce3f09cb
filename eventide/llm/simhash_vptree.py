"""SimHash near-duplicates, linked through vantage-point trees.

A fingerprint is 64 bits over word shingles (XXH64).  Equal fingerprints are
collapsed first, so copies never meet as pairs.  A vantage-point tree over a
bounded sample of fingerprints deals all of them into shards: a point lives in
one shard, and a point whose distance to a vantage point lies within the link
distance of the cut also visits the other side (triangle inequality).  Every
pair within the distance has one member at home in a shard that the other
visits, so the search is exact.  Inside a shard the same split recurses down
to small blocks compared by XOR and popcount; a shard returns a spanning forest
of its links, never all pairs.  Components come from star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Shared, components, forest, materialize, ship_by_value, slices, table

ship_by_value()

SHINGLE = 3
MAX_BITS = 2
SEED = 42
SAMPLE = 100_000        # fingerprints that shape the tree; any tree is exact
LEAF_ROWS = 8_000       # fingerprints at home in a shard, about
MAX_LEAVES = 65_536     # bound of the broadcast tree; larger inputs get larger shards
BLOCK = 256

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def simhash(data: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of UTF-8 bytes: A-Z lowered, words between ASCII white
    space, shingles with repeats; 0 if there is no word."""
    words = data.lower().split()
    if not words:
        return 0
    norm = b" ".join(words)
    hash64 = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hash64(norm, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = (end - size).tolist()
    h = np.fromiter([hash64(norm[i:j], SEED) for i, j in zip(start, end[shingle - 1:].tolist())],
                    np.uint64, len(words) - shingle + 1)
    n, octets = len(h), h.astype("<u8").view(np.uint8).reshape(-1, 8)
    if n < 128:
        count = np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        count = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(2 * count > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, fp)`` and the long columns ``keep``: the fingerprint as a
    signed long; null text is empty."""
    names = ["doc_id", "fp", *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column(1).cast(pa.binary()).to_pylist()
            fp = np.fromiter([simhash(x or b"", shingle) for x in texts], np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), *b.columns[2:]], names)

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *keep)
            .mapInArrow(run, ", ".join(f"{c} long" for c in names)))


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def build_tree(sample: np.ndarray, leaf: int, reach: int, max_leaves: int = MAX_LEAVES, seed: int = 7) -> np.ndarray:
    """Rows ``(vantage, cut, inner, outer)``; a child below zero is leaf
    ``-1 - child``.  Of a few vantage points and cuts the one with the fewest
    points near the cut is taken, among those that leave both sides a quarter."""
    rng, nodes, leaves = np.random.default_rng(seed), [], 0
    todo = [(np.unique(sample), -1, 0)]
    for points, parent, side in iter(lambda: todo.pop(0) if todo else None, None):
        best = None
        if len(points) > leaf and leaves + len(todo) + 2 <= max_leaves:
            for v in rng.choice(points, min(8, len(points)), replace=False):
                hist = np.bincount(distance(points, v), minlength=65 + reach + 1)
                inside = np.cumsum(hist) / len(points)
                for cut in range(64):
                    if 0.25 <= inside[cut] <= 0.75:
                        near = inside[min(64, cut + reach)] - inside[max(0, cut - reach)] if cut >= reach else inside[cut + reach]
                        if best is None or near < best[0]:
                            best = near, v, cut
        if best is None:
            me, leaves = -1 - leaves, leaves + 1
        else:
            me = len(nodes)
            nodes.append([best[1], best[2], 0, 0])
            d = distance(points, best[1])
            todo += [(points[d <= best[2]], me, 2), (points[d > best[2]], me, 3)]
        if parent >= 0:
            nodes[parent][side] = me
    return np.array(nodes, dtype=object).reshape(-1, 4)


def route(tree: np.ndarray, fp: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(index, leaf, home)`` of every shard each fingerprint lives in or visits."""
    out = []
    todo = [(0, np.arange(len(fp)), np.ones(len(fp), bool))] if len(tree) else []
    if not todo:
        return np.arange(len(fp)), np.zeros(len(fp), np.int32), np.ones(len(fp), bool)
    while todo:
        node, idx, home = todo.pop()
        v, cut, inner, outer = tree[node]
        d = distance(fp[idx], np.uint64(v)).astype(np.int16)
        # a home point stays on its side, and visits the inner side only if it
        # lies outside within reach; a visitor goes wherever a partner may be
        into = [(inner, np.where(home, d <= cut + reach, d <= cut + reach), home & (d <= cut)),
                (outer, np.where(home, d > cut, d > cut - reach), home & (d > cut))]
        for child, go, stays in into:
            if go.any():
                if child < 0:
                    out.append((idx[go], -1 - child, stays[go]))
                else:
                    todo.append((child, idx[go], stays[go]))
    return (np.concatenate([x[0] for x in out]),
            np.concatenate([np.full(len(x[0]), x[1], np.int32) for x in out]),
            np.concatenate([x[2] for x in out]))


def link(fp: np.ndarray, home: np.ndarray, reach: int) -> np.ndarray:
    """Component labels within a shard under links of at most ``reach`` bits
    between a home point and any point: the vantage split recurses to blocks."""
    n, rng = len(fp), np.random.default_rng(11)
    lab = np.arange(n)
    todo = [(np.flatnonzero(home), np.arange(n))]
    while todo:
        h, a = todo.pop()
        if not len(h) or len(a) < 2:
            continue
        if len(h) > BLOCK:
            v = fp[h[rng.integers(len(h))]]
            dh, da = distance(fp[h], v).astype(np.int16), distance(fp[a], v).astype(np.int16)
            cut = int(np.median(dh))
            inner, outer = da <= cut + reach, da > cut - reach
            if 0 < (dh <= cut).sum() < len(h) and inner.sum() + outer.sum() < 1.9 * len(a):
                todo += [(h[dh <= cut], a[inner]), (h[dh > cut], a[outer])]
                continue
        for i in range(0, len(h), BLOCK):
            for j in range(0, len(a), 16 * BLOCK):
                x, y = h[i:i + BLOCK], a[j:j + 16 * BLOCK]
                p, q = np.nonzero(distance(fp[x][:, None], fp[y][None, :]) <= reach)
                p, q = x[p], y[q]
                keep = lab[p] != lab[q]
                if keep.any():
                    lab = forest_from(lab, p[keep], q[keep])
    return lab


def forest_from(lab: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after adding links to labelled components."""
    return forest(len(lab), lab[a], lab[b])[lab]


def classes(fps: DataFrame, max_bits: int = MAX_BITS, leaf_rows: int = LEAF_ROWS, sample: int = SAMPLE,
            max_leaves: int = MAX_LEAVES) -> DataFrame:
    """``(doc_id, fp, component_id)`` for rows ``(doc_id, fp)``: fingerprints
    link at ``max_bits`` or fewer differing bits; component_id is the smallest
    doc_id reachable.  Rows that repeat a doc_id are kept."""
    fps = materialize(fps, "fps")
    points = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "points")
    n = points.count()
    if not n:
        return fps.withColumn("component_id", F.col("doc_id"))
    picked = points.select("fp").sample(min(1.0, sample / n), 3).limit(2 * sample).toPandas()["fp"].to_numpy(np.int64)
    tree = build_tree(picked.view(np.uint64), max(2, int(leaf_rows * min(1.0, sample / n))), max_bits, max_leaves)
    shared = Shared(fps.sparkSession, tree)      # at most max_leaves rows

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp, rep = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            for lo in range(0, len(fp), 4096):
                i, leaf, home = route(shared.value, fp[lo:lo + 4096].view(np.uint64), max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(home), pa.array(fp[lo:lo + 4096][i]),
                                                  pa.array(rep[lo:lo + 4096][i])], ["leaf", "home", "fp", "rep"])

    def shard(t: pa.Table) -> pa.Table:
        fp = t.column("fp").to_numpy().view(np.uint64)
        rep, home = t.column("rep").to_numpy(), t.column("home").to_numpy()
        lab = link(fp, home, max_bits)
        low = np.full(len(fp), np.iinfo(np.int64).max)
        np.minimum.at(low, lab, rep)
        root = low[lab]
        tie = root != rep
        return pa.table({"a": rep[tie], "b": root[tie]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    links = (points.mapInArrow(deal, "leaf int, home boolean, fp long, rep long")
             .groupBy("leaf").applyInArrow(shard, "a long, b long"))
    found = components(links, "a", "b")
    to = materialize(points.join(found, points["rep"] == found["node"], "left")
                     .select("fp", F.coalesce("component", "rep").alias("component_id")), "classes")
    return fps.join(to, "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, **kw) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits),
    ``component_id``.  Documents without a word (null or blank text) have
    fingerprint zero and link like any other; an empty table gives no rows;
    columns beside id and text are ignored; rows with a null id are left out."""
    fps = fingerprints(docs.where(F.col(id_col).isNotNull()), id_col, text_col, shingle)
    out = classes(fps, max_bits, **kw)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
