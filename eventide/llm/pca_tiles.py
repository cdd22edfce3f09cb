"""Embedding near-duplicates by PCA-ordered tiled comparison, exact.

Vectors are scaled to unit length and rotated onto the principal axes of all
vectors (cosines do not change), so that the leading dimensions carry most of
a product.  Equal vectors are collapsed.  Two vectors that link
differ by at most ``sqrt(2 - 2 t)`` on every axis; within a label the vectors
are ordered by cells of that width on the leading axes and cut into tiles of
bounded size, and only tiles whose ranges on those axes come that close are
paired.  A pair of tiles
accumulates its products a block of dimensions at a time; what is left is
bounded by the product of the suffix norms, and a pair of vectors stops as
soon as it cannot reach the threshold.  Pairs that survive all blocks are
decided by the cosine of the original vectors in double precision.

A pair of tiles returns counts per vector and a spanning forest, never its
pairs; a label with a third of all rows is as many tiles as it needs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import components, forest, materialize, ship_by_value, table

ship_by_value()

THRESHOLD = 0.98
TILE = 512              # vectors in a tile
LEAD = 6                # leading axes whose ranges decide which tiles meet
BLOCK = 8               # dimensions accumulated between two bounds
SLACK = 1e-9            # rounding of the rotated products


def _gram(vectors: DataFrame, dim: int) -> np.ndarray:
    """Sum of x x' over all unit vectors: dim * dim numbers reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for b in batches:
            x = _units(_matrix(b.column(0), dim))
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "row"])

    out = np.zeros((dim, dim))
    cells = (vectors.select("v").mapInArrow(run, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "x"))
             .groupBy("i", "j").agg(F.sum("x").alias("x")))
    for r in cells.collect():
        out[r["i"], r["j"]] = r["x"]
    return out


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim).copy()


def _distinct(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``(label, v, vec_id)`` of vectors that can link; ``v`` holds the doubles as bytes."""
    v, d = F.col("_v"), F.col("_v")
    finite = F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(d, lambda x: x != 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1)
            flat = (x.flatten().to_numpy(zero_copy_only=False).astype("<f8") + 0.0)   # no negative zero
            at = np.concatenate([[0], np.cumsum(x.value_lengths().to_numpy(zero_copy_only=False))])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([flat[i:j].tobytes() for i, j in zip(at, at[1:])], pa.binary()), b.column(2)],
                                             ["label", "v", "vec_id"])

    rows = vectors.select(F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("_v"), F.col(id_col).cast("long").alias("vec_id"))
    rows = rows.where(F.col("label").isNotNull() & v.isNotNull()).where(finite)
    return rows.mapInArrow(run, T.StructType([T.StructField("label", rows.schema["label"].dataType), T.StructField("v", T.BinaryType()),
                                              T.StructField("vec_id", T.LongType())]))


def compare(x: np.ndarray, y: np.ndarray, rx: np.ndarray, ry: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs of rows of ``x`` and ``y`` with cosine of at least
    ``threshold``; ``rx`` and ``ry`` are their unit vectors on the axes."""
    dim = rx.shape[1]
    i = j = part = None
    for lo in range(0, dim, BLOCK):
        hi = min(dim, lo + BLOCK)
        left = np.sqrt((rx[:, hi:] ** 2).sum(1)), np.sqrt((ry[:, hi:] ** 2).sum(1))
        if i is None:
            part = rx[:, lo:hi] @ ry[:, lo:hi].T
            i, j = np.nonzero(part + left[0][:, None] * left[1][None, :] >= threshold - SLACK)
            part = part[i, j]
        else:
            part = part + np.einsum("ij,ij->i", rx[i, lo:hi], ry[j, lo:hi])
            live = part + left[0][i] * left[1][j] >= threshold - SLACK
            i, j, part = i[live], j[live], part[live]
        if not len(i):
            return i, j
    keep = cosines(x[i], y[j]) >= threshold
    return i[keep], j[keep]


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; rows scaled first so that squares
    neither overflow nor vanish.  Equal rows have cosine one."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    y = y / np.abs(y).max(axis=1, keepdims=True)
    return np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors link when their labels are equal and not null and their cosine is
    at least ``threshold``.  Vectors that are null, empty, zero or hold null or
    non-finite components have no links; vectors of different lengths never
    link.  Rows that repeat a vec_id are vectors of their own that share the id
    (a repeated id counts its own copies as links); rows with a null id are left
    out.  Other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    vectors = vectors.where(F.col(id_col).isNotNull())
    rows = materialize(_distinct(vectors, id_col, vec_col, label_col), "vectors")
    points = materialize(rows.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")), "points")
    every = vectors.select(F.col(id_col).cast("long").alias("vec_id"))
    dims = [r["d"] // 8 for r in points.select(F.octet_length("v").alias("d")).distinct().collect()]
    found = None
    for dim in sorted(dims):        # one length in any one model's output
        own = _links(points.where(F.octet_length("v") == 8 * dim), dim, threshold, tile)
        found = own if found is None else tuple(a.unionByName(b) for a, b in zip(found, own))
    if found is None:
        return every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    counts = found[0].groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(found[1], "a", "b")
    to = (points.join(counts, "rep", "left").join(classes, points["rep"] == classes["node"], "left")
          .select(*[F.col(c) for c in ("label", "v")], (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                  F.coalesce("component", "rep").alias("component_id")))
    linked = rows.join(materialize(to, "classes"), ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = _unusable(vectors, id_col, vec_col, label_col)
    out = linked.unionByName(alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


def _unusable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    d = F.col(vec_col).cast("array<double>")
    good = F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(d, lambda x: x != 0)
    return vectors.where(F.col(label_col).isNull() | ~F.coalesce(good, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"))


def _links(points: DataFrame, dim: int, threshold: float, tile: int) -> tuple[DataFrame, DataFrame]:
    """Links of distinct vectors of one length: ``(rep, links)`` parts to be
    summed, weighted with the copies, and the forest ``(a, b)``."""
    spark = points.sparkSession
    axes = np.linalg.eigh(_gram(points, dim))[1][:, ::-1].copy()
    lead, width = min(LEAD, dim), math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-7
    side = max(width, 0.05)                                 # of a cell
    cells = [f"c{k}" for k in range(lead)]

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.floor(_units(_matrix(b.column(1), dim)) @ axes[:, :lead] / side).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(at[:, k]) for k in range(lead))], [*b.schema.names, *cells])

    schema = points.select("label", "v", "rep", "n").schema
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = ["label", *cells, "rep"]
    ordered = (points.select("label", "v", "rep", "n").mapInArrow(order, T.StructType([*schema.fields, *(T.StructField(c, T.IntegerType()) for c in cells)]))
               .repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of one label, of at most ``tile`` vectors."""
        at = 0
        held: list[dict] = []

        def flush():
            nonlocal at, held
            x = np.frombuffer(b"".join(r["v"] for r in held), "<f8").reshape(-1, dim)
            rot = _units(x) @ axes
            row = {"tile": (held[0]["_part"] << 32) + at, "label": held[0]["label"], "lo": rot[:, :lead].min(0).tolist(),
                   "hi": rot[:, :lead].max(0).tolist(), "x": x.tobytes(), "rep": [r["rep"] for r in held], "n": [r["n"] for r in held]}
            at, held = at + 1, []
            return pa.RecordBatch.from_pylist([row], schema=tile_arrow)

        for b in batches:
            for r in b.to_pylist():
                if held and (len(held) >= tile or r["label"] != held[0]["label"]):
                    yield flush()
                held.append(r)
        if held:
            yield flush()

    label = schema["label"].dataType
    tile_schema = T.StructType([T.StructField("tile", T.LongType()), T.StructField("label", label),
                                T.StructField("lo", T.ArrayType(T.DoubleType())), T.StructField("hi", T.ArrayType(T.DoubleType())),
                                T.StructField("x", T.BinaryType()), T.StructField("rep", T.ArrayType(T.LongType())), T.StructField("n", T.ArrayType(T.LongType()))])
    tile_arrow = to_arrow_schema(tile_schema)
    tiles = materialize(ordered.mapInArrow(cut, tile_schema), "tiles")

    # which tiles meet: equal cells of the first axis (as wide as a link), then the ranges of all leading axes
    cell = lambda c: F.floor(c / F.lit(side)).cast("long")
    boxes = tiles.select("tile", "label", "lo", "hi")
    left = boxes.select("tile", "label", "lo", "hi", F.explode(F.sequence(cell(F.col("lo")[0]), cell(F.col("hi")[0]))).alias("cell"))
    right = boxes.select(F.col("tile").alias("other"), F.col("label"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"),
                         F.explode(F.sequence(cell(F.col("lo")[0]) - 1, cell(F.col("hi")[0]) + 1)).alias("cell"))
    near = F.col("tile") <= F.col("other")
    for k in range(lead):
        near = near & (F.col("lo")[k] <= F.col("hi2")[k] + width) & (F.col("lo2")[k] <= F.col("hi")[k] + width)
    meets = left.join(right, ["label", "cell"]).where(near).select("tile", "other").distinct()
    a = tiles.select("tile", F.col("x").alias("x1"), F.col("rep").alias("rep1"), F.col("n").alias("n1"))
    b = tiles.select(F.col("tile").alias("other"), F.col("x").alias("x2"), F.col("rep").alias("rep2"), F.col("n").alias("n2"))
    pairs = materialize(meets, "meets").join(a, "tile").join(b, "other").select("tile", "other", "x1", "rep1", "n1", "x2", "rep2", "n2")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                x, y = (np.frombuffer(r[c], "<f8").reshape(-1, dim) for c in ("x1", "x2"))
                rep1, n1, rep2, n2 = (np.array(r[c], np.int64) for c in ("rep1", "n1", "rep2", "n2"))
                same = r["tile"] == r["other"]
                i, j = compare(x, y, _units(x) @ axes, _units(y) @ axes, threshold)
                if same:
                    i, j = i[i < j], j[i < j]
                reps = rep1 if same else np.concatenate([rep1, rep2])
                shift = 0 if same else len(rep1)
                links = np.bincount(i, n2[j], len(reps)).astype(np.int64) + np.bincount(j + shift, n1[i], len(reps)).astype(np.int64)
                lab = forest(len(reps), i, j + shift)
                low = np.full(len(reps), np.iinfo(np.int64).max)
                np.minimum.at(low, lab, reps)
                hit = links > 0
                yield pa.RecordBatch.from_arrays([pa.array(reps[hit]), pa.array(links[hit]), pa.array(low[lab][hit])], ["rep", "links", "root"])

    got = materialize(pairs.mapInArrow(meet, "rep long, links long, root long"), "links")
    return got.select("rep", "links"), got.select(F.col("rep").alias("a"), F.col("root").alias("b"))


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all embeddings."""
    return near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
