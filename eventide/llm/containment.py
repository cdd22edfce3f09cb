"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle set.  An item with ``n``
distinct shingles is contained at ``threshold`` if at least ``need =
ceil(threshold * n)`` of them occur in a document, so any ``n - need + 1`` of
its shingles include one that occurs.  Those with the smallest hashes, the
item's bottom MinHash sketch, are looked up in every document: short items are
found in documents of any length, with no missed pair.  An item of fewer words
than a shingle is looked up whole, among the document's runs of as many words.
A document smaller than a partition's least ``need`` skips the partition.  Each
candidate is then verified by exact containment over the shingles themselves.

Documents are read once and never shuffled.  The items are a stated query set:
blocks of bounded size are broadcast one after the other.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Shared, ship_by_value, slices, table

ship_by_value()

SHINGLE = 5
THRESHOLD = 0.8
BLOCK_BYTES = 8_000_000     # item text broadcast at a time

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def runs(words: list[str], size: int) -> set[str]:
    """Distinct runs of ``size`` words."""
    return set(map(" ".join, zip(*(words[i:] for i in range(size)))))


def shingles(text: str, size: int = SHINGLE) -> set[str]:
    """Distinct shingles of lower-cased letter and digit words; a text with
    fewer words is one shingle, one without any has none."""
    words = words_of(text)
    if len(words) <= size:
        return {" ".join(words)} if words else set()
    return runs(words, size)


class Searcher:
    """The items of one block: their shingles and, by size class, the sketches."""

    def __init__(self, items: list[tuple[int, str]], threshold: float, size: int):
        self.threshold, self.size = threshold, size
        self.sets = [(i, s) for i, t in items if (s := shingles(t or "", size))]
        classes: dict[int, dict] = {}
        self.short: dict[int, dict[str, list[int]]] = {}        # items of fewer words than a shingle, by their number
        for k, (_, s) in enumerate(self.sets):
            words = next(iter(s)).count(" ") + 1
            if words < size:
                self.short.setdefault(words, {}).setdefault(next(iter(s)), []).append(k)
                continue
            need = math.ceil(threshold * len(s) - 1e-9)
            part = classes.setdefault(len(s).bit_length(), {"need": need, "sketch": defaultdict(list)})
            part["need"] = min(part["need"], need)
            for x in sorted(s, key=lambda x: (xxhash.xxh64_intdigest(x), x))[:len(s) - need + 1]:
                part["sketch"][x].append(k)
        self.parts = [(p["need"], dict(p["sketch"])) for p in classes.values()]

    def find(self, text: str | None) -> list[tuple[int, int, int]]:
        """``(item_id, shingles of the item, of them in the text)``."""
        words = words_of(text or "")
        own = runs(words, self.size)
        found = set()
        for need, sketch in self.parts:
            if len(own) >= need:
                found.update(k for x in sketch.keys() & own for k in sketch[x])
        out = []
        for size, known in self.short.items():
            out += [(self.sets[k][0], 1, 1) for x in known.keys() & runs(words, size) for k in known[x]]
        for k in sorted(found):
            item, s = self.sets[k]
            shared = len(s & own)
            if shared >= self.threshold * len(s) - 1e-9:
                out.append((item, len(s), shared))
        return out


def _blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    rows = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where("i is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield [(r["i"], r["t"]) for r in part.collect()]


def contained_items(docs: DataFrame, items: DataFrame, doc_col: str = "doc_id", doc_text: str = "text",
                    item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD,
                    size: int = SHINGLE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, item_id, n_item, n_shared, containment)`` for every document
    that holds at least ``threshold`` of an item's distinct shingles.

    Null texts are empty and match nothing; very long ones are searched whole,
    in memory in proportion to them; rows with a null id are left out;
    repeated item rows count once, repeated documents each; other columns are
    ignored; empty tables give no rows.
    """
    schema = "doc_id long, item_id long, n_item long, n_shared long"
    src = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.col(doc_text).cast("string").alias("text")).where("doc_id is not null")
    out = None
    for block in _blocks(items, item_col, item_text, block_bytes):
        shared = Shared(docs.sparkSession, Searcher(block, threshold, size))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                rows = [(d, *hit) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                        for hit in shared.value.find(t)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else
                                                 [pa.array([], pa.int64())] * 4, ["doc_id", "item_id", "n_item", "n_shared"])

        part = src.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def decontaminate(docs: DataFrame, items: DataFrame, doc_text: str = "text", item_col: str = "item_id",
                  item_text: str = "text", threshold: float = THRESHOLD, size: int = SHINGLE,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, all columns, that contain no item; one pass per block."""
    where = docs.columns.index(doc_text)
    for block in _blocks(items, item_col, item_text, block_bytes):
        shared = Shared(docs.sparkSession, Searcher(block, threshold, size))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                yield b.filter(pa.array([not shared.value.find(t) for t in b.column(where).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op8_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items contained in documents, all against all documents."""
    return contained_items(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
with d as (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') w from documents where doc_id is not null),
     i as (select distinct item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') w from benchmark where item_id is not null),
     k as (select 5 k union select distinct len(w) from i where len(w) between 1 and 4),
     ds as (select distinct doc_id, array_to_string(w[x:x+k-1], ' ') s
            from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) x from d, k)),
     its as (select distinct item_id, array_to_string(w[x:x+4], ' ') s
             from (select item_id, w, unnest(range(1, greatest(2, len(w) - 3))) x from i where len(w) > 0)),
     n as (select item_id, count(*) n_item from its group by 1),
     m as (select doc_id, item_id, count(*) n_shared from ds join its using (s) group by 1, 2)
select doc_id, item_id, n_item, n_shared, n_shared / n_item as containment
from m join n using (item_id) where n_shared >= 0.8 * n_item - 1e-9
"""
