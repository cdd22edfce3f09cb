"""Training-corpus pipeline over ``documents``: five stages, each written to
the shared folder and read again as the next one's input.

1. quality: documents the factorisation machine rejects go;
2. near_duplicates: of each SimHash class one row stays, of those with the smallest
   id; classes are of rows, so different texts that share an id do not replace
   each other;
3. decontamination: documents that contain a benchmark item go;
4. secrets: every span found is replaced by a mark, no document goes;
5. packing: pieces of token sequences, sources mixed.

Stages 1 to 4 return the columns they are given.  Null and empty texts pass
them by the operators' rules, very long ones whole; columns may have any name and type; documents without an id are kept by every stage
that drops by id; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import containment, packing, quality_fm, secrets, simhash_vptree
from eventide.llm.common import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score 0.7 or more."""
    model = quality_fm.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality_fm.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class; rows without an id are kept.

    Rows are told apart by id and a hash of all columns: an id that occurs with
    several texts is in the class of each, and links nothing."""
    row = "_row"
    while row in docs.columns:      # a name of no column of the input
        row += "_"
    hashed = [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in docs.schema.fields]
    keyed = docs.withColumn(row, F.xxhash64(*[x for c, f in zip(hashed, docs.columns) for x in (c, F.col(f).isNull())]))
    rows = materialize(simhash_vptree.fingerprints(keyed.where("doc_id is not null"), keep=(row,)), "rows")
    best = rows.groupBy("fp").agg(F.min(F.struct("doc_id", row)).alias("_best"))
    classes = simhash_vptree.classes(best.select(F.col("fp").alias("doc_id"), "fp"))     # nodes are texts, not ids
    first = materialize(best.join(classes.select("fp", "component_id"), "fp").groupBy("component_id").agg(F.min("_best").alias("_best"))
                        .select("_best.*"), "first")
    repeated = materialize(rows.groupBy("doc_id", row).count().where("count > 1").join(first, ["doc_id", row], "left_semi")
                           .select("doc_id", row), "repeated")
    kept = keyed.join(first, ["doc_id", row], "left_semi")
    if not repeated.isEmpty():      # rows equal in every column: one of them
        twice = kept.join(repeated, ["doc_id", row], "left_semi").groupBy("doc_id", row).agg(
            F.first(F.struct(*[c for c in docs.columns if c != "doc_id"])).alias("_cols"))
        kept = (kept.join(repeated, ["doc_id", row], "left_anti").select(docs.columns)
                .unionByName(twice.select("doc_id", "_cols.*").select(docs.columns)))
    return kept.select(docs.columns).unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that contain no benchmark item."""
    return containment.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", without_secrets), ("packing", pack)]

# Trained, hashed and tokenised results cannot be said in SQL; tests/llm checks
# the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
