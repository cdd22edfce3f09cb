from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as C
from conftest import SF001
from eventide.llm import containment, packing, secrets

from .slow import slow_classes, slow_simhash


def test_stages_in_order():
    assert [n for n, _ in C.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]


def test_each_stage_on_its_input(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    extra = docs.limit(0).collect()
    assert extra == []
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    kept = {}
    for name, stage in C.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SF001)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out = C.materialize(out, "t")
        after = out.collect()
        if name == "quality":
            gone = before.keys() - {r.doc_id for r in after}
            known = [i for i in before if labels.get(i) is not None]
            assert sum((i in gone) == (labels[i] == 0) for i in known) / len(known) > 0.97
        elif name == "near_duplicates":
            ids = list(before)
            low = slow_classes(ids, [slow_simhash(before[i].text) for i in ids])
            assert sorted(r.doc_id for r in after) == sorted(set(low.values())) and len(after) < len(before)
        elif name == "decontamination":
            search = containment.Searcher(items, 0.8, 5)
            assert {r.doc_id for r in after} == {i for i, r in before.items() if not search.find(r.text)}
            assert len(after) < len(before)
        elif name == "secrets":
            rules = secrets.scan(docs)[1]
            assert {r.doc_id: r.text for r in after} == {i: rules.redact(r.text) for i, r in before.items()}
            assert all(r.n_chars == len(r.text) for r in after)
        else:
            tokens = Counter()
            for r in after:
                tokens[r.doc_id] += r.length
            encode = packing.Encoder(None)
            assert tokens == Counter({i: len(encode.encode([r.text])[0]) // 2 for i, r in before.items()})
        kept[name] = len(after)
        docs = out
    assert kept["near_duplicates"] >= kept["decontamination"] == kept["secrets"]


def test_run_gives_the_same_rows_again(spark):
    a, b = (sorted(map(tuple, C.run(spark, "/root/testdata/sf0.001").collect())) for _ in range(2))
    assert a == b and a


def test_odd_documents(spark, docs, tmp_path):
    rows = [(1, None), (2, ""), (3, "same text here " * 9), (3, "same text here " * 9), (4, "same text here " * 9),
            (None, "no id"), (None, None), (5, "y" * 200_000)]
    df = docs(rows)
    docs_like = C.near_duplicates(spark, df, "")
    assert docs_like.columns == df.columns
    assert sorted(str(r.doc_id) for r in docs_like.collect()) == ["1", "3", "5", "None", "None"]
    empty = docs([])
    assert C.near_duplicates(spark, empty, "").count() == 0
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for table in (df, empty):
        for name, stage in C.STAGES:
            out = stage(spark, table, str(tmp_path))
            assert (out.count() > 0) == (table is df), name


def test_ids_with_several_texts_keep_one_row_of_each_class(spark, docs):
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(60)) for w in "abcd")
    rows = [(3, a), (5, a), (5, b), (7, b), (9, b),         # 5 is a copy of 3, and has a text of its own
            (20, c), (20, d), (21, c), (22, d), (22, d)]    # two unrelated texts with the smallest id of their class
    got = C.near_duplicates(spark, docs(rows), "")
    assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted([(3, a), (5, b), (20, c), (20, d)])
    assert C.near_duplicates(spark, docs(rows * 3), "").count() == 4


def test_rows_that_differ_in_nulls_only_are_told_apart(spark, docs):
    df = docs([(1, "x y z"), (1, "x y z")], langs={1: "x"}).withColumn("source", F.lit(None).cast("string"))
    other = df.withColumn("source", F.col("lang")).withColumn("lang", F.lit(None).cast("string"))
    assert C.near_duplicates(spark, df.unionByName(other), "").count() == 1


def test_columns_of_any_name_and_type(spark):
    """A column named like the stage's own, and maps, come back as they went in."""
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(1, text, "a", {"x": 1}), (2, text, "b", {"x": 2}), (3, "other words " * 9, "c", None), (3, "other words " * 9, "c", None), (None, text, "d", {})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string, tags map<string,int>")
    out = C.near_duplicates(spark, docs, SF001)
    assert out.dtypes == docs.dtypes
    got = sorted(((r.doc_id, r._row, r.tags) for r in out.collect()), key=repr)
    assert got == sorted([(1, "a", {"x": 1}), (3, "c", None), (None, "d", {})], key=repr)
