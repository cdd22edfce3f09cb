import zlib

import numpy as np
from conftest import SF001

from eventide.llm import quality_fm as Q


def test_factor_identity():
    rng = np.random.default_rng(0)
    m = Q.Model(0.5, 0.3, rng.normal(size=Q.SIZE).astype(np.float32), rng.normal(size=(Q.SIZE, 3)).astype(np.float32))
    rows = [Q.features("Some words, some more!! 12", None), Q.features(None, 3), Q.features("", 0)]
    for idx, val in rows:
        pairs = sum(float(m.factors[i] @ m.factors[j]) * float(a) * float(b)
                    for x, (i, a) in enumerate(zip(idx, val)) for j, b in list(zip(idx, val))[x + 1:])
        z = m.bias + float(m.linear[idx] @ val) + pairs
        assert abs(m.score([(idx, val)])[0] - 1 / (1 + np.exp(-z))) < 1e-3


def test_held_out_accuracy(spark):
    from eventide.llm.catalog import QUERIES
    got = {r.doc_id: r for r in QUERIES["op7_quality"](spark, "/root/testdata/sf0.1").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality is not null").collect()
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
    own = [(got[x.doc_id].predicted, x.quality) for x in labels if got[x.doc_id].held_out]
    assert sum(p == q for p, q in own) / len(own) > 0.97


def test_odd_rows_and_missing_labels(spark, docs):
    rows = [(1, None), (2, ""), (3, "x" * 300_000), (4, "퟿ é"), (4, "again"), (None, "no id")]
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = Q.train(docs(rows), labels)
    assert [r.score for r in Q.score(docs(rows), model).collect()] == [1.0] * 6     # nothing learnt: nothing rejected
    assert Q.keep_good(docs(rows), model).count() == 6
    some = spark.createDataFrame([(1, 1), (3, 0), (4, 1), (4, 0), (4, None), (77, 0)], labels.schema)
    model = Q.train(docs(rows), some)
    assert Q.score(docs(rows), model).count() == 6 and Q.score(docs([]), model).count() == 0
    kept = Q.keep_good(docs(rows), model)
    assert kept.columns == docs(rows).columns


def test_training_is_deterministic(spark):
    d, lab = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))
    a, b = Q.train(d, lab, 200), Q.train(d.repartition(5), lab.repartition(2), 200)
    assert np.array_equal(a.factors, b.factors) and a.bias == b.bias


def test_a_repeated_id_trains_once(spark, docs, monkeypatch):
    seen = []
    real = Q.fit
    monkeypatch.setattr(Q, "fit", lambda rows, labels: (seen.append(len(rows)), real(rows, labels))[1])
    rows = [(1, f"good text number {i}") for i in range(300)] + [(3, "bad"), (3, "bad"), (4, "fine words here")]
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, 1), (9, 0)], "doc_id long, quality int")
    a = Q.train(docs(rows), labels)
    b = Q.train(docs(rows).repartition(7), labels)
    assert seen == [3, 3] and np.array_equal(a.factors, b.factors)
