import math

import numpy as np
import pytest

from eventide.llm import pca_tiles as P

NAN, INF = float("nan"), float("inf")


def slow(rows, threshold=0.98):
    """``id -> (links, smallest reachable)`` over rows (id, vector, label)."""
    def usable(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    adj = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            (_, a, la), (_, b, lb) = rows[i], rows[j]
            if la is not None and la == lb and usable(a) and usable(b) and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                if a == b or float(P.cosines(x[None], y[None])[0]) >= threshold:
                    adj[i].append(j)
                    adj[j].append(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in adj[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((rows[i][0], len(adj[i]), min(rows[j][0] for j in seen)))
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, lab, "x", 7) for i, v, lab in rows],
                               "vec_id long, embedding array<float>, label int, rep string, tile int").repartition(3)
    got = P.near_duplicates(df, **kw).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    return sorted((r.vec_id, r.n_links, r.component_id) for r in got)


def vectors(n, dim, seed, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(2, n // 15), dim))
    x = centres[rng.integers(0, len(centres), n)] * rng.uniform(0.5, 3, (n, 1)) + rng.normal(size=(n, dim)) * spread
    x = x.astype(np.float32)
    x[n // 3] = x[0]
    x[n // 2] = x[0]
    order = rng.permutation(n)
    return [(int(order[i]), [float(v) for v in x[i]], int(rng.integers(0, 3)) if i > n // 2 else 0) for i in range(n)]


@pytest.mark.parametrize("n,dim,tile", [(400, 16, 20), (300, 64, 512), (150, 3, 7)])
def test_against_brute_force(spark, n, dim, tile):
    rows = vectors(n, dim, n, 0.12)
    want = slow(rows)
    assert any(links > 1 for _, links, _ in want) and any(links == 0 for _, links, _ in want)
    assert run(spark, rows, tile=tile) == want


def test_odd_vectors(spark):
    a = [1.0, 2.0, 3.0]
    rows = [(1, a, 1), (2, [2.0, 4.0, 6.0], 1), (3, a, 2), (4, a, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1),
            (8, [NAN, 1.0, 1.0], 1), (9, [INF, 1.0, 1.0], 1), (10, [1.0, None, 3.0], 1), (11, [1.0, 2.0], 1), (12, [0.0, -0.0, 1.0], 3),
            (13, [-0.0, 0.0, 2.0], 3), (14, [-1.0, -2.0, -3.0], 1), (15, a, 2), (16, [1e-30, 2e-30, 3e-30], 1), (17, [1e30, 2e30, 3e30], 1)]
    assert run(spark, rows) == slow(rows)
    twice = P.near_duplicates(spark.createDataFrame([(1, a, 1), (1, a, 1), (None, a, 1)], "vec_id long, embedding array<float>, label int"))
    assert [(r.vec_id, r.n_links, r.component_id) for r in twice.collect()] == [(1, 1, 1)] * 2


def test_empty_table(spark):
    for v in ([], [(3, None, 1)]):
        df = spark.createDataFrame(v, "vec_id long, embedding array<float>, label int")
        assert [(r.vec_id, r.n_links) for r in P.near_duplicates(df).collect()] == [(i, 0) for i, _, _ in v]


def test_query_against_brute_force(spark):
    from eventide.llm.catalog import QUERIES
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in QUERIES["op3_embeddings"](spark, sf).collect())
    assert got == slow(rows)


def test_bound_prunes_without_loss():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 40))
    y = x[rng.integers(0, 60, 50)] + rng.normal(size=(50, 40)) * 0.2
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    i, j = P.compare(x, y, P._units(x) @ q, P._units(y) @ q, 0.97)
    full = np.array([[P.cosines(a[None], b[None])[0] for b in y] for a in x])
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(k.tolist() for k in np.nonzero(full >= 0.97)))) and len(i)
