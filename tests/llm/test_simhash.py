import random

import numpy as np
import xxhash

from eventide.llm import common
from eventide.llm import simhash_vptree as S

from .slow import slow_classes, slow_simhash


TEXTS = ["", "one", "One TWO", "a b c", "É É x Éa b c d", "x\x0by\x0cz\x1cw v", "tie tie tie tie " * 40,
         "the quick brown fox jumps over the lazy dog " * 30]


def test_fingerprint_matches_the_definition(docs):
    rows = list(enumerate([*TEXTS, None]))
    got = {r["doc_id"]: r["fingerprint"] for r in S.near_duplicates(docs(rows)).collect()}
    assert got == {i: f"{slow_simhash(t or ''):016x}" for i, t in rows}


def test_jvm_hash_agrees(spark):
    row = spark.sql("select xxhash64('añ b c') h").first()
    assert row["h"] % 2**64 == xxhash.xxh64_intdigest("añ b c".encode(), 42)


def clustered(n, seed):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(max(1, n // 20))]
    out = []
    for _ in range(n):
        x = rng.choice(base)
        for _ in range(rng.choice([0, 1, 2, 3, 5])):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return out


def test_shards_find_every_link(spark):
    fps = clustered(500, 1) + [0] * 3 + [random.Random(5).getrandbits(64) for _ in range(200)]
    ids = list(range(len(fps)))
    random.Random(2).shuffle(ids)
    df = spark.createDataFrame([(i, f - (f >> 63 << 64)) for i, f in zip(ids, fps)], "doc_id long, fp long")
    want = slow_classes(ids, fps)
    for leaf, sample in ((8, 400), (40, 100_000), (10_000, 10)):
        got = {r["doc_id"]: r["component_id"] for r in S.classes(df, leaf_rows=leaf, sample=sample).collect()}
        assert got == want


def test_local_links_by_recursion():
    S_BLOCK, S.BLOCK = S.BLOCK, 16
    try:
        fps = np.array(clustered(600, 3), np.uint64)
        lab = S.link(fps, np.ones(len(fps), bool), 2)
    finally:
        S.BLOCK = S_BLOCK
    want = slow_classes(range(len(fps)), [int(x) for x in fps])
    assert [want[i] for i in range(len(fps))] == lab.tolist()


def test_empty_and_repeated(docs, spark):
    assert S.near_duplicates(docs([])).count() == 0
    got = S.near_duplicates(docs([(5, "a b c d"), (5, "a b c d"), (3, "A B c\td"), (9, None), (7, " "), (None, "x")])).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(3, 3), (5, 3), (5, 3), (7, 7), (9, 7)]


def test_components_of_long_chains(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1000 + k) for k in range(1, 50)] + [(7, 7)],
                                  "a long, b long")
    got = {r["node"]: r["component"] for r in common.components(edges, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, **{1000 + k: 1000 for k in range(50)}}
