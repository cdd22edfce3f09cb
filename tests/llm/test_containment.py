import random

from eventide.llm import containment as C
from eventide.llm.catalog import ORACLE_SQL, QUERIES
from conftest import SF001

rng = random.Random(4)
VOCAB = [f"w{i}" for i in range(400)]


def passage(n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def slow(docs, items):
    out = set()
    for d, t in docs:
        for i, x in set(items):
            s, words = C.shingles(x or ""), C.words_of(t or "")
            n = min(5, len(C.words_of(x or "")))        # a short item is looked for whole
            own = {" ".join(words[k:k + n]) for k in range(len(words) - n + 1)}
            if d is not None and i is not None and s and len(s & own) >= 0.8 * len(s) - 1e-9:
                out.add((d, i, len(s), len(s & own)))
    return out


def test_against_brute_force(spark, docs):
    items = [(i, passage(rng.choice([3, 5, 6, 9, 20, 60]))) for i in range(40)] + [(90, None), (91, ""), (92, "!?"), (None, "a b c")]
    items += [items[0], items[5]]
    texts = []
    for k in range(60):
        words = passage(rng.choice([0, 4, 50, 2000])).split()
        if k % 2:
            part = (items[rng.randrange(40)][1]).upper().split()
            if k % 4 == 1 and len(part) > 12:     # a changed word costs up to five shingles
                part[rng.randrange(len(part))] = "changed"
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        texts.append((k, ",\n".join(words)))
    texts += [(100, None), (101, ""), (None, items[3][1]), (102, items[0][1]), (102, items[0][1])]
    df, ben = docs(texts), spark.createDataFrame(items, "item_id long, text string")
    for block in (C.BLOCK_BYTES, 700):
        got = [(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in C.contained_items(df, ben, block_bytes=block).collect()]
        assert set(got) == slow(texts, items)
        assert len(got) == len(set(got)) + sum(1 for x in set(got) if x[0] == 102)
        kept = C.decontaminate(df, ben, block_bytes=block)
        assert kept.columns == df.columns
        bad = {x[0] for x in slow([(i if i is not None else -1, t) for i, t in texts], items)}
        assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, t in texts if (i if i is not None else -1) not in bad)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert C.contained_items(docs([(1, "a b c d e f")]), none).count() == 0
    assert C.contained_items(docs([]), spark.createDataFrame([(1, "a b c d e f")], none.schema)).count() == 0
    assert C.decontaminate(docs([(1, None)]), none).count() == 1


def test_query_matches_sql(spark):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    want = con.execute(ORACLE_SQL["op8_containment"]).fetchall()
    got = [tuple(r) for r in QUERIES["op8_containment"](spark, SF001).collect()]
    assert sorted(got) == sorted(want) and got


def test_short_items_in_long_texts(docs, spark):
    long = " ".join(f"w{k}" for k in range(200_000))
    items = spark.createDataFrame([(1, "needle"), (2, "Two, words"), (3, "w5 w6 w7 w8"), (4, "w199998 w199999 x"), (5, "absent"), (6, "a b c d e f")], "item_id long, text string")
    df = docs([(1, long + " Needle " + long), (2, "two words"), (3, "words two"), (4, "a b c d"), (5, "z a b c d e f")])
    got = {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in C.contained_items(df, items).collect()}
    assert got == {(1, 1, 1, 1), (1, 3, 1, 1), (2, 2, 1, 1), (5, 6, 2, 2)}
    assert [r.doc_id for r in C.decontaminate(df, items).orderBy("doc_id").collect()] == [3, 4]
