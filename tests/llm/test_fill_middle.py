import hashlib
import random

import pytest

from eventide.llm import fill_middle as M

SF = "/root/testdata/sf0.01"


def slow(doc_id, text, seed=1, rate=90, spm=20, marks=("<P>", "<S>", "<M>")):
    """The definition, on plain strings."""
    text = text or ""
    d = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not text or any(m in text for m in marks) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm:
        return n, "spm", a, b - a, marks[1] + suf + marks[0] + pre + marks[2] + mid
    return n, "psm", a, b - a, marks[0] + pre + marks[1] + suf + marks[2] + mid


def test_table_against_strings():
    rng = random.Random(5)
    for _ in range(500):
        text = "".join(rng.choice("ab<>PSM é日😀\n") for _ in range(rng.randrange(30)))
        doc = rng.randrange(10**6)
        t, form, a, m = M.arrange(doc, text)
        assert (len(text), form, a, m, t.text()) == slow(doc, text)
        assert b"".join(t.blocks()) == t.text().encode()
        back = M.restore(t.text(), form)
        assert back.text() == text and back.sha256() == hashlib.sha256(text.encode()).hexdigest()


def test_cut_splits_descriptors_and_keeps_contents():
    t = M.PieceTable("abcdef", "XY")
    t.insert(0, 0, 2)
    t.cut(1, 4, 4, 8)
    assert t.text() == "XYabcdef" and (M.TEXT, 2, 0) in t.rows and (M.MARKS, 0, 1) in t.rows
    t.permute(tuple(reversed(range(len(t.rows)))))
    t.permute(M.inverse(tuple(reversed(range(len(t.rows))))))
    assert t.text() == "XYabcdef"
    assert all(b in (M.TEXT, M.MARKS) for b, _, _ in t.rows) and t.buffers == ("abcdef", "XY")


def test_digests_go_by_blocks(monkeypatch):
    text = "é日😀x" * 50_000
    want = slow(4, text)[4]
    monkeypatch.setattr(M, "BLOCK", 1000)
    t, form, _, _ = M.arrange(4, text)
    assert max(map(len, t.blocks())) <= 4000
    assert t.sha256() == hashlib.sha256(want.encode()).hexdigest()
    assert M.restore(want, form).sha256() == hashlib.sha256(text.encode()).hexdigest()


def test_sentinels_that_could_be_misread():
    for bad in (("", "b", "c"), ("ab", "b", "c"), ("aa", "b", "c"), ("<P>", "<P>", "<M>")):
        with pytest.raises(ValueError):
            M.fill_middle(None, sentinels=bad)


def test_rows(docs):
    given = [(1, "plain text of some length"), (2, None), (3, ""), (4, "has <S> inside"), (None, "no id at all"), (5, "same"), (5, "same"),
             (6, "long é " * 40_000), (7, "x"), *((i, f"document {i} with words") for i in range(10, 150))]
    marks = ("[a]", "[b]", "[c]")
    for kw, own in (({}, {}), ({"sentinels": marks, "rate": 100, "spm": 50, "seed": 9}, {"marks": marks, "rate": 100, "spm": 50, "seed": 9})):
        rows = M.fill_middle(docs(given), **kw)
        got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows.collect()), key=repr)
        assert got == sorted(((i, *slow(i, t, **own)) for i, t in given), key=repr)
        back = M.restored(rows, **({"sentinels": marks} if kw else {}))
        assert sorted(((r.doc_id, r.restored) for r in back.collect()), key=repr) == sorted(((i, t or "") for i, t in given), key=repr)
        assert {r[0] for r in rows.select("form").distinct().collect()} == {"plain", "psm", "spm"}
    assert M.restored(M.fill_middle(docs([]))).count() == 0


def test_query(spark):
    src = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {i: (*slow(i, t)[:4], sha(slow(i, t)[4]), sha(t or "")) for i, t in src.items()}
    assert {r[0]: tuple(r)[1:] for r in M.op12_fill_middle(spark, SF).collect()} == want
