import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from eventide.llm import importance as I

ODD = ["", "A b C", "one-two__three  four\n5six", "É é ÉCOLE naïve 日本 x日", "\x00\x7f{}~ a", "z" * 500, "a " * 300, "ß ſ K", " ", "…—“”"]


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def grams(text, most):
    w = words_of(text)
    return [" ".join(w[i:i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)]


def slow(docs, target, buckets=10_000, most=1, percent=10, least=20, seed=2024):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s = Counter(bucket(g) for _, t in docs for g in grams(t, most))
    t = Counter(bucket(g) for x in target for g in grams(x, most))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    rows = []
    for k, (i, x) in enumerate(docs):
        g = grams(x, most)
        w = sum(gain(bucket(f)) for f in g)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(g), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(x))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


@pytest.mark.parametrize("size", [0, 3, 1000])
def test_payloads_and_composition(size):
    rng = random.Random(6)
    texts = ODD + [" ".join(rng.choice(["alpha", "Beta", "é", "x" * 70, "7", "日本語"]) for _ in range(rng.randrange(60))) for _ in range(40)]
    known = [w.encode() for w in sorted({w for t in texts for w in words_of(t)})][:size]
    buffer, docs = I.delimited([t.encode() for t in texts])
    starts, ends = I.word_bounds(buffer)
    payloads = I.Dictionary(known).payloads(buffer, starts, ends)
    assert [(p & 0xFFFFFFFF, p >> 32) for p in payloads.tolist()] == [(zlib.crc32(w.encode()), len(w.encode())) for t in texts for w in words_of(t)]
    cut = np.searchsorted(starts, docs + 1)
    last = np.repeat(cut[1:], np.diff(cut))
    for n, (first, crc) in enumerate(I.compose(payloads, last, 4), 1):
        want = [zlib.crc32(" ".join(w[i:i + n]).encode()) for w in map(words_of, texts) for i in range(len(w) - n + 1)]
        assert crc.tolist() == want


def test_scan_in_windows(monkeypatch):
    text = ("some words of a text " * 2000 + "y" * 5000 + " end").encode()
    buffer, _ = I.delimited([text])
    starts, ends = I.word_bounds(buffer)
    whole = I.Dictionary([b"some", b"text", b"end"]).payloads(buffer, starts, ends)
    for window in (1, 100, 4096):
        monkeypatch.setattr(I, "WINDOW", window)
        assert (I.Dictionary([b"some", b"text", b"end"]).payloads(buffer, starts, ends) == whole).all()


def made(n, seed):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(200)] + ["Été", "日本", "x-y"]
    return [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("most,buckets,dictionary", [(1, 10_000, 65_536), (2, 500, 10), (3, 100_000, 0)])
def test_against_the_definition(spark, docs, most, buckets, dictionary):
    given = made(300, 7) + [(None, "no id " * 30), (1000, None), (1001, ""), (1002, "...")] + [(2000, "same text of it " * 9)] * 3 + [(3000, "long text " * 40_000)]
    target = spark.createDataFrame([(t,) for _, t in made(20, 8)] + [(None,)], "text string")
    rows = I.resample(docs(given), target, buckets=buckets, max_words=most, dictionary=dictionary)
    got = sorted((tuple(r) for r in rows.collect()), key=repr)
    assert got == slow(given, [r.text for r in target.collect()], buckets, most)


def test_shares_seeds_and_empty_tables(spark, docs):
    given = made(100, 9)
    target = spark.createDataFrame([("w1 w2 w3",)], "text string")
    got = sorted((tuple(r) for r in I.resample(docs(given), target, percent=50, min_words=5, seed=3).collect()), key=repr)
    assert got == slow(given, ["w1 w2 w3"], percent=50, least=5, seed=3)
    assert I.resample(docs([]), target).count() == 0
    none = target.where("false")
    assert sorted((tuple(r) for r in I.resample(docs(given), none).collect()), key=repr) == slow(given, [])
    with pytest.raises(ValueError):
        I.resample(docs(given), target, buckets=1 << 23)


def test_target_like_documents_are_drawn(spark, docs):
    given = [(i, " ".join(["common"] * 40 + [f"n{i % 7}"])) for i in range(400)] + [(1000 + i, "rare words of the target text " * 5) for i in range(40)]
    rows = I.resample(docs(given), spark.createDataFrame([("rare words of the target text",)], "text string")).where("rank is not null").collect()
    assert len(rows) == 44 and sum(r.doc_id >= 1000 for r in rows) == 40
