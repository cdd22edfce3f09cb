import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from eventide.llm import suffix_dedup as D


def slow(rows, window):
    """``(id, bytes, removed, spans, sha)`` by counting every string."""
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i:i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for (i, _), d in zip(rows, data):
        gone = np.zeros(len(d) + 1, bool)
        for at in range(len(d) - window + 1):
            if seen[d[at:at + window]] > 1:
                gone[at:at + window] = True
        g = gone[:-1]
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[:len(d)]).sum())
        kept = bytes(b for b, x in zip(d, g) if not x)
        out.append((i, len(d), int(g.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(df, window, **kw):
    return sorted((tuple(r)[:5] for r in D.remove_repeats(df, window=window, **kw).collect()), key=repr)


def corpus(seed, n, window):
    rng = random.Random(seed)
    passage = "".join(rng.choice("abcdé ") for _ in range(3 * window))
    line = "".join(rng.choice("xyz") for _ in range(window + 5))
    rows = []
    for i in range(n):
        t = "".join(rng.choice("abcdefghijklmnop qrstuvé") for _ in range(rng.choice([0, 5, window - 1, window, 4 * window, 12 * window])))
        kind = rng.randrange(8)
        if kind == 0:
            lo = rng.randrange(window)
            at = rng.randrange(len(t) + 1)
            t = t[:at] + passage[lo:lo + rng.randrange(3 * window)] + t[at:]
        elif kind in (1, 2, 3):
            t = t + line + t[:7]
        elif kind == 4 and rows:
            t = rng.choice(rows)[1] or ""
        elif kind == 5:
            t = rng.choice("ab") * rng.randrange(3 * window) + t
        elif kind == 6 and rows:
            x = rng.choice(rows)[1] or "q"
            at = rng.randrange(len(x) + 1)
            t = x[:at] + "#" + x[at:]
        rows.append((i, t))
    return rows + [(n, None), (n + 1, ""), (n + 2, passage * 3), (n + 2, passage * 3), (n + 2, line), (None, "n" * window), (None, None)]


@pytest.mark.parametrize("seed,window,gram,kw", [(1, 30, 8, {}), (2, 30, 8, {"split": 4, "shard_bytes": 2000}), (3, 200, 50, {"split": 3}),
                                                 (4, 16, 16, {"shard_bytes": 1})])
def test_against_brute_force(docs, seed, window, gram, kw):
    rows = corpus(seed, 120, window)
    want = slow(rows, window)
    assert sum(r[2] > 0 for r in want) > 20
    assert run(docs(rows), window, gram=gram, **kw) == want


def test_text_longer_than_a_part(docs):
    old, D.PART = D.PART, 900
    try:
        rows = corpus(6, 60, 30)
        rows.append((500, "".join(random.Random(1).choice("abc") for _ in range(5000)) + rows[3][1]))
        assert run(docs(rows), 30, gram=8) == slow(rows, 30)
    finally:
        D.PART = old


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(1)
    segs = [bytes(rng.integers(97, 99, rng.integers(20, 60)).astype(np.uint8)) for _ in range(30)] + [b"\0" * 40, b"a" * 50]
    window = 12
    n = np.array([len(s) - window + 1 for s in segs])
    where, group = D.shard_classes(segs, n, window)
    strings = [s[i:i + window] for s in segs for i in range(len(s) - window + 1)]
    assert sorted(where.tolist()) == list(range(len(strings)))
    assert [strings[w] for w in where] == sorted(strings)
    for (w, g), (w2, g2) in zip(zip(where, group), list(zip(where, group))[1:]):
        assert (g == g2) == (strings[w] == strings[w2])


def test_kept_text_and_empty_table(docs):
    rows = [(1, "A" * 150 + "é" * 200 + "x"), (2, "é" * 200 + "y"), (3, "short")]
    got = {r.doc_id: r for r in D.remove_repeats(docs(rows), keep_text=True).collect()}
    assert bytes(got[1].kept) == b"A" * 150 + b"x" and bytes(got[2].kept) == b"y" and bytes(got[3].kept) == b"short"
    assert D.remove_repeats(docs([])).count() == 0
