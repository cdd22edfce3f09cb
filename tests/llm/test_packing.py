import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from eventide.llm import packing as P

ODD = ["it's I'LL we've'd x", "a1b22c3", "É,é! İ. İstanbul, ß.", "é. ́x ≮ ≠", "<|endoftext|> a<|startoftext|>b <|x|>",
       "\x1ca\x1c b\x0bc\x0cd\x85e f g", "日本語。テスト 한국어!", "don’t “quote” — dash…", "A\tB\r\nC   D", "'s's 's",
       "ſtrange Kelvin", "Σίσυφος ΣΟΦΟΣ.", " ", "", "x" * 5000, "\U0001f600‍\U0001f600!?", "ﬁne ǅ.", "1²③ Ⅻ"]


@pytest.fixture(scope="module")
def encoder():
    return P.Encoder(None)


def want_ids(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [P.END_ID]


def test_ids_are_the_tokenizers(encoder):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("aB'st9 .,é\ńİ<|>") for _ in range(60)) for _ in range(300)]
    for t, got in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(got, encoder.kind).tolist() == want_ids(encoder, t), t


def test_memory_is_bounded_by_bytes(encoder, monkeypatch):
    """Whatever the limit, ids are the tokenizer's; texts without blanks, whole
    words to the encoder, are not kept."""
    monkeypatch.setattr(P, "CACHE_BYTES", 10)
    e = P.Encoder(None)
    for t in ODD:
        assert np.frombuffer(e.encode([t])[0], e.kind).tolist() == want_ids(encoder, t)
    monkeypatch.setattr(P, "CACHE_BYTES", 20_000)
    rng = random.Random(8)
    e, most = P.Encoder(None), 0
    for k in range(60):
        texts = ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(4000)), "x" * 5000 + str(k),
                 " ".join(f"w{rng.randrange(10**6)}é" for _ in range(20)), " ".join(f"日{rng.randrange(10**6)}" for _ in range(20))]
        for t, got in zip(texts, e.encode(texts)):
            assert np.frombuffer(got, e.kind).tolist() == want_ids(encoder, t)
        kept = [*e.plain.items(), *e.words.items()]
        assert all(len(w) <= P.LONG for w, _ in kept)
        size = sum(len(w) + len(i) + P._ENTRY for w, i in kept)
        assert size == e.plain.held + e.words.held
        most = max(most, size)
    assert most < 2 * 20_000


def check(rows, texts, encoder, length):
    """Every id once, sequences gapless, all but a few full, checksums right."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    want = defaultdict(list)
    for i, t in texts:
        want[i].append(want_ids(encoder, t))
    assert by_doc.keys() == want.keys()
    for i, own in by_doc.items():
        if len(want[i]) == 1:
            ids, at = want[i][0], 0
            for r in sorted(own, key=lambda r: r.start):
                assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
                assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
                at += r.length
            assert at == len(ids)
        assert sum(r.length for r in own) == sum(map(len, want[i]))
    sizes = []
    for s in range(len(by_seq)):
        at = 0
        for r in sorted(by_seq[s], key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        sizes.append(at)
    total = sum(len(x) for own in want.values() for x in own)
    assert sizes == [length] * (total // length) + [1 << b for b in range(20, -1, -1) if total % length >> b & 1]
    return by_seq, total


def corpus(seed, n=60):
    rng = random.Random(seed)
    texts = [(i, " ".join(rng.choice(["the", "of", "word", "9", "éa"]) for _ in range(rng.choice([0, 3, 40, 700])))) for i in range(n)]
    sources = {i: "hot" if i % 3 == 0 else None if i % 7 == 1 else f"s{i % 4}" for i in range(n)}
    return texts, sources


@pytest.mark.parametrize("length,quantum", [(64, 16), (256, 100), (32, 70)])
def test_round_trip(spark, docs, encoder, length, quantum):
    texts, sources = corpus(length)
    texts += [(1000, None), (1001, "a a"), (1001, "b"), (1001, "b")]
    check(P.pack(docs(texts, sources=sources), length=length, quantum=quantum).collect(), texts, encoder, length)


def test_windows_hold_the_mixture(spark, docs, encoder):
    texts, sources = corpus(8, 300)
    length, quantum = 512, 16
    rows = P.pack(docs(texts, sources=sources), length=length, quantum=quantum).collect()
    by_seq, total = check(rows, texts, encoder, length)
    share = defaultdict(int)
    for r in rows:
        share[r.source] += r.length / total
    for s in range(total // length):
        held = defaultdict(int)
        for r in by_seq[s]:
            held[r.source] += r.length
        for k, p in share.items():
            # a source is ahead or behind by less than a quantum at either end, and by what others' quanta are off
            assert abs(held[k] - p * length) <= 2 * quantum + quantum * len(share)


def test_given_shares(spark, docs, encoder):
    texts, sources = corpus(9, 200)
    rows = P.pack(docs(texts, sources=sources), length=256, quantum=16, shares={"hot": 3, "s1": 1}).collect()
    by_seq, _ = check(rows, texts, encoder, 256)
    first = [r.source for r in by_seq[0]]
    assert set(first) == {"hot", "s1"}
    assert abs(sum(r.length for r in by_seq[0] if r.source == "hot") - 192) <= 16


def test_empty_and_bad_length(spark, docs):
    assert P.pack(docs([])).count() == 0
    with pytest.raises(ValueError):
        P.pack(docs([]), length=100)


def test_words_are_numbered_by_their_bytes():
    rng = random.Random(10)
    words = ["a", "é", "abcdefgh", "abcdefghi", "abcdefghijklmnop", "abcdefghijklmnoq", "x" * 17, "x" * 18, "日本", "y" * 70]
    given = [rng.choice(words) for _ in range(500)]
    buffer = (" " + "  ".join(given) + " ").encode()
    inside = np.frombuffer(buffer, np.uint8) != 0x20
    turn = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    numbers, first = P.number_words(buffer, turn[::2], turn[1::2])
    assert len(numbers) == len(given) and len(first) == len(set(given))
    assert [given[first[k]] for k in numbers] == given


def test_long_texts_go_in_parts(encoder, monkeypatch):
    monkeypatch.setattr(P, "GROUP", 300)
    e = P.Encoder(None)
    texts = ["It's a long text, in parts; " * 200, "x" * 1000, "", "a\tb\nc d" * 100, "日本 " * 300, " " * 900]
    for t, got in zip(texts, e.encode(texts)):
        assert np.frombuffer(got, e.kind).tolist() == want_ids(encoder, t)
        assert not P.is_plain(t) or "".join(P.parts_of(t)) == t
