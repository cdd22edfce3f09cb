import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from eventide.llm import offset_pieces as O

ODD = ["", " ", "   ", "a", " a", "a ", "  a  b   c  ", "▁", "▁▁a", "a▁b", "日本語。テスト 한국어!", "ＫＡＤＯＫＡＷＡ   ABC ﷺ  ", "é́ à ḿ ﬁ ½ ㍿", "​ zero‍width",
       "\x00\x01 a\tb\r\nc ", "😀 👩‍👩‍👧 \U0001f1e9\U0001f1ea", "<s> </s> <unk> <0x0A>", "x" * 3000, "´´ ´ a", " 　 　a  ", "á́ ̀", "ᄀ각ᆨ"]


@pytest.fixture(scope="module")
def encoder():
    return O.OffsetEncoder()


def normaliser_of(rule, **flags):
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule, **flags)
    spec = {}
    for number, value, _ in O.fields(lib.serialized_model_proto()):
        if number == 3:
            spec = {k: v for k, v, _ in O.fields(value)}
    return lib, spec


def texts(seed, n):
    rng = random.Random(seed)
    own = "aeoAB  \t\né́̈̂ﬁ½Å日ー한글ＡＢ㍿　 ´¨😀‍."
    return ["".join(rng.choice(own) for _ in range(rng.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize("rule", ["identity", "nmt_nfkc", "nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("dummy", [True, False])
@pytest.mark.parametrize("squeeze", [True, False])
def test_normalisation_and_alignment_are_the_librarys(rule, dummy, squeeze):
    lib, spec = normaliser_of(rule, add_dummy_prefix=dummy, escape_whitespaces=True, remove_extra_whitespaces=squeeze)
    own = O.Normaliser(spec.get(2, b""), [], dummy, squeeze, True)
    for t in ODD + texts(1, 300):
        want, where = lib.normalize(t, with_offsets=True)
        norm, source = own.apply(t.encode())
        assert norm.decode() == want, repr(t)
        # the library counts in characters, the operator in bytes
        chars = np.cumsum([0] + [len(c.encode()) for c in t])
        starts = [i for i, b in enumerate(norm) if b & 0xC0 != 0x80] + [len(norm)]
        assert [int(source[i]) for i in starts] == [int(chars[w]) for w in where], repr(t)


def check(encoder, t):
    ids, begins, ends = encoder.encode(t)
    want = encoder.library.encode(t, add_bos=True, add_eos=True)
    assert ids.tolist() == want, repr(t[:80])
    raw = t.encode()
    assert (begins <= ends).all() and begins[0] == ends[0] == 0 and begins[-1] == ends[-1] == len(raw)
    assert (begins[2:-1] == ends[1:-2]).all()
    chars = np.cumsum([0] + [len(c.encode()) for c in t])
    proto = encoder.library.encode_as_offset_mapping(t)
    assert proto["ids"] == ids[1:-1].tolist()
    got = [(int(np.searchsorted(chars, a)), int(np.searchsorted(chars, b))) for a, b in zip(begins[1:-1], ends[1:-1])]
    assert got == [tuple(x) for x in proto["offsets"]], repr(t[:80])
    assert encoder.decode(ids) == encoder.library.decode(want)


def test_ids_and_spans_are_the_librarys(encoder):
    for t in ODD + texts(2, 200):
        check(encoder, t)


def test_a_model_with_a_character_map():
    """The public model with its normalisation replaced by compiled rules."""
    import public_tokenizers

    with open(public_tokenizers.path(O.MODEL), "rb") as f:
        proto = f.read()
    lib = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = next(raw for number, _, raw in O.fields(lib.serialized_model_proto()) if number == 3)
    e = O.OffsetEncoder(proto=b"".join(raw for number, _, raw in O.fields(proto) if number != 3) + spec)
    for t in ODD + texts(3, 200):
        check(e, t)


def test_long_texts_in_blocks(encoder, monkeypatch):
    rng = random.Random(4)
    long = [" ".join(rng.choice(["alpha", "béta", "日本", "", "x" * 9, "\n", "😀"]) for _ in range(3000)), "y" * 20_000, "  " * 5000 + "z"]
    for block in (64, 1000, 1 << 17):
        monkeypatch.setattr(O, "BLOCK", block)
        for t in long:
            check(encoder, t)


def test_rows(spark, docs, encoder):
    given = [(1, "Hello  wörld"), (2, None), (3, ""), (None, "null id"), (1, "same id"), (1, "same id"), (7, "日本 " * 30_000)]
    rows = O.encode(docs(given)).collect()
    assert len(rows) == len(given)
    got = sorted((repr(r.doc_id), r.n_tokens, tuple(r.ids), tuple(r.begins), tuple(r.ends), r.decoded) for r in rows)
    want = []
    for i, t in given:
        ids, a, b = encoder.encode(t or "")
        assert ids.tolist() == encoder.library.encode(t or "", add_bos=True, add_eos=True)
        want.append((repr(i), len(ids), tuple(ids.tolist()), tuple(a.tolist()), tuple(b.tolist()), encoder.library.decode(ids.tolist())))
    assert got == sorted(want)
    assert O.encode(docs([])).count() == 0
    packed = {r.doc_id: r.ids for r in O.encode(docs(given[:1]), packed=True).collect()}
    assert packed == {1: np.array(encoder.library.encode(given[0][1], add_bos=True, add_eos=True), "<u4").tobytes()}


def test_query(spark, encoder):
    sf = "/root/testdata/sf0.001"
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = encoder.library.encode(r.text or "", add_bos=True, add_eos=True)
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256(encoder.library.decode(ids).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in O.op13_pieces(spark, sf).collect()}
    assert got == want
