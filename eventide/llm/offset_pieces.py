"""SentencePiece encoding and decoding that keeps source offsets.

A text is normalised here, not in the library, so that every byte of the
normalised text knows the source byte its unit came from:

1. the model's compiled character map (a double-array trie over UTF-8 and its
   replacements) is matched at all positions at once, longest prefix first, and
   left to right the matches that do not overlap are applied; what no rule
   covers is kept character by character;
2. white space is handled as the model says (extra blanks, dummy prefix, the
   visible blank), and the alignment with it;
3. the library's model, with normalisation switched off, splits the result;
   the pieces' lengths run along the alignment and project every piece to the
   span of source bytes it stands for.

Ids equal the library's on the plain text, spans cover the source in order, and
byte pieces of one character share its span on their last byte, as the library
has it.  Decoding is the library's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import per_worker, ship_by_value, slices, table

ship_by_value()

MODEL = "piece_bpe_32k.model"
BLOCK = 1 << 17         # normalised bytes, or ids, the library gets at a time
BLANK = "▁".encode()

# Field numbers of the public model format.
_PIECE, _TRAINER, _NORMALISER, _DENORMALISER = 1, 2, 3, 5
_TEXT, _KIND = 1, 3
_SUFFIX = 24
_MAP, _DUMMY, _SQUEEZE, _ESCAPE = 2, 3, 4, 5
_UNKNOWN, _CONTROL, _USER, _BYTE = 2, 3, 4, 6


def _varint(buf: bytes, at: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        out |= (buf[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if buf[at - 1] < 128:
            return out, at


def _number(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def fields(buf: bytes) -> Iterator[tuple[int, int | bytes, bytes]]:
    """``(number, value, raw bytes)`` of a message's fields."""
    at = 0
    while at < len(buf):
        begin = at
        key, at = _varint(buf, at)
        if key & 7 == 0:
            value, at = _varint(buf, at)
        else:
            size, at = _varint(buf, at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = buf[at:at + size], at + size
        yield key >> 3, value, buf[begin:at]


class CharacterMap:
    """The compiled map: a trie over bytes, and the replacements at its leaves."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob, "<u4", size // 4, 4)
        self.texts = blob[4 + size:]

    @staticmethod
    def _base(units: np.ndarray) -> np.ndarray:
        return units >> np.uint32(10) << ((units & np.uint32(512)) >> np.uint32(6))

    def matches(self, text: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions out of ``where`` at which a rule applies, the length of the
        longest one, and where its replacement is."""
        best, value = np.zeros(len(where), np.int64), np.zeros(len(where), np.int64)
        live = np.arange(len(where))
        node = np.full(len(where), self._base(self.units[:1])[0], np.uint32)
        depth = 0
        while True:
            inside = where[live] + depth < len(text)
            live, node = live[inside], node[inside]
            if not len(live):
                break
            byte = text[where[live] + depth].astype(np.uint32)
            node = node ^ byte
            unit = self.units[np.minimum(node, len(self.units) - 1)]
            fits = (node < len(self.units)) & (unit & np.uint32(0x800000FF) == byte)
            live, node, unit = live[fits], node[fits], unit[fits]
            node = node ^ self._base(unit)
            depth += 1
            leaf = unit >> np.uint32(8) & np.uint32(1) == 1
            best[live[leaf]] = depth
            value[live[leaf]] = self.units[node[leaf]] & np.uint32(0x7FFFFFFF)
        hit = best > 0
        return where[hit], best[hit], value[hit]

    def replacement(self, at: int) -> bytes:
        return self.texts[at:self.texts.index(b"\0", at)]


class Normaliser:
    def __init__(self, charmap: bytes = b"", symbols: list[bytes] = [], dummy: bool = True, squeeze: bool = True,
                 escape: bool = True, suffix: bool = False):
        import re

        self.map = CharacterMap(charmap) if charmap else None
        self.symbols = re.compile(b"|".join(map(re.escape, sorted(symbols, key=len, reverse=True)))) if symbols else None
        self.dummy, self.squeeze, self.escape, self.suffix = dummy, squeeze, escape, suffix

    def _edits(self, text: bytes, raw: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
        """Replacements ``(from, to, bytes)`` in order, none overlapping."""
        found = [(m.start(), m.end(), m.group(), 0) for m in self.symbols.finditer(text)] if self.symbols else []
        if self.map:
            at, size, value = self.map.matches(raw, first)
            found += [(p, p + n, None, v) for p, n, v in zip(at.tolist(), size.tolist(), value.tolist())]
            found.sort(key=lambda x: (x[0], x[2] is None))     # a symbol goes before a rule
        done = 0
        for lo, hi, kept, v in found:
            if lo >= done:
                yield lo, hi, self.map.replacement(v) if kept is None else kept
                done = hi

    def apply(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the source
        byte at which the unit it came from starts."""
        raw = np.frombuffer(text, np.uint8)
        own = np.arange(len(raw), dtype=np.int32)
        starts = (raw & 0xC0) != 0x80
        source = np.maximum.accumulate(np.where(starts, own, np.int32(0))) if len(raw) else own
        out, loose = raw, None      # loose: a blank that may go as an extra one
        if self.map or self.symbols:
            parts, sources, ends, at = [], [], [], 0
            for lo, hi, new in self._edits(text, raw, np.flatnonzero(starts)):
                parts += [text[at:lo], new]
                sources += [source[at:lo], np.full(len(new), lo, np.int32)]
                ends += [np.ones(lo - at, bool), np.arange(len(new)) < len(new) - len(new.lstrip(b" "))]
                at = hi
            out = np.frombuffer(b"".join([*parts, text[at:]]), np.uint8)
            source = np.concatenate([*sources, source[at:]])
            loose = np.concatenate([*ends, np.ones(len(text) - at, bool)])
        blank, end, front = out == 0x20, len(text), 0
        if self.squeeze and len(out):
            keep = ~blank
            keep[1:] |= ~blank[:-1]
            if loose is not None:
                keep |= ~loose
            lead = len(blank) if blank.all() else int(np.argmin(blank))
            keep[:lead] = False if loose is None else ~loose[:lead]
            front = int(source[lead]) if lead < len(source) else end
            out, source, blank = out[keep], source[keep], blank[keep]
        if not len(out):
            return b"", np.zeros(1, np.int32)
        if self.dummy and not self.suffix:
            out, source, blank = np.insert(out, 0, 0x20), np.insert(source, 0, front), np.insert(blank, 0, True)
        norm, mark = out.tobytes(), BLANK if self.escape else b" "
        if self.escape:
            norm = norm.replace(b" ", BLANK)
            source = np.repeat(source, np.where(blank, len(BLANK), 1))
        if self.squeeze:
            size = len(norm)
            while norm.endswith(mark, 0, size):     # visible blanks of the source go here, too
                size -= len(mark)
            end = int(source[size]) if size < len(norm) else end
            norm, source = norm[:size], source[:size]
        if self.dummy and self.suffix:
            norm, source = norm + mark, np.append(source, np.full(len(mark), end, np.int32))
        return norm, np.append(source, np.int32(end))


class OffsetEncoder:
    """One model: its normaliser, its library form without normalisation (to
    encode) and as it is (to decode)."""

    def __init__(self, path: str | None = None, proto: bytes | None = None):
        import sentencepiece

        if proto is None:
            if path is None:
                import public_tokenizers

                path = public_tokenizers.path(MODEL)
            with open(path, "rb") as f:
                proto = f.read()
        spec: dict[int, int | bytes] = {}
        pieces, rest, suffix, plain = [], [], False, True
        for number, value, raw in fields(proto):
            if number == _NORMALISER:
                spec.update((k, v) for k, v, _ in fields(value))
                continue
            rest.append(raw)
            if number == _PIECE:
                own = {k: v for k, v, _ in fields(value)}
                pieces.append((own.get(_TEXT, b""), own.get(_KIND, 1)))
            elif number == _TRAINER:
                suffix = any(k == _SUFFIX and v for k, v, _ in fields(value))
            elif number == _DENORMALISER:
                plain = not any(k == _MAP and v for k, v, _ in fields(value))
        self.normaliser = Normaliser(spec.get(_MAP, b""), [t for t, k in pieces if k == _USER], bool(spec.get(_DUMMY, 1)),
                                     bool(spec.get(_SQUEEZE, 1)), bool(spec.get(_ESCAPE, 1)), suffix)
        off = b"".join(bytes([n << 3, 0]) for n in (_DUMMY, _SQUEEZE, _ESCAPE))
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.core = sentencepiece.SentencePieceProcessor(model_proto=b"".join(rest) + bytes([_NORMALISER << 3 | 2]) + _number(len(off)) + off)
        self.sizes = np.array([1 if k == _BYTE else 0 if k == _CONTROL else len(t) for t, k in pieces], np.int64)
        self.unknown = self.library.unk_id()
        # blocks may be cut before a blank that no piece has behind another character
        self.opens = np.array([t.startswith(BLANK) and k == 1 for t, k in pieces])
        self.separable = self.normaliser.escape and not any(BLANK in t.lstrip(BLANK) for t, k in pieces if k != _CONTROL)
        letters = [i for i, (t, k) in enumerate(pieces) if k == 1 and len(t) == 1 and t.isalpha()]
        self.anchor = letters[0] if letters and plain else None

    def _blocks(self, norm: bytes) -> Iterator[bytes]:
        at = 0
        while self.separable and len(norm) - at > BLOCK:
            cut = norm.find(BLANK, at + BLOCK)
            while cut > 0 and norm[cut - len(BLANK):cut] == BLANK:
                cut = norm.find(BLANK, cut + len(BLANK))
            if cut < 0:
                break
            yield norm[at:cut]
            at = cut
        yield norm[at:]

    def encode(self, text: str | bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids with begin and end id, and the source bytes ``[begin, end)`` of each."""
        text = text.encode() if isinstance(text, str) else text
        norm, source = self.normaliser.apply(text)
        ids, sizes = [], []
        for block in self._blocks(norm):
            own = np.asarray(self.core.encode(block.decode(), add_bos=False, add_eos=False), np.int32)
            size = self.sizes[own]
            if (own == self.unknown).any():     # a run of unknown characters is one id
                size = np.array([len(p.encode()) if i == self.unknown else n for p, i, n in
                                 zip(self.core.encode(block.decode(), out_type=str), own.tolist(), size.tolist())], np.int64)
            ids.append(own)
            sizes.append(size)
        at = np.cumsum(np.concatenate([np.zeros(1, np.int64), *sizes]))
        if at[-1] != len(norm):
            raise ValueError(f"pieces of {at[-1]} bytes for a normalised text of {len(norm)}")
        where = source[at]
        return (np.concatenate([[self.library.bos_id()], *ids, [self.library.eos_id()]]).astype(np.int32),
                np.concatenate([[0], where[:-1], [len(text)]]).astype(np.int32), np.concatenate([[0], where[1:], [len(text)]]).astype(np.int32))

    def decode(self, ids: np.ndarray) -> str:
        out, at = [], 0
        while self.anchor is not None and len(ids) - at > BLOCK:
            opens = np.flatnonzero(self.opens[ids[at + BLOCK:]])
            if not len(opens):
                break
            out.append(self._decode(ids[at:at + BLOCK + opens[0]], at))
            at += BLOCK + int(opens[0])
        return "".join([*out, self._decode(ids[at:], at)])

    def _decode(self, ids: np.ndarray, at: int) -> str:
        # behind the start a blank counts: a letter before it keeps the library from taking it off
        return self.library.decode([self.anchor, *ids.tolist()])[1:] if at else self.library.decode(ids.tolist())


def _lists(parts: list[np.ndarray], packed: bool) -> pa.Array:
    if packed:
        return pa.array([p.astype("<u4").tobytes() for p in parts], pa.binary())
    ends = np.cumsum([0] + [len(p) for p in parts]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *parts]), pa.int32()))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, packed: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, ids, begins, ends, decoded)`` per row:
    the ids with begin and end id, the bytes of the source (UTF-8) each stands
    for, and the text the library decodes them to.  The three lists are arrays
    of int, or, ``packed``, binary with four little-endian bytes a number.

    Null and empty texts have the begin and the end id alone; null and repeated
    ids and repeated rows are encoded like any other (there are no ties: every
    row stands alone); other columns, whatever their names, are ignored; an
    empty table gives no rows.  Very long texts are cut into blocks of some
    ``BLOCK`` bytes before blanks that no piece spans, which changes no id; a
    word beyond that size goes to the library whole.
    """
    kind = "binary" if packed else "array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(f"offsets {model}", lambda: OffsetEncoder(model))
        for b in slices(batches, 64):
            texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
            rows = [encoder.encode(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(map(len, texts), pa.int64()), pa.array([len(r[0]) for r in rows], pa.int64()),
                 *(_lists([r[k] for r in rows], packed) for k in range(3)),
                 pa.array([encoder.decode(r[0]) for r in rows], pa.string())],
                ["doc_id", "n_bytes", "n_tokens", "ids", "begins", "ends", "decoded"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"doc_id long, n_bytes long, n_tokens long, ids {kind}, begins {kind}, ends {kind}, decoded string"))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, projected to its bytes and decoded; digests of the three."""
    rows = encode(table(spark, sf_dir, "documents", "doc_id", "text"), packed=True)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
                       F.sha2(F.concat("begins", "ends"), 256).alias("spans_sha256"))
