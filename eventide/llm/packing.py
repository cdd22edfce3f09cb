"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of its documents' tokens, served in quanta of
``QUANTUM`` tokens.  Quantum ``j`` of a source with share ``p`` of the mixture
falls due at ``(j + 1/2) * QUANTUM / p`` served tokens: the order of all due
times is the round-robin schedule with the deficits carried exactly, whatever
window or partition a quantum ends up in, so every window of the sequence
length holds each source's share to within a quantum.  (By default the shares
are the sources' own token counts, and all queues run dry together; with other
shares the queues left over share the windows that remain.)  Windows are
consecutive runs of the schedule.  They are full, but for the tail, which is
cut into sequences whose lengths are powers of two and so need no padding.

The schedule is a sort, not a loop: positions come from range partitions and
the running totals of the partitions.  Texts are tokenised once, and the ids
written to the shared folder as two bytes a token.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, offsets_by_order, per_worker, ship_by_value, slices, table

ship_by_value()

LENGTH = 2048
QUANTUM = 256
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
CACHE_BYTES = 96 << 20  # of words and pieces a worker remembers
LONG = 64               # characters; longer ones are not remembered
_ENTRY = 180            # bytes of a remembered word beside its own
GROUP = 4 << 20         # characters of plain text encoded at a time


# Texts of these characters are not changed by the tokenizer's normalisation
# but for case, which is theirs one by one; then its own split can be taken here.
_PLAIN = re.compile("[\\n\\t\\r -~À-ÖØ-öø-įı-ſ]*")
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-įı-ſ]+|[0-9]|[^\\n\\t\\r a-zß-öø-įı-ſ0-9]+")


_BLANK = re.compile("[ \n\t\r]")
_BLANKS = bytes.maketrans(b"\n\t\r", b"   ")


def is_plain(text: str) -> bool:
    return _PLAIN.fullmatch(text) is not None and "<|" not in text


def pieces_of(text: str) -> list[str] | None:
    """A text as the tokenizer splits it before merging, where that is
    certain; None elsewhere (also where a special token may be spelt)."""
    return _PIECE.findall(text.lower()) if is_plain(text) else None


class Memory(dict):
    """Ids by word, up to ``CACHE_BYTES`` in a worker for all of them together."""

    held = 0

    def learn(self, words: list[str], ids: list[bytes]) -> list[str]:
        """Remember; returns the words too long to be kept beyond this slice."""
        self.update(zip(words, ids))
        long = [w for w in words if len(w) > LONG]
        self.held += sum(map(len, words)) + sum(map(len, ids)) + _ENTRY * len(words)
        return long

    def forget(self, words: list[str]) -> None:
        for w in words:
            self.held -= len(w) + len(self.pop(w)) + _ENTRY


class Encoder:
    """Ids of whole texts as little-endian bytes.  Texts are cut at blanks and
    line ends, which the tokenizer's pieces never span.  The words of a group of
    texts are numbered as arrays, each distinct one is looked up once, and its
    ids are laid out by offsets.  New words of plain texts are split further,
    and only new pieces reach the tokenizer.  What is remembered is bounded by
    bytes."""

    def __init__(self, path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        self.plain, self.words = Memory(), Memory()     # words and pieces of plain texts, words of others
        self.end = np.array([END_ID], self.kind).tobytes()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if suffix:
            self.closes[[i for t, i in vocab.items() if t.endswith(suffix)]] = True

    def _each(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that are not split further: as one text, cut where a
        token closes a piece."""
        if not pieces or not self.closes.any():
            return self._each(pieces)
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0].ids, self.kind)
        ends = (np.flatnonzero(self.closes[ids]) + 1) * ids.itemsize
        if len(ends) != len(pieces) or ends[-1] != ids.nbytes:
            return self._each(pieces)
        buf, ends = ids.tobytes(), ends.tolist()
        return [buf[i:j] for i, j in zip([0, *ends], ends)]

    def _plain(self, words: list[str]) -> list[str]:
        """Learn lower-case words of plain texts by their pieces."""
        split = {w: _PIECE.findall(w) for w in words if not w.isalpha()}     # letters alone are a piece
        new = list({w for w in words if w not in split}.union(p for own in split.values() for p in own if p not in self.plain))
        long = self.plain.learn(new, self._pieces(new))
        rest = [w for w in split if w not in self.plain]
        return long + self.plain.learn(rest, [b"".join(map(self.plain.__getitem__, split[w])) for w in rest])

    def _others(self, words: list[str]) -> list[str]:
        return self.words.learn(words, self._each(words) if words else [])

    def _known(self, memory: Memory, learn, words: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids of distinct words, and those to be forgotten again."""
        if self.plain.held + self.words.held > CACHE_BYTES:
            for m in (self.plain, self.words):
                m.clear()
                m.held = 0
        long = learn([w for w in words if w not in memory])
        return list(map(memory.__getitem__, words)), long

    def _group(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of plain texts."""
        own = [t.lower().encode().translate(_BLANKS) for t in texts]
        at = np.cumsum([1] + [len(t) + 1 for t in own])
        buffer = b" " + b" ".join(own) + b" "
        inside = np.frombuffer(buffer, np.uint8) != 0x20
        turn = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = turn[::2], turn[1::2]
        numbers, first = number_words(buffer, starts, ends)
        words = [buffer[i:j].decode() for i, j in zip(starts[first].tolist(), ends[first].tolist())]
        ids, long = self._known(self.plain, self._plain, words)
        self.plain.forget(long)
        flat, sizes = np.frombuffer(b"".join(ids), self.kind), np.array([len(x) for x in ids], np.int64) // int(self.kind[-1])
        size = sizes[numbers]
        end = np.cumsum(size)
        where = np.repeat((np.cumsum(sizes) - sizes)[numbers] - (end - size), size) + np.arange(int(end[-1]) if len(end) else 0)
        out = flat[where]
        cut = np.concatenate([[0], end])[np.searchsorted(starts, at)]
        return [out[i:j] for i, j in zip(cut[:-1].tolist(), cut[1:].tolist())]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[list[bytes]] = [[] for _ in texts]
        group, owner, size = [], [], 0

        def flush() -> None:
            for k, ids in zip(owner, self._group(group)):
                out[k].append(ids.tobytes())
            group.clear()
            owner.clear()

        for k, t in enumerate(texts):
            if is_plain(t):
                for part in parts_of(t):
                    group.append(part)
                    owner.append(k)
                    size += len(part)
                    if size > GROUP:
                        flush()
                        size = 0
            else:
                words = re.split("[ \n\t\r]+", t)
                distinct = list(set(words))
                ids, long = self._known(self.words, self._others, distinct)
                found = dict(zip(distinct, ids))
                self.words.forget(long)
                out[k] += map(found.__getitem__, words)
        flush()
        return [b"".join(x) + self.end for x in out]


def parts_of(text: str) -> Iterator[str]:
    """A plain text in parts of about ``GROUP`` characters, cut at blanks."""
    at = 0
    while len(text) - at > GROUP:
        cut = _BLANK.search(text, at + GROUP)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def number_words(buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for every word of ``buffer``, equal for equal words, and the
    first word of each number.  Words of up to 16 bytes are told apart by their
    bytes as two integers, longer ones by a dictionary."""
    numbers, size = np.zeros(len(starts), np.int64), ends - starts
    first, many = [], 0
    raw = np.ndarray((len(buffer) + 8,), "<u8", buffer + b"\0" * 16, strides=(1,))
    mask = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    for lo, hi in ((1, 8), (9, 16)):
        own = np.flatnonzero((size >= lo) & (size <= hi))
        if not len(own):
            continue
        keys = raw[starts[own]] & mask[np.minimum(size[own], 8)]
        if hi > 8:
            rest = raw[starts[own] + 8] & mask[size[own] - 8]
            order = np.lexsort((rest, keys))
            new = np.ones(len(own), bool)
            new[1:] = (keys[order][1:] != keys[order][:-1]) | (rest[order][1:] != rest[order][:-1])
        else:
            order = np.argsort(keys, kind="stable")
            new = np.ones(len(own), bool)
            new[1:] = keys[order][1:] != keys[order][:-1]
        numbers[own[order]] = many + np.cumsum(new) - 1
        first.append(own[order][new])
        many += int(new.sum())
    seen: dict[bytes, int] = {}
    for k in np.flatnonzero(size > 16).tolist():
        word = buffer[starts[k]:ends[k]]
        if word not in seen:
            seen[word] = many + len(seen)
            first.append(np.array([k]))
        numbers[k] = seen[word]
    return numbers, np.concatenate([np.zeros(0, np.int64), *first]).astype(np.int64)


def tokenise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str | None = "source",
             tokenizer: str | None = None) -> DataFrame:
    """``(uid, doc_id, source, n, width, ids)``, written once; ``uid`` names the row."""
    source = F.col(source_col).cast("string") if source_col else F.lit(None).cast("string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(f"encoder {tokenizer}", lambda: Encoder(tokenizer))
        width = int(encoder.kind[-1])
        for b in slices(batches, 2048):
            ids = encoder.encode([t or "" for t in b.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(x) // width for x in ids], pa.int64()),
                 pa.array([width] * len(ids), pa.int32()), pa.array(ids, pa.binary())],
                ["doc_id", "source", "n", "width", "ids"])

    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), source.alias("source"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, source string, n long, width int, ids binary"))
    return materialize(rows.select(F.monotonically_increasing_id().alias("uid"), "*"), "tokens")


def tail_cuts(total: int, length: int) -> list[int]:
    """Ends of the sequences of the tail: descending powers of two."""
    at, rest, out = total - total % length, total % length, []
    while rest:
        at += 1 << (rest.bit_length() - 1)
        rest -= 1 << (rest.bit_length() - 1)
        out.append(at)
    return out


def schedule(lens: DataFrame, length: int = LENGTH, quantum: int = QUANTUM, shares: dict[str, float] | None = None) -> DataFrame:
    """Pieces ``(uid, start, len, sequence_id, offset)`` of rows ``(uid, source, n)``, n > 0."""
    spark = lens.sparkSession
    before = Window.orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    queues = lens.groupBy("source").agg(F.sum("n").alias("_tokens"))        # a row per source
    if shares is None:
        queues = queues.withColumn("_share", F.col("_tokens").cast("double"))
    else:
        given = spark.createDataFrame([(k, float(v)) for k, v in shares.items()], "_name string, _share double")
        queues = queues.join(given, F.col("source").eqNullSafe(F.col("_name")), "left").drop("_name").fillna(0.0, ["_share"])
    queues = materialize(queues.withColumn("_from", F.coalesce(F.sum("_tokens").over(before), F.lit(0)).cast("long")), "queues")
    total, weight = queues.agg(F.sum("_tokens"), F.sum("_share")).first()
    total = int(total or 0)
    # the position in the queue, then one row per quantum a document has tokens in
    at = offsets_by_order(lens, [F.col("source"), F.col("uid")], "n", "_pos")
    own = (at.join(queues.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
           .withColumn("_at", F.col("_pos") - F.col("_from")))
    # a queue without a share falls due after all others
    due = F.when(F.col("_share") > 0, (F.col("_j") + 0.5) * (quantum * float(weight or 1)) / F.col("_share")).otherwise(F.lit(float("inf")))
    pieces = (own.withColumn("_j", F.explode(F.expr(f"sequence(_at div {quantum}, (_at + n - 1) div {quantum})")))
              .withColumn("_lo", F.greatest(F.col("_at"), F.col("_j") * quantum))
              .withColumn("len", F.least(F.col("_at") + F.col("n"), (F.col("_j") + 1) * quantum) - F.col("_lo"))
              .select("uid", (F.col("_lo") - F.col("_at")).alias("start"), "len", due.alias("_due"), "source", "_lo"))
    placed = offsets_by_order(pieces, [F.col("_due"), F.col("source"), F.col("_lo")], "len", "_pos")
    cuts = tail_cuts(total, length)
    full = total // length
    inside = F.expr(f"""array_sort(concat(array(_pos), filter(sequence((_pos div {length} + 1) * {length},
        (_pos div {length} + 1) * {length} + (len div {length}) * {length}, {length}), x -> x < _pos + len),
        filter(cast(array({', '.join(map(str, cuts))}) as array<bigint>), x -> x > _pos and x < _pos + len)))""")
    cut = placed.withColumn("_cuts", inside).select("*", F.posexplode("_cuts").alias("_k", "_a"))
    end = F.coalesce(F.try_element_at("_cuts", F.col("_k") + 2), F.col("_pos") + F.col("len"))
    ends = F.lit(cuts).cast("array<bigint>")
    passed = F.size(F.filter(ends, lambda x: x <= F.col("_a")))
    tail_start = F.when(passed > 0, F.try_element_at(ends, passed)).otherwise(F.lit(full * length))
    in_tail = F.col("_a") >= full * length
    return cut.select("uid", (F.col("start") + F.col("_a") - F.col("_pos")).alias("start"), (end - F.col("_a")).alias("len"),
                      F.when(in_tail, (F.lit(full) + passed).cast("long")).otherwise(F.expr(f"_a div {length}")).alias("sequence_id"),
                      F.when(in_tail, F.col("_a") - tail_start).otherwise(F.col("_a") % length).alias("offset"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str | None = "source",
         length: int = LENGTH, quantum: int = QUANTUM, shares: dict[str, float] | None = None,
         tokenizer: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, source``.

    Null texts are empty (a document of the end id alone); null and repeated
    ids, null sources (a queue of their own) and repeated rows are packed like
    any other; other columns are ignored; an empty table gives no rows.
    """
    if length & (length - 1) or length < 1:
        raise ValueError("the sequence length must be a power of two")
    tokens = tokenise(docs, id_col, text_col, source_col, tokenizer)
    pieces = (schedule(tokens.select("uid", "source", "n"), length, quantum, shares)
              .groupBy("uid").agg(F.collect_list(F.struct("start", "len", "sequence_id", "offset")).alias("pieces")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"]
        for b in slices(batches):
            out = []
            for doc, source, n, width, ids, own in zip(*(c.to_pylist() for c in b.columns)):
                whole = ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                own = sorted((p["start"], p["len"], p["sequence_id"], p["offset"]) for p in own)
                merged = [list(own[0])]
                for start, size, seq, at in own[1:]:
                    last = merged[-1]
                    if last[2] == seq and last[3] + last[1] == at and last[0] + last[1] == start:
                        last[1] += size
                    else:
                        merged.append([start, size, seq, at])
                out += [(doc, start, size, zlib.crc32(whole[4 * start:4 * (start + size)]), n, seq, at, source)
                        for start, size, seq, at in merged]
            cols = list(zip(*out)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == 7 else pa.int64()) for k, c in enumerate(cols)], names)

    return (tokens.join(pieces, "uid").select("doc_id", "source", "n", "width", "ids", "pieces")
            .mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens, sources mixed."""
    return pack(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
