"""Concatenate-and-cut packing: prefix sums over partition totals give global token offsets."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, small_batches

#: Stems and marks whose ids a Python worker remembers, and the bytes of their names; the store is emptied when either is full.
REMEMBERED, REMEMBERED_BYTES = 1_000_000, 64_000_000
#: Bytes of text that are encoded together.
TOGETHER = 4_000_000

#: Marks at the end of a piece, and the letters among which nothing composes or changes with its neighbours.
_MARKS, _LETTERS = ".,;:!?%&#*$", "a-zß-öø-ÿ"
_PLAIN = r"^[\x00-\x7FÀ-ÖØ-öø-ÿ]*$"
_stores: dict[str, _Store] = {}


class _Store:
    """Token ids of the stems and marks that a worker has met, kept as stretches of one array.

    The vocabulary's pre-tokenizer drops white space and parts letters from marks, and no token spans either, so ids of
    a text are those of its white-space pieces in turn, and those of a piece the ids of its stem and of the marks at its
    end. Pieces of a stretch of text are told apart by Arrow's dictionaries; each new stem goes to the tokenizer once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError(f"{path}: ids are kept in 16 bits, the vocabulary has {self.tokenizer.get_vocab_size()}")
        # How the tokenizer spells each Latin letter for its model; a word of such letters needs no more than that.
        normal, part = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        letters = [chr(c) for c in range(256) if re.fullmatch(f"[{_LETTERS}]", chr(c))]
        self.spelt = {ord(c): "".join(x for x, _ in part.pre_tokenize_str(normal.normalize_str(c))) for c in letters}
        self.word = re.compile(f"[{_LETTERS}]+")
        self.clear()

    def clear(self) -> None:
        self.known, self.bytes = {b"": 0}, 0
        self.flat, self.start, self.size = array("H"), array("q", [0]), array("q", [0])

    def learn(self, fresh: list[bytes]) -> None:
        model, others = self.tokenizer.model, []
        for name in fresh:
            if self.word.fullmatch(word := name.decode()):
                self.add(name, [t.id for t in model.tokenize(word.translate(self.spelt))])
            else:
                others.append((name, word))
        for i in range(0, len(others), 1024):
            some = others[i : i + 1024]
            for (name, _), e in zip(some, self.tokenizer.encode_batch_fast([w for _, w in some], add_special_tokens=False)):
                self.add(name, e.ids)

    def add(self, name: bytes, ids: list[int]) -> None:
        self.known[name] = len(self.start)
        self.start.append(len(self.flat))
        self.size.append(len(ids))
        self.flat.extend(ids)
        self.bytes += len(name)

    def numbers(self, distinct: pa.Array) -> np.ndarray:
        """Places of the given names in the store; what it has not met is learned."""
        names = distinct.cast(pa.binary()).to_pylist()
        self.learn([x for x in names if x not in self.known])
        return np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))

    def encode(self, texts: pa.Array, end_id: int) -> pa.BinaryArray:
        """The ids of each text and end_id after them, as little-endian uint16."""
        if len(self.known) > REMEMBERED or self.bytes > REMEMBERED_BYTES:
            self.clear()
        split = pc.ascii_split_whitespace(texts)
        pieces = split.flatten().dictionary_encode()
        names = pieces.dictionary
        plain = pc.and_(pc.match_substring_regex(names, _PLAIN), pc.invert(pc.match_substring(names, "<|")))
        lowered = pc.if_else(plain, pc.utf8_lower(names), names)
        stems = pc.ascii_rtrim(lowered, characters=_MARKS)
        parted = pc.and_(plain, pc.match_substring_regex(stems, f"[0-9{_LETTERS}]$"))
        stems = pc.if_else(parted, stems, lowered).dictionary_encode()
        stem_of = stems.indices.to_numpy()
        tails = (pc.binary_length(lowered).to_numpy() - pc.binary_length(stems.dictionary).to_numpy()[stem_of]).tolist()
        marks = pa.array([x[len(x) - n :] if n else b"" for x, n in zip(lowered.cast(pa.binary()).to_pylist(), tails)], pa.binary()).dictionary_encode()
        both = np.stack((self.numbers(stems.dictionary)[stem_of], self.numbers(marks.dictionary)[marks.indices.to_numpy()]), 1).ravel()

        # The ids of each distinct piece, and end_id behind them as one more, are then taken for every piece in turn.
        size = np.frombuffer(self.size, np.int64)[both]
        before = np.concatenate(([0], np.cumsum(size)))
        own = np.frombuffer(self.flat, np.uint16)[np.repeat(np.frombuffer(self.start, np.int64)[both] - before[:-1], size) + np.arange(before[-1])]
        offsets = np.append(before[::2], before[-1] + 1).astype(np.int32) * 2
        distinct = pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.append(own, np.uint16(end_id)).astype("<u2"))])
        ends = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
        every = distinct.take(pa.array(np.insert(pieces.indices.to_numpy(), ends, len(offsets) - 2)))
        at = np.frombuffer(every.buffers()[1], np.int32)[np.append(0, ends + np.arange(1, len(ends) + 1))]
        return pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(at), every.buffers()[2]])


def _stretches(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows with about TOGETHER bytes, one row at least."""
    upto, at = np.cumsum(sizes), 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(upto, upto[at] - sizes[at] + TOGETHER, side="right")))
        yield at, end
        at = end


def tokenise(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2) -> DataFrame:
    """First pass: (doc_id, part, local_start, n, ids): token ids with end_id appended, and the running token total inside the task.

    Written to the scratch folder, so that `part` and `local_start` are fixed data whatever is lost later.
    A null text is an empty one and holds end_id alone; an empty table gives no rows; texts of any length are encoded whole,
    TOGETHER bytes or one text at a time. ids are little-endian uint16; a vocabulary that is larger is refused.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, part, at = _stores.get(tokenizer_path) or _stores.setdefault(tokenizer_path, _Store(tokenizer_path)), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for a, b in _stretches(pc.binary_length(texts).to_numpy()):
                ids = store.encode(texts.slice(a, b - a), end_id)
                n = pc.binary_length(ids).to_numpy().astype(np.int64) // 2
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.full(len(n), part, np.int32)), pa.array(at + np.cumsum(n) - n), pa.array(n), ids], names=["doc_id", "part", "local_start", "n", "ids"])
                at += int(n.sum())

    small_batches(docs.sparkSession)
    return materialise(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {id_type}, part int, local_start long, n long, ids binary"), "tokens")


def concatenate_and_cut(tokens: DataFrame, length: int = 4096) -> DataFrame:
    """Second pass over tokenise()'s table: one row per piece.

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_to, boundary (the document
    continues in another window) and ids (little-endian uint16). Windows are full but for the last one, which is
    padded to `length` unless its tokens are a power of two. An empty table gives no rows; repeated rows are
    packed as often as they occur.
    """
    totals = tokens.groupBy("part").agg(F.sum("n").alias("tokens"))
    by_part = Window.orderBy("part")  # one row per task of the first pass
    base = totals.select("part", (F.sum("tokens").over(by_part) - F.col("tokens")).alias("base"), F.sum("tokens").over(Window.partitionBy()).alias("all_tokens"))
    placed = tokens.join(F.broadcast(base), "part").select("doc_id", "n", "ids", (F.col("base") + F.col("local_start")).alias("at"), "all_tokens")
    id_type = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, at, whole = (np.asarray(batch.column(i)) for i in (1, 3, 4))
            row, start, size, crc, seq, off, pad, cut, out = [], [], [], [], [], [], [], [], []
            for i, raw in enumerate(batch.column(2).to_pylist()):
                first, last, ids = int(at[i]) // length, int(at[i] + n[i] - 1) // length, np.frombuffer(raw, "<u2")
                for s in range(first, last + 1):
                    lo, hi = max(s * length, int(at[i])), min((s + 1) * length, int(at[i] + n[i]))
                    piece = ids[lo - int(at[i]) : hi - int(at[i])]
                    fill = min(length, int(whole[i]) - s * length)
                    row.append(i)
                    start.append(lo - int(at[i]))
                    size.append(hi - lo)
                    crc.append(zlib.crc32(piece.astype("<u4").tobytes()))
                    seq.append(s)
                    off.append(lo - s * length)
                    pad.append(fill if fill & (fill - 1) == 0 else length)
                    cut.append(last > first)
                    out.append(piece.tobytes())
            take = pa.array(row, pa.int64())
            longs = [pa.array(x, pa.int64()) for x in (start, size, crc)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), *longs, batch.column(1).take(take), pa.array(seq, pa.int64()), pa.array(off, pa.int64()), pa.array(pad, pa.int64()), pa.array(cut, pa.bool_()), pa.array(out, pa.binary())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_to", "boundary", "ids"],
            )

    return placed.mapInArrow(run, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_to long, boundary boolean, ids binary")


def pack(docs: DataFrame, tokenizer_path: str, length: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents; see concatenate_and_cut()."""
    return concatenate_and_cut(tokenise(docs, tokenizer_path, id_col, text_col), length)
