"""Best-fit packing of token pieces into sequences of bounded length."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extended, pieces

#: Unicode white space, as the tokenizer's pattern has it.
_SPACE = "".join(map(re.escape, map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))))
_LETTERS = "A-Za-z" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ((0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F)))
#: Pieces that the tokenizer never merges across: letters with the one space before them, up to white space or an
#: ASCII character that is none; another run without white space; or a run of white space.
_CHUNK = re.compile(f" ?[{_LETTERS}]++(?=[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]|$)| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: Chunks in either half of a worker's cache.
_CACHE_MOST = 250_000
#: Letters below this are letters to any version of Unicode.
_KNOWN = "\u0250"
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_SHIFTED = {b: chr(0x100 + i) for i, b in enumerate(sorted({*range(0x100)} - _PRINTED))}
#: Characters as the byte-level model spells them: a character a byte, those that can't be printed from U+0100 on.
_SPELLED = {c: chr(c).encode().decode("latin-1").translate(_SHIFTED) for c in range(ord(_KNOWN))}
_SPACED = _SPELLED[0x20]
_tokenizers: dict[str, ChunkIds] = {}


class ChunkIds(dict):
    """Ids of chunks, as little-endian unsigned 32-bit integers: what is asked for and not known is encoded.

    A run of letters is one word to the model's merges, so it goes to the model alone; all else takes the tokenizer's
    whole way. When `most` chunks are held, they become the older half, and what is not asked for again is forgotten.
    """

    def __init__(self, tokenizer, most: int | None = None):
        super().__init__()
        self.encode, self.model, self.most, self.older = tokenizer.encode, tokenizer.model, most or _CACHE_MOST, {}

    def __missing__(self, chunk: str) -> bytes:
        raw = self.older.get(chunk)
        if raw is None:
            word = chunk.removeprefix(" ")
            if word.isalpha() and (word.isascii() or max(word) < _KNOWN):
                spelled = chunk.translate(_SPELLED) if not word.isascii() else word if len(word) == len(chunk) else _SPACED + word
                ids = [t.id for t in self.model.tokenize(spelled)]
            else:
                ids = self.encode(chunk, add_special_tokens=False).ids
            raw = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) >= self.most:
            self.older = self.copy()
            self.clear()
        self[chunk] = raw
        return raw


def _chunk_ids(path: str) -> ChunkIds:
    """The tokenizer's chunks and ids, kept by this worker between tasks."""
    if path not in _tokenizers:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        _tokenizers[path] = ChunkIds(tok)
    return _tokenizers[path]


def token_bytes(texts: list[str], path: str) -> Iterator[bytes]:
    """Each text's ids as little-endian unsigned 32-bit integers.

    White space, and the end of a run of letters, bound the tokenizer's merges; so ids of equal chunks are looked
    up, only chunks not seen before are encoded, and the ids equal those of encoding the whole text.
    """
    ids_of = _chunk_ids(path).__getitem__
    for t in texts:
        yield b"".join(map(ids_of, _CHUNK.findall(t)))


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenize and cut: (doc_id, piece, start, length, ids_crc32).

    A document's ids are its text's and then end_id. Documents of more than capacity ids are cut into full
    pieces, only the first of which may be shorter. A null or empty text gives the end id alone; a null doc_id
    is carried through.
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        for batch in pieces(batches):
            ids, out = batch.column(0).to_pylist(), ([], [], [], [], [])
            texts = batch.column(1).to_pylist()
            for i, raw in zip(ids, token_bytes(texts, tokenizer_path), strict=True):
                raw += end
                n, start, piece = len(raw) // 4, 0, 0
                while start < n:
                    length = (n - start) % capacity or capacity
                    row = (i, piece, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)]))
                    for col, x in zip(out, row, strict=True):
                        col.append(x)
                    start, piece = start + length, piece + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


class BestFit:
    """Online best fit with a fixed number of open bins.

    Bit f of one integer is set while some open bin has f units free; shifting it finds the least free space that
    fits. When a new bin is needed and none may be added, the fullest open bin closes.
    """

    def __init__(self, capacity: int, most_open: int):
        self.capacity, self.most_open = capacity, most_open
        self.free_bits, self.open = 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bins = 0

    def place(self, size: int) -> tuple[int, int]:
        """The bin and the offset in it."""
        above = self.free_bits >> size
        if size < self.capacity and above:
            free = size + (above & -above).bit_length() - 1
            bin_ = self._take(free)
        else:
            if size < self.capacity and self.open == self.most_open:
                self._take((self.free_bits & -self.free_bits).bit_length() - 1)
            free, bin_ = self.capacity, self.bins
            self.bins += 1
        if free > size:
            self._put(free - size, bin_)
        return bin_, self.capacity - free

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        bin_ = stack.pop()
        self.open -= 1
        if not stack:
            self.free_bits &= ~(1 << free)
        return bin_

    def _put(self, free: int, bin_: int) -> None:
        self.by_free[free].append(bin_)
        self.free_bits |= 1 << free
        self.open += 1


def best_fit(pieces: DataFrame, capacity: int = 1024, most_open: int = 4096, length: str = "length", order: tuple[str, ...] = ("doc_id", "piece"), extra_order: tuple[str, ...] = ("start", "length", "ids_crc32")) -> DataFrame:
    """Place pieces of 1 to capacity units: adds sequence_id and offset; offsets in a sequence run gapless from 0.

    Every partition packs its own share in a hashed order with most_open open bins, so memory is bounded and
    nothing passes through one task. Rows are dealt by the hash of a whole row's contents: the same rows give the
    same packing, and a task that runs again gives its first result. Rows that repeat whole are each placed.
    """

    def pack(batches):
        part = TaskContext.get().partitionId()
        fit = BestFit(capacity, most_open)
        for batch in batches:
            sizes = batch.column(batch.schema.get_field_index(length)).to_pylist()
            placed = [fit.place(s) for s in sizes]
            seq = pa.array([(part << 36) + b for b, _ in placed], pa.int64())
            off = pa.array([o for _, o in placed], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], seq, off], [*batch.schema.names[:-1], "sequence_id", "offset"])

    keyed = pieces.withColumn("_deal", F.xxhash64(*order))
    schema = extended(pieces.schema, "sequence_id long, offset long")
    return keyed.repartition("_deal").sortWithinPartitions("_deal", *order, *extra_order).mapInArrow(pack, schema)
