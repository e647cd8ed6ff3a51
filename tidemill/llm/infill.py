"""Fill-in-middle transformation over seekable compressed frames.

A text is kept as independent zstandard frames with the units and code points that they end at, so a cut decompresses
the one frame that it falls into; the transformed text is a list of frames too, most of them the text's own ones.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extended, pieces

#: What marks the prefix, the suffix and the middle in a transformed text.
MARKS = (b"<P>", b"<S>", b"<M>")

FRAMED = "n_units long, n_chars long, marked boolean, frames array<struct<units: long, chars: long, joined: boolean, data: binary>>"
INFILLED = "n long, form string, prefix_chars long, middle_chars long, output array<binary>, output_sha256 string, restored_sha256 string"

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_pack, _unpack = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
_MARK_FRAMES = tuple(_pack.compress(m) for m in MARKS)


class Frame(NamedTuple):
    """units and chars: how many begin in the text up to the frame's end; joined: its first byte goes on a unit of the frame before."""

    units: int
    chars: int
    joined: bool
    data: bytes


class Cut(NamedTuple):
    """A place in a framed text: before byte `at` of frame `frame`, after `chars` code points."""

    frame: int
    at: int
    chars: int


def _starts(raw: np.ndarray, joined: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where units and code points begin. A unit is a run of ASCII letters or any other code point."""
    lead = (raw & 0xC0) != 0x80
    letter = _LETTERS[raw]
    after = np.empty(len(raw), bool)
    after[1:] = letter[:-1]
    after[:1] = joined
    return lead & ~(letter & after), lead


def frames_of(text: bytes, frame_bytes: int) -> list[Frame]:
    """The text in frames of at most frame_bytes, cut between code points; none if it is empty."""
    out: list[Frame] = []
    at = units = chars = 0
    while at < len(text):
        end = min(at + frame_bytes, len(text))
        while end < len(text) and end > at + 1 and text[end] & 0xC0 == 0x80:
            end -= 1
        part = text[at:end]
        joined = at > 0 and bool(_LETTERS[text[at - 1]] and _LETTERS[part[0]])
        unit, char = _starts(np.frombuffer(part, np.uint8), joined)
        units, chars = units + int(unit.sum()), chars + int(char.sum())
        out.append(Frame(units, chars, joined, _pack.compress(part)))
        at = end
    return out


def cut_before(frames: Sequence[Frame], unit: int) -> Cut:
    """Where unit number `unit` begins; only its frame is decompressed. The number of units stands for the text's end."""
    k = bisect_right(frames, unit, key=lambda f: f.units)
    if k == len(frames):
        return Cut(k, 0, frames[-1].chars if frames else 0)
    units, chars = (frames[k - 1].units, frames[k - 1].chars) if k else (0, 0)
    begins, lead = _starts(np.frombuffer(_unpack.decompress(frames[k].data), np.uint8), frames[k].joined)
    at = int(np.flatnonzero(begins)[unit - units])
    return Cut(k, at, chars + int(lead[:at].sum()))


def between(frames: Sequence[Frame], a: Cut, b: Cut) -> list[bytes]:
    """Compressed frames of the text from cut a to cut b: whole frames as they are, cut ones compressed anew."""
    if a[:2] == b[:2]:
        return []
    if a.frame == b.frame:
        return [_pack.compress(_unpack.decompress(frames[a.frame].data)[a.at : b.at])]
    first = [_pack.compress(_unpack.decompress(frames[a.frame].data)[a.at :])] if a.at else [frames[a.frame].data]
    last = [_pack.compress(_unpack.decompress(frames[b.frame].data)[: b.at])] if b.at else []
    return [*first, *(f.data for f in frames[a.frame + 1 : b.frame]), *last]


def contents(frames: Iterable[bytes]) -> Iterator[bytes]:
    """What the frames hold, one frame at a time."""
    return (_unpack.decompress(f) for f in frames)


def digest(chunks: Iterable[bytes]) -> str:
    h = hashlib.sha256()
    for c in chunks:
        h.update(c)
    return h.hexdigest()


def arrange(form: str, prefix: list[bytes], middle: list[bytes], suffix: list[bytes]) -> list[bytes]:
    """Frames of the transformed text."""
    p, s, m = ([mark, *part] for mark, part in zip(_MARK_FRAMES, (prefix, suffix, middle), strict=True))
    return [*p, *s, *m] if form == "psm" else [*s, *p, *m]


def restored(output: Sequence[bytes], form: str) -> Iterator[bytes]:
    """The text that a transformed one was made of, read from its frames and form alone, a frame at a time.

    The marks are looked for in the contents, whatever the frames' borders. Each occurs once there: a text that
    holds one stays plain, and none can arise where a part meets a mark.
    """
    if form == "plain":
        yield from contents(output)
        return
    ends, found, tail, at = [], dict.fromkeys(MARKS, -1), b"", 0
    for chunk in contents(output):
        seen = tail + chunk
        for mark in MARKS:
            if found[mark] < 0 and (i := seen.find(mark)) >= 0:
                found[mark] = at - len(tail) + i
        at += len(chunk)
        ends.append(at)
        tail = seen[-2:]
    p, s, m = (found[x] for x in MARKS)
    prefix, suffix = (p + 3, s if form == "psm" else m), (s + 3, m if form == "psm" else p)
    for a, b in (prefix, (m + 3, at), suffix):
        for k in range(bisect_right(ends, a), len(ends)):
            begin = ends[k - 1] if k else 0
            if begin >= b:
                break
            yield _unpack.decompress(output[k])[max(a - begin, 0) : b - begin]


def infill(name: str, n: int, marked: bool, frames: Sequence[Frame], seed: int = 1, rate: int = 90, spm: int = 20) -> tuple[str, int | None, int | None, list[bytes]]:
    """(form, code points of the prefix, of the middle, output frames) of one text; the draw depends on its name and the seed alone."""
    h = hashlib.sha256(f"{seed}:{name}".encode()).digest()
    h1, h2, h3, h4 = (int.from_bytes(h[i : i + 4], "big") for i in range(0, 16, 4))
    if not n or marked or h3 % 100 >= rate:
        return "plain", None, None, [f.data for f in frames]
    form = "spm" if h4 % 100 < spm else "psm"
    a, b = (cut_before(frames, k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    start, end = Cut(0, 0, 0), Cut(len(frames), 0, 0)
    return form, a.chars, b.chars - a.chars, arrange(form, between(frames, start, a), between(frames, a, b), between(frames, b, end))


def _others(df: DataFrame, *added: str) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in added])


def frame_texts(docs: DataFrame, frame_bytes: int = 1 << 16, text: str = "text") -> DataFrame:
    """Docs with their text column replaced by its frames: n_units, n_chars, marked (it holds a mark) and frames.

    Null and empty texts have no frames. A text of any length is one row, and a task holds it and one frame's arrays.
    Columns of docs with the added names are replaced; rows that repeat stay.
    """
    added = ("n_units", "n_chars", "marked", "frames")
    x = _others(docs.withColumn("_f_text", F.coalesce(F.col(text), F.lit("")).cast("binary")), text, *added)
    schema = extended(x.drop("_f_text").schema, FRAMED)
    kind = pa.list_(pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("joined", pa.bool_()), ("data", pa.binary())]))

    def make(batches):
        for batch in pieces(batches):
            made, marked = [], []
            for t in batch.column("_f_text"):
                raw = t.as_py()
                made.append(frames_of(raw, frame_bytes))
                marked.append(any(m in raw for m in MARKS))
            n = [(f[-1].units, f[-1].chars) if f else (0, 0) for f in made]
            yield pa.RecordBatch.from_arrays(
                [*(c for c, f in zip(batch.columns, batch.schema.names, strict=True) if f != "_f_text"), pa.array([u for u, _ in n], pa.int64()), pa.array([c for _, c in n], pa.int64()), pa.array(marked, pa.bool_()), pa.array([[f._asdict() for f in x] for x in made], kind)],
                names=schema.fieldNames(),
            )

    return x.mapInArrow(make, schema)


def fill_in_middle(framed: DataFrame, seed: int = 1, rate: int = 90, spm: int = 20, doc_id: str = "doc_id") -> DataFrame:
    """Framed texts with n (units), form, prefix_chars, middle_chars, output (frames), output_sha256 and restored_sha256.

    Prefix and middle end after two numbers of units drawn from sha256 of `seed:doc_id`; a rate of 100 transforms all
    that can be, spm of 100 of them put the suffix first. Empty texts, those that hold a mark and those not drawn stay
    plain, with null prefix_chars and middle_chars. restored_sha256 is of the text read back from output and form.
    A null doc_id counts as an empty name. Rows are independent: repeats stay and give equal results, no shuffle.
    Columns with the added names are replaced, the text's own frames go.
    """
    schema_of = ("n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256")
    source = ("n_units", "n_chars", "marked", "frames")
    own = [c for c in framed.columns if c not in schema_of and c not in source]
    x = framed.select(*own, F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_f_name"), *source)
    schema = extended(x.select(*own).schema, INFILLED)
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.string(), pa.string()]

    def make(batches):
        for batch in pieces(batches):
            out: list[list] = [[] for _ in types]
            for name, n, marked, raw in zip(*(batch.column(c) for c in ("_f_name", "n_units", "marked", "frames")), strict=True):
                frames = [Frame(**f) for f in raw.as_py()]
                form, prefix, middle, output = infill(name.as_py(), n.as_py(), marked.as_py(), frames, seed, rate, spm)
                row = (n.as_py(), form, prefix, middle, output, digest(contents(output)), digest(restored(output, form)))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *map(pa.array, out, types)], names=schema.fieldNames())

    return x.mapInArrow(make, schema)


def read_frames(df: DataFrame, frames: str = "output", text: str = "text") -> DataFrame:
    """df with the contents of its frames column as text in that column's stead."""
    x = _others(df, text) if text != frames else df
    own = [c for c in x.columns if c != frames]
    schema = extended(x.select(*own).schema, f"`{text}` string")

    def read(batches):
        for batch in pieces(batches):
            texts = [b"".join(contents(f.as_py())) for f in batch.column(frames)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(texts, pa.binary()).cast(pa.string())], names=schema.fieldNames())

    return x.mapInArrow(read, schema)
