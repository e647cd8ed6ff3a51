"""Quality rules: per-document measures and lines that recur across a host's documents."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Sequence, discard, extended, materialize, mix, pieces, row_key, span_hashes, word_spans

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_DIGITS = re.compile(rb"\d+")
_CONTINUES = 0x80


def _repeat_words(words: np.ndarray, n: int = 3) -> int:
    """Words in n-word windows that occur twice or more, all occurrences included."""
    windows = Sequence(words).windows(n)
    if len(windows) < 2:
        return 0
    _, back, count = np.unique(windows, return_inverse=True, return_counts=True)
    step = np.zeros(len(words) + 1, np.int32)
    at = np.flatnonzero(count[back] > 1)
    np.add.at(step, at, 1)
    np.add.at(step, at + n, -1)
    return int((np.cumsum(step) > 0).sum())


def measures(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of one text."""
    starts, ends = word_spans(text)
    raw = np.frombuffer(text, np.uint8)
    blanks = len(raw) - int((ends - starts).sum())
    chars = int(((raw & 0xC0) != _CONTINUES).sum()) - blanks
    lines = [x for x in text.split(b"\n") if x.split()] if len(starts) else []
    return len(starts), chars, int(_SYMBOLS[raw].sum()), len(lines) - len(set(lines)), _repeat_words(span_hashes(text, starts, ends))


def _normal(line: bytes) -> bytes:
    """A line as it is compared: A-Z lower-cased, digit runs as one 0, one space between words."""
    return b" ".join(_DIGITS.sub(b"0", line.lower()).split())


def document_lines(docs: DataFrame) -> DataFrame:
    """From (key, host, text) to one row for each different line of a document: (key, host, line, n_words, whole).

    line hashes host and normalised line together; whole hashes the document's text.
    """

    def lines(batches):
        for batch in pieces(batches):
            out: list[list] = [[], [], [], [], []]
            for key, host, text in zip(batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist(), strict=True):
                normal = [y for x in text.split(b"\n") if (y := _normal(x))]
                if not normal:
                    continue
                long = np.array([len(x) for x in normal])
                ends = np.cumsum(long)
                h = span_hashes(b"".join(normal), ends - long, ends)
                n = np.array([x.count(b" ") + 1 for x in normal])
                one, back = np.unique(h, return_inverse=True)
                whole = span_hashes(text, np.array([0]), np.array([len(text)]))
                salt = mix(np.array([host]).view(np.uint64))
                for col, x in zip(out, (np.full(len(one), key), np.full(len(one), host), mix(one ^ salt), np.bincount(back, weights=n).astype(np.int64), np.full(len(one), whole[0])), strict=True):
                    col.append(x)
            cat = [np.concatenate(c).view(np.int64) if c else np.zeros(0, np.int64) for c in out]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cat], ["key", "host", "line", "n_words", "whole"])

    return docs.mapInArrow(lines, "key long, host long, line long, n_words long, whole long")


def _without(text: str, host: int, found: list[int]) -> str:
    """The text without its lines whose (host, line) hashes are found."""
    lines = text.split("\n")
    normal = [_normal(x.encode()) for x in lines]
    long = np.array([len(x) for x in normal])
    ends = np.cumsum(long)
    h = mix(span_hashes(b"".join(normal), ends - long, ends) ^ mix(np.array([host], np.int64).view(np.uint64)))
    gone = np.isin(h.view(np.int64), found)
    return "\n".join(x for x, y, g in zip(lines, normal, gone, strict=True) if not (y and g))


def template_words(docs: DataFrame, most_docs: int = 10, share: float = 0.001, doc_id: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """How many words of each document stand in lines above its host's limits: (key, n_template, host_hash, found).

    key is row_key; found are the hashes of these lines, with host_hash in them.

    A line is above the limits if more than most_docs documents of its host hold it, and more than `share` of them.
    Documents with equal texts count once: copies alone make no template; finding them is other operators' work.
    Rows that repeat whole are one. Null texts have no lines; null hosts are one host. Lines are hashed and written
    once. Each count is over all documents, summed before it is shuffled; Spark's own size threshold decides whether
    the lines found are broadcast.
    """
    name = F.xxhash64(F.coalesce(F.col(host).cast("string"), F.lit("\x00")))
    rows = docs.select(row_key(doc_id, text).alias("key"), name.alias("host"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    old: list[str] = []
    lines = materialize(document_lines(rows), "lines", old)
    sizes = rows.select("host", F.xxhash64("text").alias("whole")).distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    # Copies are counted out only for lines that are common enough with them.
    often = lines.groupBy("line", "host").agg(F.count("*").alias("docs")).where(F.col("docs") > most_docs)
    often = often.join(sizes, "host").where(F.col("docs") > share * F.col("host_docs"))
    often = materialize(often.select("line", "host_docs"), "often", old)
    whole = lines.select("line", "whole").join(often, "line").groupBy("line", "whole").agg(F.max("host_docs").alias("host_docs"))
    found = whole.groupBy("line").agg(F.count("*").alias("n"), F.max("host_docs").alias("host_docs"))
    found = found.where((F.col("n") > most_docs) & (F.col("n") > share * F.col("host_docs")))
    found = materialize(found.select("line"), "templates", old)
    # Rows that repeat whole share a key, so each line is taken once.
    x = lines.select("key", "host", "line", "n_words").join(found, "line").groupBy("key", "host").agg(F.collect_set(F.struct("line", "n_words")).alias("x"))
    words = F.aggregate("x", F.lit(0).cast("long"), lambda n, y: n + y.n_words)
    x = materialize(x.select("key", words.alias("n_template"), F.col("host").alias("host_hash"), F.col("x.line").alias("found")), "found")
    discard(docs.sparkSession, old)
    return x


def judge_quality(
    docs: DataFrame, least_words: int = 50, most_repeat: float = 0.5, least_left: float = 0.3, doc_id: str = "doc_id", host: str = "source", text: str = "text", **limits
) -> DataFrame:
    """All rows of docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_template, kept and cleaned.

    A document fails the base rules with fewer than least_words words or more than most_repeat of its words in
    repeated 3-word windows; it is depleted if less than least_left of its words are left without template lines.
    cleaned is the text without these lines; a text that loses none stays as it is.
    Null and empty texts measure 0 and fail. A row that repeats whole gets the same verdict as once. Columns of docs with the added names are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    own = [c for c in docs.columns if c not in (*names, "base_failed", "n_template", "kept", "cleaned", "_key", "_raw")]
    x = docs.select(*own, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_raw"), row_key(doc_id, text).alias("_key"))

    def measure(batches):
        for batch in pieces(batches):
            got = [measures(t) for t in batch.column(batch.schema.get_field_index("_raw")).to_pylist()]
            cols = [pa.array(c, pa.int64()) for c in (zip(*got, strict=True) if got else [[]] * len(names))]
            keep = [i for i, n in enumerate(batch.schema.names) if n != "_raw"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *cols], [*(batch.schema.names[i] for i in keep), *names])

    schema = extended(docs.select(*own).schema, ", ".join(f"{n} long" for n in ("_key", *names)))
    x = x.mapInArrow(measure, schema)
    failed = (F.col("n_words") < least_words) | (F.col("n_repeat_words") > most_repeat * F.col("n_words"))
    x = x.withColumn("base_failed", failed)
    found = template_words(docs, doc_id=doc_id, host=host, text=text, **limits)
    # Dealt by key at every size: what is found grows with the documents, so the plan shouldn't change on the way.
    found = found.select(F.col("key").alias("_key"), F.col("host_hash").alias("_host"), "n_template", F.col("found").alias("_found"))
    x = x.join(found.hint("merge"), "_key", "left")
    x = x.withColumn("n_template", F.coalesce("n_template", F.lit(0).cast("long")))
    kept = ~F.col("base_failed") & (F.col("n_words") - F.col("n_template") >= least_left * F.col("n_words"))
    # Only texts that lose lines go to Python.
    hit = F.col("_found").isNotNull()
    drop = F.udf(lambda t, h, f: None if t is None else _without(t, h, f), "string", useArrow=True)
    cleaned = F.when(hit, drop(F.when(hit, F.col(text)), "_host", "_found")).otherwise(F.col(text))
    return x.withColumn("kept", kept).select(*own, *names, "base_failed", "n_template", "kept", cleaned.alias("cleaned"))
