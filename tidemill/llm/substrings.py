"""Substring dedup: removes word windows that also occur in an earlier document."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Sequence, extended, materialize, pieces, row_key, span_hashes, word_spans

_SPAN = "array<struct<s:int,e:int>>"


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of every w neighbours, by doubling."""
    have = 1
    while 2 * have <= w:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (w - have)], x[w - have :]) if w > have else x


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _words(text: bytes) -> np.ndarray:
    return span_hashes(text, *word_spans(text))


def window_runs(docs: DataFrame, width: int, anchor: int) -> DataFrame:
    """Runs of consecutive windows that share their least anchor: (key, doc_id, start, n, anchor, content).

    Every window of `width` words gets a rolling hash of each `anchor` words in it; its least one names it, so equal
    windows have equal names wherever they stand. Neighbouring windows mostly share the name and go as one row.
    """

    def runs(batches):
        for batch in pieces(batches):
            keys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            out = [[], [], [], [], [], []]
            for key, doc, text in zip(keys, ids, batch.column(2).to_pylist(), strict=True):
                seq = Sequence(_words(text))
                if seq.n < width:
                    continue
                least = _sliding_min(seq.windows(anchor), width - anchor + 1)
                starts = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
                n = np.diff(np.append(starts, len(least)))
                for col, x in zip(out, (np.full(len(starts), key), np.full(len(starts), doc), starts, n, least[starts], seq.runs(starts, starts + n + width - 1)), strict=True):
                    col.append(x)
            cat = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cat[0]), pa.array(cat[1]), pa.array(cat[2].astype(np.int32)), pa.array(cat[3].astype(np.int32)), _signed(cat[4]), _signed(cat[5])],
                ["key", "doc_id", "start", "n", "anchor", "content"],
            )

    return docs.mapInArrow(runs, "key long, doc_id long, start int, n int, anchor long, content long")


def _windows_of(rows: DataFrame, width: int) -> DataFrame:
    """Rabin-Karp hashes (128 bits) of all windows of the runs asked for: (anchor, content, doc_id, at, h1, h2)."""

    def hashes(batches):
        for batch in pieces(batches):
            out = [[], [], [], [], [], []]
            for doc, text, asked in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = _words(text)
                one = Sequence(words).windows(width)
                two = Sequence(words ^ np.uint64(0xA5A5A5A55A5A5A5A)).windows(width)
                for x in asked:
                    at = np.arange(x["start"], x["start"] + x["n"])
                    for col, y in zip(out, (np.full(len(at), x["anchor"]), np.full(len(at), x["content"]), np.full(len(at), doc), (at - x["start"]), one[at], two[at]), strict=True):
                        col.append(y)
            cat = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cat[0].astype(np.int64)), pa.array(cat[1].astype(np.int64)), pa.array(cat[2].astype(np.int64)), pa.array(cat[3].astype(np.int32)), _signed(cat[4]), _signed(cat[5])],
                ["anchor", "content", "doc_id", "at", "h1", "h2"],
            )

    return rows.mapInArrow(hashes, "anchor long, content long, doc_id long, at int, h1 long, h2 long")


def repeated_spans(docs: DataFrame, width: int = 50, anchor: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Maximal word spans covered by windows that also start in a document with a smaller id: (key, spans).

    key is row_key(doc_id, text). Windows go through three counts, each over all documents:

    1. runs of windows are counted by their content; a run that a smaller document holds too goes whole;
    2. only an anchor with several different run contents can hold windows that partly agree, and only for the
       smallest holder of such a content are single windows hashed and counted;
    3. repeated windows merge, by document, into maximal spans.

    So what is shuffled is about one row for 20 words, and a passage shared by any number of documents is one
    content with many rows. Null texts have no windows; rows with a null id neither lose nor remove words.
    """
    rows = docs.select(row_key(doc_id, text).alias("key"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    runs = materialize(window_runs(rows, width, anchor), "runs")
    contents = runs.groupBy("anchor", "content").agg(
        F.min(F.struct("doc_id", "key", "start", "n")).alias("m"), (F.min("doc_id") < F.max("doc_id")).alias("again")
    )
    contents = materialize(contents.select("anchor", "content", "again", "m.*"), "contents")
    varied = contents.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor")
    asked = contents.join(varied, "anchor", "left_semi").groupBy("key", "doc_id").agg(
        F.collect_list(F.struct("start", "n", "anchor", "content")).alias("asked")
    )
    single = rows.join(asked, ["key", "doc_id"]).select("doc_id", "text", "asked")
    single = materialize(_windows_of(single, width), "windows")
    first = single.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    partly = (
        single.join(first.select("h1", "h2", "first"), ["h1", "h2"]).where("doc_id > first")
        .groupBy("anchor", "content").agg(F.collect_set("at").alias("at"))
    )
    known = contents.join(partly, ["anchor", "content"], "left").where(F.col("again") | F.col("at").isNotNull())
    known = materialize(known.select("anchor", "content", F.col("doc_id").alias("first"), "at"), "known")
    hit = runs.join(known, ["anchor", "content"]).where((F.col("doc_id") > F.col("first")) | F.col("at").isNotNull())
    span = F.when(
        F.col("doc_id") > F.col("first"),
        F.array(F.struct(F.col("start").alias("s"), (F.col("start") + F.col("n") + (width - 1)).alias("e"))),
    ).otherwise(F.transform("at", lambda x: F.struct((F.col("start") + x).alias("s"), (F.col("start") + x + width).alias("e"))))
    return hit.groupBy("key").agg(F.flatten(F.collect_list(span)).cast(_SPAN).alias("spans"))


def _merged(spans: list[dict] | None, n: int) -> np.ndarray:
    """Which of n words the spans cover."""
    step = np.zeros(n + 1, np.int32)
    if spans:
        np.add.at(step, [x["s"] for x in spans], 1)
        np.add.at(step, [x["e"] for x in spans], -1)
    return np.cumsum(step[:-1]) > 0


def remove_repeats(docs: DataFrame, width: int = 50, anchor: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of docs with n_words, n_removed, removed (maximal spans of words) and kept (words left, one space between).

    A null text gives no words and an empty kept text. Columns of docs with these names are replaced.
    """
    spans = repeated_spans(docs, width, anchor, doc_id, text).withColumnRenamed("key", "_key").withColumnRenamed("spans", "_spans")
    own = [c for c in docs.columns if c not in ("n_words", "n_removed", "removed", "kept")]
    left = docs.select(*own, row_key(doc_id, text).alias("_key"))
    joined = left.join(spans, "_key", "left").select(*own, F.col(text).cast("binary").alias("_raw"), "_spans")
    place = len(own)

    def apply(batches):
        for batch in pieces(batches):
            n_words, n_removed, removed, kept = [], [], [], []
            for raw, spans in zip(batch.column(place).to_pylist(), batch.column(place + 1).to_pylist(), strict=True):
                words = (raw or b"").split()
                gone = _merged(spans, len(words))
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                removed.append([{"s": int(s), "e": int(e)} for s, e in zip(edge[::2], edge[1::2], strict=True)])
                kept.append(b" ".join([w for w, x in zip(words, gone.tolist(), strict=True) if not x] if len(edge) else words))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:place], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(removed, pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                [*batch.schema.names[:place], "n_words", "n_removed", "removed", "kept"],
            )

    schema = extended(docs.select(*own).schema, f"n_words long, n_removed long, removed {_SPAN}, kept string")
    return joined.mapInArrow(apply, schema)
