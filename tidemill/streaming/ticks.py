"""Tick and candle streams (T1 to T9, IO12)."""

from __future__ import annotations

import json
import uuid
from collections import deque
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from tidemill.operators import clean, dedup, facts
from tidemill.schemas import CANDLE, TICK, VWAP_STATE
from tidemill.storage import read_pointer, switch_pointer


def message_stream(spark: SparkSession, path: str | None = None, servers: str | None = None, topic: str | None = None, files_per_trigger: int | None = None, offsets_per_trigger: int | None = None) -> DataFrame:
    """IO12, T9: messages as value string, from a topic or, for files of JSON lines, a folder; a batch holds at most so many offsets or files."""
    if servers:
        reader = spark.readStream.format("kafka").options(**{"kafka.bootstrap.servers": servers, "subscribe": topic})
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_trigger) if offsets_per_trigger else reader
        return reader.load().select(F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format("text")
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).load(path)


def parsed_ticks(messages: DataFrame, source: str = "feed") -> DataFrame:
    """P19 to P21 on a stream."""
    return clean.shape_ticks(messages.select(clean.unwrap_message("value").alias("body")), source=source)


def parsed_candles(messages: DataFrame, source: str = "feed") -> DataFrame:
    return clean.shape_candles(messages.select(clean.unwrap_message("value").alias("body")), source=source)


def _into(df: DataFrame, path: str, batch_id: int) -> None:
    """Writes a batch's rows as that batch's partition: a batch that runs again replaces its rows."""
    x = df.withColumn("batch_id", F.lit(batch_id))
    x.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def land_ticks(ticks: DataFrame, raw: str, states: str, checkpoint: str, unit: str = "minute") -> DataStreamWriter:
    """Each micro-batch's raw ticks, and their partial minute aggregates, as partitions of the batch.

    Late ticks are partials of a later batch for an earlier minute and merge at read, however late; retention is
    the tables' alone, so no watermark drops them.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            _into(df, raw, batch_id)
            _into(facts.minute_states(df, unit), states, batch_id)
        finally:
            df.unpersist()

    return ticks.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)


def current_states(spark: SparkSession, states: str) -> DataFrame:
    """The valid partials: those of the stream but for what a replay stands for, and the replays'. One row a replayed date is sent to all tasks."""
    live = spark.read.parquet(states)
    _, replays = read_pointer(spark, states)
    if not replays:
        return live
    hidden = spark.createDataFrame([(d, r["upto"]) for d, r in replays.items()], "_date string, _upto bigint").withColumn("_date", F.to_date("_date"))
    live = live.join(F.broadcast(hidden), F.to_date("minute_ts") == F.col("_date"), "left").where("_upto is null or batch_id > _upto").select(*live.columns)
    made = spark.read.schema(live.schema).parquet(*(f"{states}/{r['folder']}" for r in replays.values()))
    return live.unionByName(made)


def merged_minutes(spark: SparkSession, states: str) -> DataFrame:
    """A4: the minutes of all batches."""
    return facts.merge_states(current_states(spark, states))


def vwap_view(spark: SparkSession, states: str) -> DataFrame:
    """Session columns are computed when read, over minutes rather than ticks."""
    return facts.vwap(merged_minutes(spark, states))


def land_candles(candles: DataFrame, path: str, checkpoint: str, now: Callable[[], Column] = F.current_timestamp) -> DataStreamWriter:
    """Candles with their time of ingest; corrections are later rows."""
    return candles.writeStream.foreachBatch(lambda df, i: _into(df.withColumn("ingested_at", now()), path, i)).option("checkpointLocation", checkpoint)


def newest_candles(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of each minute; of one time of ingest, the later batch's."""
    x = spark.read.parquet(path)
    return dedup.latest(x, ["ticker", "minute_ts", "resolution"], ["ingested_at", "batch_id"]).drop("batch_id")


def replay(spark: SparkSession, raw: str, states: str, date: str, unit: str = "minute") -> None:
    """A date's states anew from its raw ticks, valid by one switch. Running it twice changes nothing.

    The new partials go to a folder of their own; a pointer then says that they stand for the date's partials of all
    batches up to the newest that has landed its states. Batches after it, of a stream that may be running, count
    beside them. Whatever step it stops after, readers see the partials of before, once, until the switch is made.
    """
    number, replays = read_pointer(spark, states)
    upto = spark.read.parquet(states).agg(F.max("batch_id")).first()[0]
    if upto is None:
        return
    ticks = spark.read.parquet(raw).where((F.to_date("trade_ts") == F.lit(date).cast("date")) & (F.col("batch_id") <= upto))
    folder = f"_replays/{date}-{uuid.uuid4().hex}"
    mine = facts.minute_states(ticks, unit).withColumn("batch_id", F.lit(upto).cast("int"))
    mine.write.parquet(f"{states}/{folder}")
    switch_pointer(spark, states, number, {**(replays or {}), date: {"folder": folder, "upto": upto}})


def offset_rows(progress: dict) -> list[tuple[str, str, int | None, int | None]]:
    """(source, partition, end, committed) of a streaming query's progress: the source's newest offset, and what the last batch has taken.

    A topic has a row a partition; other sources one, by the number in their offset.
    """

    def parts(offset) -> dict[str, int]:
        offset = json.loads(offset) if isinstance(offset, str) else offset
        if isinstance(offset, int):
            return {"0": offset}
        out: dict[str, int] = {}
        for name, x in (offset or {}).items():
            out |= {f"{name}-{p}": n for p, n in x.items()} if isinstance(x, dict) else {"0": x}
        return out

    rows = []
    for source in progress["sources"]:
        end, committed = parts(source.get("latestOffset")), parts(source.get("endOffset"))
        rows += [(source["description"], p, end.get(p, committed.get(p)), committed.get(p)) for p in sorted({*end, *committed})]
    return rows


class ProgressLog(StreamingQueryListener):
    """The newest progress of each query of the session, for lag while streams run; keeps `most` batches a query."""

    def __init__(self, most: int = 100):
        self.most, self.seen = most, {}

    def onQueryStarted(self, event) -> None:
        self.seen.setdefault(str(event.id), deque(maxlen=self.most))

    def onQueryProgress(self, event) -> None:
        self.seen.setdefault(str(event.progress.id), deque(maxlen=self.most)).append(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def lag(self, spark: SparkSession, query_id: str) -> DataFrame:
        """(batch_id, source, partition, end_offset, committed_offset, lag) of the batches seen; no offset yet counts as 0."""
        rows = [(p["batchId"], *r) for p in self.seen.get(query_id, ()) for r in offset_rows(p)]
        x = spark.createDataFrame(rows, "batch_id bigint, source string, partition string, end_offset bigint, committed_offset bigint")
        return x.withColumn("lag", F.greatest(F.coalesce("end_offset", F.lit(0)) - F.coalesce("committed_offset", F.lit(0)), F.lit(0)))


def watermarked_bars(ticks: DataFrame, late: str = "30 days", minutes: int = 1) -> DataFrame:
    """T5, the native form: windowed bars in update mode, with state kept for `late`."""
    x = ticks.withColumn("trade_ts", F.col("trade_ts").cast("timestamp")).withWatermark("trade_ts", late)
    return x.groupBy("data_source", "ticker", F.window("trade_ts", f"{minutes} minutes")).agg(
        F.min_by("price", "trade_ts").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "trade_ts").alias("close"), F.sum("volume").alias("volume"), F.sum(F.col("price") * F.col("volume")).alias("traded_value"), F.count("*").alias("trades"),
    )


#: Contracts of what the streams write.
CONTRACTS = {"ticks": TICK, "candles": CANDLE, "states": VWAP_STATE}
