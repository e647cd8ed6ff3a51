"""Registered queries: streams read back, state that goes on, scans over ordered partitions, tables replaced by key (IO, R, T, W)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import alerts, facts, ordered, resume
from tidemill.sources import versions
from tidemill.storage import materialize, new_folder
from tidemill.streaming import alerts as watch
from tidemill.streaming import ticks as streams

from .adapters import BARS, TICKS, _nudge, daily_bars, rounded, sql_rounds, table, ticks, with_
from .prices import _EMA, _IND, _P
from .realtime import _DEV, _STATES, _VWAP
from .registry import query


def _recursive(*ctes: str) -> str:
    return with_(*ctes).replace("with ", "with recursive ", 1)


def _run(writer) -> None:
    """A stream over what there is; fails with its error."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


# --- alerts on a stream ---------------------------------------------------------------------------------------------

_WATCH = """('w1', 'u1', 'ALL', 'PRICE_ABOVE', 60.0, 'mail', 1440), ('w2', 'u1', 'WATCHLIST', 'PRICE_ABOVE', 90.0, 'mail', 60), ('w3', 'u2', 'ALL', 'PRICE_BELOW', 2.0, 'chat', 4320), ('w4', 'u2', 'ALL', 'VWAP_DEVIATION', 50.0, 'chat', 600),
    ('w5', 'u3', 'ALL', 'VWAP_CROSS_UP', 0.0, 'mail', 2880), ('w6', 'u3', 'ALL', 'VWAP_CROSS_DOWN', 0.0, 'mail', 0), ('w7', 'u1', 'u7', 'STOP_LOSS', 20.0, 'mail', 30), ('w8', 'u2', 'u7', 'TAKE_PROFIT', 30.0, 'mail', 10000)"""
_NAMES = "alert_id, user_id, ticker, condition_type, threshold_value, channel, cooldown_minutes"


def _watch_rules(spark: SparkSession, tickers: DataFrame) -> DataFrame:
    rules = spark.sql(f"select * from values {_WATCH} as t({_NAMES})").withColumn("threshold_value", F.col("threshold_value").cast("double"))
    own = tickers.where("cast(substring(ticker, 2, 9) as int) % 3 = 0").select(F.lit("u1").alias("user_id"), "ticker")
    return alerts.expand_rules(rules, tickers, own)


_WATCHED = _recursive(TICKS, f"""universe as (select distinct ticker from ticks),
    rules as (select r.alert_id, r.user_id, u.ticker, r.condition_type, cast(r.threshold_value as double) as t, r.channel, r.cooldown_minutes as c from (values {_WATCH}) r({_NAMES}) join universe u
        on r.ticker = 'ALL' or (r.ticker = 'WATCHLIST' and cast(substr(u.ticker, 2) as integer) % 3 = 0) or upper(r.ticker) = u.ticker),
    m as (select *, sum(price * volume) over s / sum(volume) over s as v from ticks window s as (partition by ticker, cast(trade_ts as date) order by trade_ts, seq rows unbounded preceding)),
    d as (select *, round((price - v) / v * 100, 6) as dev from m), b as (select *, lag(dev) over (partition by ticker order by trade_ts, seq) as before from d),
    f as (select rules.*, trade_ts, seq, case when condition_type in ('VWAP_DEVIATION', 'VWAP_CROSS_UP', 'VWAP_CROSS_DOWN') then dev else price end as x from b join rules using (ticker)
        where case condition_type when 'PRICE_ABOVE' then price > t when 'PRICE_BELOW' then price < t when 'STOP_LOSS' then price <= t when 'TAKE_PROFIT' then price >= t when 'VWAP_DEVIATION' then abs(dev) > t
            when 'VWAP_CROSS_UP' then before <= 0 and dev > 0 else before >= 0 and dev < 0 end),
    g as (select f.*, row_number() over (partition by user_id, ticker, condition_type, channel order by trade_ts, seq, alert_id) as n,
        dense_rank() over (partition by user_id, ticker, condition_type, channel order by trade_ts, seq) as k from f),
    r as (select user_id, ticker, condition_type, channel, 0 as n, cast(0 as bigint) as k, false as keep, null::timestamp as held, null::timestamp as last from g where n = 1
        union all
        select g.user_id, g.ticker, g.condition_type, g.channel, g.n, g.k, q.quiet, q.before, case when q.quiet then g.trade_ts else r.last end
        from r join g on g.user_id = r.user_id and g.ticker = r.ticker and g.condition_type = r.condition_type and g.channel = r.channel and g.n = r.n + 1,
        lateral (select case when g.k = r.k then r.held else r.last end as before, (case when g.k = r.k then r.held else r.last end) is null or (case when g.k = r.k then r.held else r.last end) < g.trade_ts - g.c * interval 1 minute as quiet) q)
    select g.alert_id, g.user_id, g.ticker, g.condition_type, g.channel, g.trade_ts as triggered_at, g.seq, g.t as threshold_value, round(g.x, 4) as actual_value
    from r join g on g.user_id = r.user_id and g.ticker = r.ticker and g.condition_type = r.condition_type and g.channel = r.channel and g.n = r.n where r.keep""")


@query(_WATCHED)
def r3_r5_stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ticks come in three parts by time; the stream stops after each and goes on from its checkpoint. Two closing ticks pass the delay."""
    source, path, checkpoint = (new_folder(spark, n) for n in ("watched", "alert-events", "alert-checkpoint"))
    t = ticks(spark, sf_dir).select("ticker", "trade_ts", "seq", "price", "volume")
    rules = materialize(_watch_rules(spark, t.select("ticker").distinct()), "rules")
    span = t.agg(F.min("trade_ts").alias("a"), F.max("trade_ts").alias("b"))
    share = F.expr("least(int(3 * timestampdiff(second, a, trade_ts) / (timestampdiff(second, a, b) + 1)), 2)")
    parts = t.join(F.broadcast(span), F.lit(True)).withColumn("_part", share)
    end = lambda days: span.select(F.lit("").alias("ticker"), (F.col("b") + F.make_dt_interval(F.lit(days))).alias("trade_ts"), F.lit(-1).cast("long").alias("seq"), F.lit(1.0).alias("price"), F.lit(1).cast("long").alias("volume"))
    for part in [*(parts.where(F.col("_part") == k).select(*t.columns) for k in range(3)), end(1), end(2)]:
        part.write.mode("append").parquet(source)
        _run(watch.land_events(spark.readStream.schema(t.schema).parquet(source), rules, path, checkpoint, "1 hour", float(_nudge(6))))
    x = spark.read.parquet(path).select("alert_id", "user_id", "ticker", "condition_type", "channel", "triggered_at", "seq", "threshold_value", "actual_value")
    return rounded(x, 4, "actual_value")


# --- ticks and candles on a stream ----------------------------------------------------------------------------------

_FED = """ticks as (select upper(concat('u', user_id)) as ticker, cast(date_trunc('second', to_timestamp(epoch_us(ts) // 1000000) at time zone 'UTC' + interval 7 hour) as timestamp) as trade_ts,
    value as price, 1 + cast(json_extract_string(props, '$.k') as bigint) as volume, 'feed' as data_source from events)"""


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a tick message with its time in microseconds."""
    e = table(spark, sf_dir, "events")
    body = F.struct(F.concat(F.lit("u"), "user_id").alias("symbol"), F.col("value").alias("price"), (F.get_json_object("props", "$.k").cast("double") + 1).alias("volume"), F.unix_micros(F.col("ts").cast("timestamp")).cast("string").alias("time"))
    return e.select("event_id", "ts", F.to_json(F.struct(body.alias("data"))).alias("value"))


def _land(spark: SparkSession, messages: DataFrame) -> tuple[str, str]:
    """Raw ticks and hourly states of a stream over the messages, at most two files a batch; a third of them comes late, in a second run."""
    source, raw, states, checkpoint = (new_folder(spark, n) for n in ("messages", "raw-ticks", "tick-states", "tick-checkpoint"))
    late = F.col("event_id") % 3 == 0
    for part in (messages.where(~late), messages.where(late)):
        part.select("value").repartition(4).write.mode("append").text(source)
        _run(streams.land_ticks(streams.parsed_ticks(streams.message_stream(spark, source, files_per_trigger=2)), raw, states, checkpoint, "hour"))
    return raw, states


@query(with_(_FED) + "select * from ticks")
def io12_t1_t9_landed_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, _ = _land(spark, _messages(spark, sf_dir))
    return spark.read.parquet(raw).select("ticker", "trade_ts", "price", "volume", "data_source")


_FED_STATES = _STATES.replace("trade_ts, seq", "trade_ts, price, volume").replace("as trades, avg(price) as avg_price", "as trades")


@query(with_(_FED, _FED_STATES, _VWAP) + f"select ticker, minute_ts, open, high, low, close, volume, trades, round(session_vwap, 4) as session_vwap, round({_DEV}, 4) as price_vs_session_vwap_pct from vwap")
def t2_t6_replayed_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One date is replayed twice and another once; each stands for its batches' partials by one switch."""
    raw, states = _land(spark, _messages(spark, sf_dir))
    first, last = map(str, spark.read.parquet(raw).agg(F.to_date(F.min("trade_ts")), F.to_date(F.max("trade_ts"))).first())
    for day in (first, first, last):
        streams.replay(spark, raw, states, day, "hour")
    x = streams.vwap_view(spark, states).select("ticker", "minute_ts", "open", "high", "low", "close", "volume", "trades", "session_vwap", "price_vs_session_vwap_pct")
    return rounded(x, 4, "session_vwap", "price_vs_session_vwap_pct")


@query(with_(BARS) + f"select ticker, cast(date as timestamp) + interval 7 hour as minute_ts, '1m' as resolution, {sql_rounds(4, 'open', 'high', 'low')}, round(close + case when volume % 2 = 0 then 1 else 0 end, 4) as close, volume from bars")
def t4_corrected_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles land in one run; those of even volume are corrected in a second, and messages of other resolutions go.

    Messages are most of what is written; compressed, a file is one task of the stream.
    """
    source, path, checkpoint = (new_folder(spark, n) for n in ("candle-messages", "candles", "candle-checkpoint"))
    b = materialize(daily_bars(spark, sf_dir), "bars")
    fields = [F.col("ticker").alias("symbol"), "open", "high", "low", "close", F.col("volume").cast("double").alias("volume"), F.unix_seconds(F.to_timestamp("date")).cast("string").alias("time")]
    first = b.withColumn("resolution", F.explode(F.array(F.lit("1"), F.lit("5"))))
    second = b.where("volume % 2 = 0").withColumns({"resolution": F.lit("1m"), "close": F.col("close") + 1})
    for k, part in enumerate((first, second)):
        part.select(F.to_json(F.struct(*fields, "resolution")).alias("value")).write.mode("append").option("compression", "gzip").text(source)
        now = lambda k=k: F.lit(f"2024-01-0{k + 1} 00:00:00").cast("timestamp_ntz")
        _run(streams.land_candles(streams.parsed_candles(streams.message_stream(spark, source)), path, checkpoint, now))
    x = streams.newest_candles(spark, path).select("ticker", "minute_ts", "resolution", "open", "high", "low", "close", "volume")
    return rounded(x, 4, "open", "high", "low", "close")


# --- scans and state ------------------------------------------------------------------------------------------------

_RESUMED = ("close", "price_change", "pct_change", "sma_20", "bb_upper", "rsi_14", "volume_sma_20", "ema_12", "ema_26", "macd", "macd_signal")


@query(_recursive(BARS, _P, _IND, _EMA) + f"""select i.ticker, i.date, cast(n as bigint) as history, {sql_rounds(4, *_RESUMED).replace('round(close,', 'round(i.close,')}, cast(coalesce(i.close > bb_upper, false) as integer) as breakout_flag
    from (select i.*, e12 as ema_12, e26 as ema_26, e12 - e26 as macd, sig as macd_signal from i join e using (ticker, date)) i where i.date > (select max(date) - 35 from bars)""")
def io21_w6_resumed_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 35 days from a state that two earlier runs have made, each of its own days alone."""
    bars = materialize(daily_bars(spark, sf_dir), "bars")
    bars = bars.join(F.broadcast(bars.agg(F.max("date").alias("_top"))), F.lit(True)).withColumn("_age", F.datediff("_top", "date"))
    state = resume.no_state(spark)
    for low, high in ((400, 10**6), (35, 400)):
        days = bars.where((F.col("_age") >= low) & (F.col("_age") < high)).drop("_top", "_age")
        state = materialize(resume.advanced(state, days), "indicator-state")
    x = resume.resumed(state, bars.where("_age < 35").drop("_top", "_age"))
    return rounded(x.select("ticker", "date", "history", *_RESUMED, "breakout_flag"), 4, *_RESUMED)


@query(_recursive(BARS, _EMA) + f"select ticker, date, {sql_rounds(4, 'ema_12', 'ema_26', 'macd', 'macd_signal')} from (select ticker, date, e12 as ema_12, e26 as ema_26, e12 - e26 as macd, sig as macd_signal from e)")
def w6_segmented_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More partitions than a ticker has years, so most histories are put together from several."""
    x = ordered.exponential_means(daily_bars(spark, sf_dir).select("ticker", "date", "close"), parts=200)
    return rounded(x.select("ticker", "date", "ema_12", "ema_26", "macd", "macd_signal"), 4, "ema_12", "ema_26", "macd", "macd_signal")


@query(with_(TICKS) + """select ticker, trade_ts, seq, round(sum(price * volume) over w, 4) as session_value, cast(sum(volume) over w as bigint) as session_volume from ticks
    window w as (partition by ticker order by trade_ts, seq rows unbounded preceding)""")
def w7_segmented_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running value and volume of each ticker over all its ticks."""
    t = ticks(spark, sf_dir).select("ticker", "trade_ts", "seq", "price", "volume")
    x = ordered.running_sums(t, ["ticker"], ["trade_ts", "seq"], {"session_value": F.col("price") * F.col("volume"), "session_volume": F.col("volume")}, parts=50)
    return rounded(x.select("ticker", "trade_ts", "seq", "session_value", F.col("session_volume").cast("long").alias("session_volume")), 4, "session_value")


@query(with_(BARS) + "select row_number() over (order by date desc, ticker) as row_id, ticker, date from bars")
def w11_global_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.running_ids(daily_bars(spark, sf_dir).select("ticker", "date"), F.desc("date"), F.col("ticker"), parts=16)


_IO22 = "ticker, date_id, trading_date, volume"


@query(with_(BARS) + f"""select ticker, cast(strftime(date, '%Y%m%d') as integer) as date_id, date as trading_date, case when date >= (select max(date) - 20 from bars) then volume * 2 else volume end as volume,
    round(close, 4) as close from bars""")
def io22_replaced_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart written once; then the newest 35 days are deleted and inserted with new volumes for 20 of them, twice."""
    root = new_folder(spark, "mart")
    x = daily_bars(spark, sf_dir).select("ticker", F.date_format("date", "yyyyMMdd").cast("int").alias("date_id"), F.col("date").alias("trading_date"), "volume", "close")
    x = materialize(x, "mart-rows")
    versions.replace_keys(x, root)
    new = facts.since_watermark(x, 35)
    twice = facts.since_watermark(x, 20).select("ticker", "trading_date", F.lit(2).alias("_times"))
    new = new.join(twice, ["ticker", "trading_date"], "left").withColumn("volume", F.col("volume") * F.coalesce("_times", F.lit(1))).drop("_times")
    for _ in range(2):
        versions.replace_keys(new, root)
    return rounded(versions.read_current(spark, root), 4, "close")
