"""Marts over the facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.storage import materialize

from . import clean, facts
from . import indicators as ind


def newest_session(df: DataFrame, date: str = "trading_date", among: DataFrame | None = None) -> DataFrame:
    """Rows of the newest date, by a scalar subquery, which unlike a join reaches the scan behind an aggregate by date.

    among is a frame with the same newest date that is cheaper to read, such as the bars behind a computed table.
    """
    return df.where(F.col(date) == (df if among is None else among).agg(F.max(date)).scalar())


def price_board(daily: DataFrame, live: DataFrame, stocks: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """The newest session beside the newest live candle; live values win, no live row leaves the session's."""
    now = live.groupBy("ticker").agg(F.max_by(F.struct("close", "volume", "minute_ts"), "minute_ts").alias("l"))
    x = newest_session(daily, among=among).join(now, "ticker", "left").join(stocks.select("ticker", "company_name", "exchange"), "ticker", "left")
    return x.select(
        "ticker", F.coalesce(F.nullif("company_name", F.lit("")), "ticker").alias("name"), "exchange", F.coalesce("l.close", "close").alias("price"), F.coalesce("l.volume", "volume").alias("volume"),
        F.col("l.minute_ts").alias("live_at"), F.col("l").isNotNull().alias("is_live"),
    )


def candle_series(daily: DataFrame, ticker: str, last: int) -> DataFrame:
    """The last rows of one ticker in order, with chart defaults."""
    x = daily.where(F.col("ticker") == ticker).orderBy(F.desc("trading_date")).limit(last)
    return clean.display_defaults(x).orderBy("trading_date")


def market_overview(daily: DataFrame, stocks: DataFrame, top: int = 5, among: DataFrame | None = None) -> DataFrame:
    """(section, name, value) of the newest session: breadth, totals, gainers, losers, most traded, sectors.

    The newest session is worked out once, as a small table; all sections read that. The three rankings are one pass,
    whose tasks keep `top` rows of each before they are shuffled.
    """
    x = newest_session(daily, among=among).join(stocks.select("ticker", "sector_id"), "ticker", "left")
    x = materialize(x.select("ticker", "sector_id", "price_change", "pct_change", "value"), "session")
    totals = x.agg(
        F.count_if(F.col("price_change") > 0).cast("double").alias("advancers"), F.count_if(F.col("price_change") < 0).cast("double").alias("decliners"),
        F.count_distinct("ticker").cast("double").alias("tickers"), F.sum("value").alias("value"),
    )
    out = totals.unpivot([], totals.columns, "name", "v").select(F.lit("totals").alias("section"), "name", "v")
    ranks = (("gainers", "pct_change", -F.col("pct_change")), ("losers", "pct_change", F.col("pct_change")), ("traded", "value", -F.col("value")))
    ranked = x.select(F.col("ticker").alias("name"), F.inline(F.array(*(F.struct(F.lit(section).alias("section"), F.col(value).alias("v"), order.alias("_by")) for section, value, order in ranks))))
    first = Window.partitionBy("section").orderBy(F.col("_by").asc_nulls_last(), "name")
    out = out.unionByName(ranked.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= top).select("section", "name", "v"))
    return out.unionByName(x.groupBy("sector_id").agg(F.avg("pct_change").alias("v")).select(F.lit("sectors").alias("section"), F.col("sector_id").alias("name"), "v"))


#: Signals in order of precedence, each with its condition.
EOD_SIGNALS = (
    ("breakout", "breakout_flag = 1"), ("breakdown", "breakdown_flag = 1"), ("overbought", "overbought_flag = 1"), ("oversold", "oversold_flag = 1"),
    ("volume_spike", "volume > {multiple} * coalesce(volume_sma_20, volume)"), ("macd_positive", "macd > 0 and macd > macd_signal"),
)
SNAPSHOT_ORDER = ("overbought", "oversold", "breakout", "breakdown", "volume_spike", "macd_positive")


def signal_scan(session: DataFrame, multiple: float = 1.5, order: tuple[str, ...] | None = None, macd: str | None = None) -> DataFrame:
    """Rows that show a signal, named by the first in order."""
    rules = {n: r.format(multiple=multiple) for n, r in EOD_SIGNALS} | ({"macd_positive": macd} if macd else {})
    signal = F.lit(None).cast("string")
    for name in reversed(order or tuple(rules)):
        signal = F.when(F.expr(rules[name]), name).otherwise(signal)
    return session.withColumn("signal", signal).where("signal is not null")


def snapshot_scan(session: DataFrame, shown: int = 30, looked_at: int = 80) -> DataFrame:
    """Of the 80 largest moves, the first 30 that show a signal; overbought comes first and volume counts from 1.4 times."""
    top = session.orderBy(F.abs("pct_change").desc(), "ticker").limit(looked_at)
    return signal_scan(top, 1.4, SNAPSHOT_ORDER, "macd > macd_signal").orderBy(F.abs("pct_change").desc(), "ticker").limit(shown)


def intraday_scan(buckets: DataFrame, multiple: float = 1.5) -> DataFrame:
    """Each ticker's newest bucket with RSI14 and bands from its buckets alone, where it shows a signal."""
    w = ind.by_time("ticker", "bucket_ts")
    x = buckets.withColumns({"delta": ind.change("close", w), "sma_20": ind.rolling(F.col("close"), w, 20), "sd": ind.rolling(F.col("close"), w, 20, F.stddev_samp), "volume_sma_20": ind.rolling(F.col("volume"), w, 20)})
    x = x.withColumns({"rsi_14": ind.rsi(F.col("delta"), w), "bb_upper": F.col("sma_20") + 2 * F.col("sd"), "bb_lower": F.col("sma_20") - 2 * F.col("sd")})
    x = facts.latest_rows(x, "ticker", "bucket_ts")
    signal = F.expr(f"case when close > bb_upper then 'breakout' when close < bb_lower then 'breakdown' when rsi_14 > 70 then 'overbought' when rsi_14 < 30 then 'oversold' when volume > {multiple} * volume_sma_20 then 'volume_spike' end")
    return x.withColumn("signal", signal).where("signal is not null").select("ticker", "bucket_ts", "close", "volume", "rsi_14", "bb_upper", "bb_lower", "volume_sma_20", "signal")


def sentiment_by_ticker(daily: DataFrame, detail: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """News and mean score of each ticker in the last days, its newest headline and mean confidence."""
    x = daily.where(F.col("news_date") >= F.date_sub(as_of, days)).groupBy("ticker").agg(
        F.sum("news_count").alias("news"), F.sum("positive_count").alias("positive"), F.sum("negative_count").alias("negative"), F.avg("avg_sentiment_score").alias("score"), F.max_by("top_headline", "news_date").alias("headline"),
    )
    d = detail.where(F.col("published_at") >= F.date_sub(as_of, days)).groupBy("ticker").agg(F.avg("confidence_score").alias("confidence"))
    return x.join(d, "ticker", "left")


def sentiment_by_date(daily: DataFrame) -> DataFrame:
    """A15."""
    return daily.groupBy("news_date").agg(F.sum("news_count").alias("news"), F.sum("positive_count").alias("positive"), F.sum("negative_count").alias("negative"), F.sum("neutral_count").alias("neutral"))


def alert_history(events: DataFrame, rules: DataFrame) -> DataFrame:
    """Events with their rule's cooldown: the rule for the ticker, else the one for ALL, else 0."""
    own = rules.groupBy("user_id", "condition_type", "channel", "ticker").agg(F.max("cooldown_minutes").alias("c"))
    exact = own.where("ticker <> 'ALL'").withColumnRenamed("c", "c1")
    every = own.where("ticker = 'ALL'").drop("ticker").withColumnRenamed("c", "c2")
    x = events.join(exact, ["user_id", "condition_type", "channel", "ticker"], "left").join(every, ["user_id", "condition_type", "channel"], "left")
    return x.withColumn("cooldown_minutes", F.coalesce("c1", "c2", F.lit(0))).drop("c1", "c2")


def alert_summary(events: DataFrame, *by: str) -> DataFrame:
    """Events, sent, failed and different tickers, in all or by a column."""
    return events.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(F.col("status") == "SENT").alias("sent"), F.count_if(F.col("status") == "FAILED").alias("failed"), F.count_distinct("ticker").alias("tickers"))


def watchlist_board(daily: DataFrame, watchlist: DataFrame, stocks: DataFrame) -> DataFrame:
    """Each user's tickers with their newest row and name; a ticker without rows stays."""
    newest = facts.latest_rows(daily.join(watchlist.select("ticker").distinct(), "ticker", "left_semi"), "ticker", "trading_date")
    return watchlist.join(newest.select("ticker", "trading_date", "close", "pct_change"), "ticker", "left").join(stocks.select("ticker", F.col("company_name").alias("name")), "ticker", "left")


def session_status(clock: Column) -> Column:
    """The session at a local clock time."""
    t = F.date_format(clock, "HH:mm")
    open_ = ((t >= "09:00") & (t < "11:30")) | ((t >= "13:00") & (t < "14:45"))
    return F.when(F.weekday(clock) > 4, "CLOSED").when(open_, "OPEN").when((t >= "11:30") & (t < "13:00"), "LUNCH").when((t >= "14:45") & (t < "15:00"), "CLOSING").otherwise("CLOSED")


def is_fresh(newest: Column, clock: Column, seconds: int = 90) -> Column:
    """M29."""
    return F.coalesce(F.unix_timestamp(clock.cast("timestamp")) - F.unix_timestamp(newest.cast("timestamp")) <= seconds, F.lit(False))


def delivery_lag(df: DataFrame, event: str, ingested: str, last: int = 60) -> DataFrame:
    """Mean seconds from event to ingest of the newest rows."""
    x = df.orderBy(F.desc(ingested), F.desc(event)).limit(last)
    return x.agg(F.count("*").alias("rows"), F.avg(F.unix_micros(F.col(ingested).cast("timestamp")) / 1e6 - F.unix_micros(F.col(event).cast("timestamp")) / 1e6).alias("lag_seconds"))


def consumer_lag(offsets: DataFrame) -> DataFrame:
    """(topic, partitions, lag) from rows of end and committed offsets; nothing committed counts from the start."""
    lag = F.greatest(F.col("end_offset") - F.coalesce("committed_offset", "start_offset", F.lit(0)), F.lit(0))
    return offsets.groupBy("topic").agg(F.count("*").alias("partitions"), F.sum(lag).alias("lag"))


def topped(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """K2, K3, K7: the first n rows; each task keeps n of its own before they meet."""
    return df.orderBy(*order).limit(n)


def extremes(df: DataFrame, value: str, n: int = 8, key: str = "ticker") -> DataFrame:
    """K7: the n rows with the highest and the n with the lowest known value, under `side`."""
    x = df.where(F.col(value).isNotNull())
    high = topped(x, n, F.desc(value), key).withColumn("side", F.lit("high"))
    return high.unionByName(topped(x, n, F.asc(value), key).withColumn("side", F.lit("low")))


def busiest_series(df: DataFrame, last: int, key: str = "ticker", time: str = "date") -> DataFrame:
    """K4, K6, K9: the last rows, in order, of the key that has most rows; ties go to the smaller key."""
    top = topped(df.groupBy(key).agg(F.count("*").alias("_n")), 1, F.desc("_n"), key).select(key)
    return topped(df.join(F.broadcast(top), key, "left_semi"), last, F.desc(time)).orderBy(time)


def rows_per_date(df: DataFrame, days: int = 14, date: str = "date") -> DataFrame:
    """Rows of each of the last days."""
    return facts.since_watermark(df, days, date).groupBy(date).agg(F.count("*").alias("n"))


def table_totals(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row a table: its rows and newest date."""
    out = None
    for name, (df, date) in tables.items():
        one = facts.total(df, name, date)
        out = one if out is None else out.unionByName(one)
    return out


def session_stats(bars: DataFrame, lot: int = 1000, key: str = "ticker") -> DataFrame:
    """Sessions, volume, extremes and traded value of each key."""
    return bars.groupBy(key).agg(F.count("*").alias("sessions"), F.sum("volume").alias("volume"), F.max("high").alias("high"), F.min("low").alias("low"), F.sum(F.col("close") * F.col("volume") * lot).alias("traded"))


def signal_counts(daily: DataFrame, multiple: float = 1.5, key: str = "ticker") -> DataFrame:
    """Extremes and how often each key showed which signal."""
    return daily.groupBy(key).agg(
        F.max("high").alias("high"), F.min("low").alias("low"), F.count_if(F.col("rsi_14") > 70).alias("overbought"), F.count_if(F.col("rsi_14") < 30).alias("oversold"),
        F.count_if(F.col("close") > F.col("bb_upper")).alias("breakout"), F.count_if(F.col("volume") > multiple * F.coalesce("volume_sma_20", "volume")).alias("volume_spike"),
    )


def daily_means(index: DataFrame, sentiment: DataFrame, top: DataFrame, n: int = 10) -> DataFrame:
    """(part, name, day, value): each index's mean close a day, the mean sentiment a day, and the n keys of the largest traded value."""
    day = lambda df, part, name, date, value: df.select(F.lit(part).alias("part"), name.alias("name"), F.col(date).alias("day"), F.col(value).alias("value"))
    i = day(index.groupBy("index_id", "trading_date").agg(F.avg("close_point").alias("v")), "index", F.col("index_id"), "trading_date", "v")
    s = day(sentiment.groupBy("news_date").agg(F.avg("avg_sentiment_score").alias("v")), "sentiment", F.lit("all"), "news_date", "v")
    t = topped(top.groupBy("ticker").agg(F.max("value").alias("v")), n, F.desc("v"), "ticker").withColumn("_d", F.lit(None).cast("date"))
    return i.unionByName(s).unionByName(day(t, "traded", F.col("ticker"), "_d", "v"))


def stock_list(stocks: DataFrame, priced: DataFrame) -> DataFrame:
    """The stocks with whether any price row has their ticker."""
    have = priced.select("ticker").distinct().withColumn("has_price_data", F.lit(True))
    return stocks.select("ticker", "exchange").join(have, "ticker", "left").withColumn("has_price_data", F.coalesce("has_price_data", F.lit(False)))


def index_block(index: DataFrame, last: int = 30) -> DataFrame:
    """Each index's newest session with change and breadth, and its last closes in order as one array of (day, value).

    Only the rows that a task's own last ones leave meet, at most `last` an index and task.
    """
    w = Window.partitionBy("index_id").orderBy(F.desc("trading_date"))
    x = index.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= last)
    newest = lambda c: F.max_by(c, "trading_date").alias(c)
    return x.groupBy("index_id").agg(
        F.max("trading_date").alias("trading_date"), *map(newest, ("close_point", "point_change", "pct_change", "total_value", "total_volume", "advance_count", "decline_count", "unchanged_count")),
        F.array_sort(F.collect_list(F.struct(F.col("trading_date").alias("day"), F.col("close_point").alias("value")))).alias("history"),
    )


def distinct_values(df: DataFrame, by: str, of: str, name: str) -> DataFrame:
    """The sorted different values of a column for each key."""
    return df.groupBy(by).agg(F.array_sort(F.collect_set(of)).alias(name))


def vwap_board(vwap: DataFrame, far: float = 2.0, all_sessions: bool = False) -> DataFrame:
    """Each ticker's newest price, VWAPs and deviation in the newest session, or in all of them, its volume there, and how often it was far off, above and below."""
    d = F.col("price_vs_session_vwap_pct")
    at = F.struct("minute_ts", "data_source")
    last = lambda c: F.max_by(c, at).alias(c)
    x = vwap if all_sessions else newest_session(vwap)
    return x.groupBy("ticker").agg(
        *map(last, ("close", "vwap_1m", "session_vwap", "price_vs_session_vwap_pct", "minute_ts")), F.sum("volume").alias("volume"),
        F.count_if(F.abs(d) >= far).alias("far"), F.count_if(d > 0).alias("above"), F.count_if(d < 0).alias("below"),
    )


def vwap_series(vwap: DataFrame, tickers: DataFrame) -> DataFrame:
    """The newest session's minutes of the given tickers: price, both VWAPs, volume and deviation."""
    x = newest_session(vwap.join(tickers.select("ticker").distinct(), "ticker", "left_semi"), among=vwap)
    return x.select("ticker", "data_source", "minute_ts", F.col("close").alias("price"), "vwap_1m", "session_vwap", "volume", F.col("price_vs_session_vwap_pct").alias("deviation"))


def article_list(detail: DataFrame, stocks: DataFrame, as_of: Column, days: int = 7, most: int = 120, tickers: DataFrame | None = None) -> DataFrame:
    """The articles of the last days, newest judged first, at most `most` of them; with tickers, so many of each of these."""
    x = detail.where(F.col("published_at") >= F.date_sub(as_of, days))
    order = (F.desc("inferred_at"), F.col("article_id"), F.col("ticker"))
    if tickers is None:
        x = topped(x, most, *order)
    else:
        w = Window.partitionBy("ticker").orderBy(*order)
        x = x.join(tickers.select("ticker").distinct(), "ticker", "left_semi").withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")
    x = x.join(stocks.select("ticker", "company_name"), "ticker", "left")
    return x.withColumn("name", F.coalesce(F.nullif("company_name", F.lit("")), "ticker")).drop("company_name")


def ranked(df: DataFrame, by: str, order: Column, n: int) -> DataFrame:
    """Top n rows of each group."""
    w = Window.partitionBy(by).orderBy(order)
    return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)
