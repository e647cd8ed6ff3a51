"""Alert rules as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import indicators as ind
from .dims import date_id

#: Which metric a crossing condition follows from cycle to cycle.
CROSSING_METRIC = {"VWAP_CROSS_UP": "price_vs_session_vwap_pct", "VWAP_CROSS_DOWN": "price_vs_session_vwap_pct", "RSI_CROSS_UP": "rsi_14", "RSI_CROSS_DOWN": "rsi_14"}
CONDITIONS = ("PRICE_ABOVE", "PRICE_BELOW", "RSI_ABOVE", "RSI_BELOW", "BB_BREAK", "VWAP_DEVIATION", "INTRADAY_VOLUME_SPIKE", "INTRADAY_BREAKOUT", "STOP_LOSS", "TAKE_PROFIT", *CROSSING_METRIC)


def active(rules: DataFrame) -> DataFrame:
    """IO20."""
    return rules.where("is_active") if "is_active" in rules.columns else rules


def expand_rules(rules: DataFrame, universe: DataFrame, watchlist: DataFrame) -> DataFrame:
    """ALL stands for every ticker, WATCHLIST for the user's, anything else for itself. Rules are few, so each kind is one join."""
    rest = [c for c in rules.columns if c != "ticker"]
    every = rules.where("ticker = 'ALL'").drop("ticker").crossJoin(universe.select("ticker").distinct())
    own = rules.where("ticker = 'WATCHLIST'").drop("ticker").join(watchlist.select("user_id", "ticker").distinct(), "user_id")
    plain = rules.where("ticker not in ('ALL', 'WATCHLIST')")
    return every.select(*rest, "ticker").unionByName(own.select(*rest, "ticker")).unionByName(plain.select(*rest, F.upper("ticker").alias("ticker")))


def market_context(daily: DataFrame, vwap: DataFrame, candles: DataFrame) -> DataFrame:
    """One row a ticker: the newest session's indicators, the newest live deviation, the newest candle against its band. A live close wins."""
    day = daily.join(F.broadcast(daily.agg(F.max("trading_date").alias("trading_date"))), "trading_date").select("ticker", "close", "rsi_14", "bb_upper", "bb_lower")
    live = vwap.groupBy("ticker").agg(F.max_by("price_vs_session_vwap_pct", "minute_ts").alias("price_vs_session_vwap_pct"))
    band = ind.trailing_band(candles).select("ticker", F.col("close").alias("live_close"), F.col("volume_ratio").alias("intraday_volume_ratio"), F.col("band_high").alias("intraday_rolling_high_20"), F.col("band_low").alias("intraday_rolling_low_20"))
    x = day.join(live, "ticker", "full").join(band, "ticker", "full")
    return x.withColumn("close", F.coalesce("live_close", "close")).drop("live_close")


def actual_value(condition: str = "condition_type", threshold: str = "threshold_value", previous: str = "previous_value") -> Column:
    """The value that meets the condition, null if none does; an unknown one is null too (see unknown_rules)."""
    c, t, p = F.col(condition), F.col(threshold), F.col(previous)
    close, rsi, dev = F.col("close"), F.col("rsi_14"), F.col("price_vs_session_vwap_pct")
    ratio, high, low = F.col("intraday_volume_ratio"), F.col("intraday_rolling_high_20"), F.col("intraday_rolling_low_20")
    cases = {
        "PRICE_ABOVE": (close > t, close), "PRICE_BELOW": (close < t, close), "RSI_ABOVE": (rsi > t, rsi), "RSI_BELOW": (rsi < t, rsi),
        "BB_BREAK": (F.coalesce(close > F.col("bb_upper"), F.lit(False)) | F.coalesce(close < F.col("bb_lower"), F.lit(False)), close),
        "VWAP_DEVIATION": (F.abs(dev) > t, dev), "INTRADAY_VOLUME_SPIKE": (ratio > t, ratio),
        "INTRADAY_BREAKOUT": (F.coalesce(close > high * (1 + t / 100), F.lit(False)) | F.coalesce(close < low * (1 - t / 100), F.lit(False)), close),
        "STOP_LOSS": (close <= t, close), "TAKE_PROFIT": (close >= t, close),
        "VWAP_CROSS_UP": ((p <= 0) & (dev > 0), dev), "VWAP_CROSS_DOWN": ((p >= 0) & (dev < 0), dev),
        "RSI_CROSS_UP": ((p <= t) & (rsi > t), rsi), "RSI_CROSS_DOWN": ((p >= t) & (rsi < t), rsi),
    }
    out = F.lit(None).cast("double")
    for name, (met, value) in cases.items():
        out = F.when(c == name, F.when(met, value)).otherwise(out)
    return out


def unknown_rules(rules: DataFrame) -> DataFrame:
    """R2: rules whose condition no one knows."""
    return rules.where(~F.coalesce(F.col("condition_type").isin(*CONDITIONS), F.lit(False)))


def latest_state(state: DataFrame) -> DataFrame:
    """The newest metric of each (alert, ticker)."""
    return state.groupBy("alert_id", "ticker").agg(F.max_by("metric_value", "updated_at").alias("previous_value"))


def evaluate(rules: DataFrame, market: DataFrame, state: DataFrame) -> DataFrame:
    """Expanded rules with what they see and actual_value, null where they don't fire. Tickers without a market row don't fire."""
    x = rules.join(market, "ticker", "left").join(latest_state(state), ["alert_id", "ticker"], "left")
    return x.withColumn("actual_value", actual_value())


def next_state(evaluated: DataFrame, now: Column) -> DataFrame:
    """Each crossing rule's metric, whether it fired or not."""
    metric = F.lit(None).cast("double")
    for name, column in CROSSING_METRIC.items():
        metric = F.when(F.col("condition_type") == name, F.col(column)).otherwise(metric)
    return evaluated.select("alert_id", "ticker", metric.alias("metric_value"), now.alias("updated_at")).where("metric_value is not null")


def off_cooldown(fired: DataFrame, events: DataFrame, now: Column) -> DataFrame:
    """Fired rules without an event of the same user, ticker, condition and channel within their cooldown, whatever became of it."""
    key = ["user_id", "ticker", "condition_type", "channel"]
    last = events.where(F.col("triggered_at") <= now).groupBy(*key).agg(F.max("triggered_at").alias("_last"))
    x = fired.join(last, key, "left")
    quiet = F.col("_last").isNull() | (F.col("_last") < now - F.make_dt_interval(F.lit(0), F.lit(0), F.coalesce("cooldown_minutes", F.lit(0))))
    return x.where(quiet).drop("_last")


def event_rows(fired: DataFrame, now: Column, sent: Column | None = None) -> DataFrame:
    """An event a row; its id names rule, ticker and time, so a cycle that runs again makes the same events."""
    sent = F.lit(True) if sent is None else sent
    return fired.select(
        F.sha1(F.concat_ws("|", "alert_id", "ticker", now.cast("string"))).alias("event_id"), "alert_id", "user_id", "ticker", "condition_type", "channel", date_id(now).alias("date_id"), now.alias("triggered_at"),
        "threshold_value", "actual_value", F.when(sent, "SENT").otherwise("FAILED").alias("status"), F.when(sent, now).alias("sent_at"),
    )


def digests(events: DataFrame, most: int = 25) -> DataFrame:
    """One text a user and channel: conditions in order, a count and at most `most` lines of each, then how many more."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id", "channel", "condition_type").orderBy("ticker", "event_id")
    x = events.withColumn("_n", F.row_number().over(w))
    line = F.format_string("- %s: %.2f", "ticker", "actual_value")
    groups = x.groupBy("user_id", "channel", "condition_type").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("_n") <= most, F.struct("_n", line.alias("line"))))).alias("lines"))
    more = F.when(F.col("n") > most, F.format_string("… %d more", F.col("n") - most))
    text = F.concat_ws("\n", F.format_string("%s (%d)", "condition_type", "n"), F.array_join(F.transform("lines", lambda s: s.line), "\n"), more)
    return groups.groupBy("user_id", "channel").agg(F.sum("n").alias("alerts"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("condition_type", text.alias("text")))), lambda s: s.text), "\n\n").alias("digest"))


def cycle_summary(evaluated: DataFrame, kept: DataFrame) -> DataFrame:
    """Rules checked, fired and held back by a cooldown."""
    a = evaluated.agg(F.count("*").alias("checked"), F.count_if(F.col("actual_value").isNotNull()).alias("fired"))
    return a.crossJoin(F.broadcast(kept.agg(F.count("*").alias("triggered")))).withColumn("skipped", F.col("fired") - F.col("triggered"))
