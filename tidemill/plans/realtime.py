"""Registered queries: ticks, candles, VWAP, quality, reconciliation and alerts (A, D, J, M, Q, R, T)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import alerts, clean, dedup, facts, marts, quality
from tidemill.operators import indicators as ind
from tidemill.storage import materialize

from .adapters import BARS, INDEX_BARS, NEWS, PROFILES, TICKS, daily_bars, index_bars, news, profiles, rounded, table, ticks, with_
from .prices import _EMA, _IND, _P
from .registry import query

#: Ticks of the given tables are sparse, so their bars are of an hour.
_STATES = """states as (
    select data_source, ticker, date_trunc('hour', trade_ts) as minute_ts, first(price order by trade_ts, seq) as open, max(price) as high, min(price) as low, last(price order by trade_ts, seq) as close,
        cast(sum(volume) as bigint) as volume, sum(price * volume) as traded_value, count(*) as trades, avg(price) as avg_price from ticks group by 1, 2, 3)"""
_VWAP = """vwap as (
    select *, traded_value / volume as vwap_1m, sum(traded_value) over s as session_value, cast(sum(volume) over s as bigint) as session_volume,
        sum(traded_value) over s / sum(volume) over s as session_vwap, cast(minute_ts as date) as trading_date
    from states window s as (partition by data_source, ticker, cast(minute_ts as date) order by minute_ts rows unbounded preceding))"""
_DEV = "(close - session_vwap) / session_vwap * 100"


def _hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.merge_states(facts.minute_states(ticks(spark, sf_dir), "hour"))


def _vwap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.vwap(_hours(spark, sf_dir))


@query(with_(TICKS, _STATES) + "select data_source, ticker, minute_ts, open, high, low, close, volume, round(traded_value, 4) as traded_value, trades from states")
def a3_a4_minute_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partials of two batches, dealt by sequence number, merge to the bars of one."""
    t = ticks(spark, sf_dir)
    parts = facts.minute_states(t.where("seq % 2 = 0"), "hour").unionByName(facts.minute_states(t.where("seq % 2 = 1"), "hour"))
    return rounded(facts.merge_states(parts), 4, "traded_value")


@query(with_(TICKS, _STATES) + "select data_source, ticker, minute_ts, open, close, volume, round(avg_price, 4) as avg_price from states")
def a5_plain_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = facts.plain_minutes(ticks(spark, sf_dir), "hour").select("data_source", "ticker", "minute_ts", "open", "close", "volume", "avg_price")
    return rounded(x, 4, "avg_price")


@query(with_(TICKS, _STATES, _VWAP) + f"""select data_source, ticker, minute_ts, trading_date, round(vwap_1m, 4) as vwap_1m, round(session_value, 4) as session_value, session_volume, round(session_vwap, 4) as session_vwap,
    round((close - vwap_1m) / vwap_1m * 100, 4) as price_vs_vwap_pct, round({_DEV}, 4) as price_vs_session_vwap_pct from vwap""")
def m16_w7_vwap(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _vwap(spark, sf_dir).select("data_source", "ticker", "minute_ts", "trading_date", "vwap_1m", "session_value", "session_volume", "session_vwap", "price_vs_vwap_pct", "price_vs_session_vwap_pct")
    return rounded(x, 4, "vwap_1m", "session_value", "session_vwap", "price_vs_vwap_pct", "price_vs_session_vwap_pct")


_PREFERRED = """best as (select ticker, minute_ts, open, high, low, close, volume, data_source from states
    qualify row_number() over (partition by ticker, minute_ts order by data_source = 'view' desc, minute_ts desc, data_source desc) = 1)"""


def _preferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.prefer_source(_hours(spark, sf_dir).select("ticker", "minute_ts", "open", "high", "low", "close", "volume", "data_source").withColumn("v", F.col("minute_ts")), ["ticker", "minute_ts"], "view", "v").drop("v")


@query(with_(TICKS, _STATES, _PREFERRED) + "select * from best")
def d6_prefer_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _preferred(spark, sf_dir)


@query(with_(TICKS, _STATES, _PREFERRED) + """select ticker, time_bucket(interval 240 minute, minute_ts) as bucket_ts, first(open order by minute_ts) as open, max(high) as high, min(low) as low, last(close order by minute_ts) as close,
    cast(sum(volume) as bigint) as volume from best group by 1, 2""")
def a6_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.resample(_preferred(spark, sf_dir), 240)


@query(with_(TICKS) + "select ticker, data_source, last(price order by trade_ts, seq) as price, max(trade_ts) as trade_ts from ticks group by 1, 2")
def d4_latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.latest(ticks(spark, sf_dir).select("ticker", "data_source", "price", "trade_ts", "seq"), ["ticker", "data_source"], ["trade_ts", "seq"]).select("ticker", "data_source", "price", "trade_ts")


@query(with_(TICKS, _STATES) + "select data_source, list_sort(list(distinct ticker)) as tickers from states group by 1")
def a13_distinct_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.distinct_values(_hours(spark, sf_dir), "data_source", "ticker", "tickers")


@query(with_(TICKS, _STATES, _VWAP) + f"""select ticker, round(last({_DEV} order by minute_ts, data_source), 4) as deviation, count(*) filter (abs({_DEV}) >= 2) as far, count(*) filter ({_DEV} > 0) as above, count(*) filter ({_DEV} < 0) as below from vwap group by 1""")
def m21_a10_vwap_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = marts.vwap_board(_vwap(spark, sf_dir), all_sessions=True)
    x = x.select("ticker", F.col("price_vs_session_vwap_pct").alias("deviation"), "far", "above", "below")
    return rounded(x, 4, "deviation")


@query(with_(TICKS, _STATES, _PREFERRED) + """, a as (select ticker, minute_ts as ts, close, volume, coalesce(close - lag(close) over w, 0) as ch, row_number() over w as n from best window w as (partition by ticker order by minute_ts)),
    b as (select *, avg(volume) over w20 as vs, avg(close) over w20 as s, stddev_samp(close) over w20 as sd, avg(greatest(ch, 0)) over w14 as g, avg(greatest(-ch, 0)) over w14 as l, row_number() over (partition by ticker order by ts desc) as k
        from a window w20 as (partition by ticker order by ts rows between 19 preceding and current row), w14 as (partition by ticker order by ts rows between 13 preceding and current row)),
    f as (select ticker, ts, close, volume, case when n >= 14 then case when l = 0 then 100 else 100 - 100 / (1 + g / l) end end as rsi, case when n >= 20 then s + 2 * sd end as up, case when n >= 20 then s - 2 * sd end as lo, case when n >= 20 then vs end as vs from b where k = 1)
    select ticker, ts as bucket_ts, close, volume, round(rsi, 4) as rsi_14, round(up, 4) as bb_upper, case when close > up then 'breakout' when close < lo then 'breakdown' when rsi > 70 then 'overbought' when rsi < 30 then 'oversold' else 'volume_spike' end as signal
    from f where rsi > 70 or rsi < 30 or close > up or close < lo or volume > 1.5 * vs""")
def m23_intraday_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(marts.intraday_scan(_preferred(spark, sf_dir).withColumnRenamed("minute_ts", "bucket_ts")).select("ticker", "bucket_ts", "close", "volume", "rsi_14", "bb_upper", "signal"), 4, "rsi_14", "bb_upper")


@query(with_(TICKS) + "select * from ticks where trade_ts >= (select max(trade_ts) - interval 7 day from ticks)")
def io18_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.sources import tables

    return tables.retained(ticks(spark, sf_dir), "trade_ts", 7)


@query("""select upper(concat('u', user_id)) as ticker, cast(date_trunc('second', to_timestamp(epoch_us(ts) // 1000000) at time zone 'UTC' + interval 7 hour) as timestamp) as trade_ts, value as price, 1 + cast(json_extract_string(props, '$.k') as bigint) as volume, 'feed' as data_source from events""")
def p19_p21_message_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks go out as messages in three wrappings with times in seconds, milliseconds, microseconds or ISO text, and are read back."""
    e = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    n = F.col("event_id") % 4
    time = F.when(n == 0, micros.cast("string")).when(n == 1, F.floor(micros / 1000).cast("string")).otherwise(F.floor(micros / 1000000).cast("string"))
    body = F.struct(F.concat(F.lit("u"), "user_id").alias("symbol"), F.col("value").alias("price"), (F.get_json_object("props", "$.k").cast("double") + 1).alias("volume"), time.alias("time"))
    value = F.when(n == 0, F.to_json(F.struct(body.alias("data")))).when(n == 1, F.to_json(F.struct(body.alias("payload")))).otherwise(F.to_json(body))
    return clean.shape_ticks(e.select(clean.unwrap_message(value).alias("body")))


# --- quality and reconciliation -------------------------------------------------------------------------------------


def _suite_sql(source: str, suite: quality.Suite, frame: str, *ctes: str) -> str:
    parts = [f"select '{suite.name}' as suite, '{n}' as rule, count(*) filter (not coalesce({r}, false)) as failed from {frame}" for n, r in suite.rules]
    keys = ", ".join(suite.key)
    parts.append(f"select '{suite.name}', 'key_unique', cast(coalesce(sum(n - 1), 0) as bigint) from (select count(*) as n from {frame} group by {keys})")
    return with_(*ctes, source) + "select suite, rule, failed, failed = 0 as success from (" + " union all ".join(parts) + ")"


_RAW_BARS = "raw as (select concat('S', l_suppkey) as ticker, cast(l_shipdate as date) as date, l_extendedprice as open, l_extendedprice * (1 + l_tax) as high, l_extendedprice * (1 - l_discount) as low, l_extendedprice * (1 + l_tax - l_discount) as close, l_quantity - 1 as volume from lineitem)"


def _raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(F.concat(F.lit("S"), "l_suppkey").alias("ticker"), F.to_date("l_shipdate").alias("date"), p.alias("open"), (p * (1 + F.col("l_tax"))).alias("high"), (p * (1 - F.col("l_discount"))).alias("low"), (p * (1 + F.col("l_tax") - F.col("l_discount"))).alias("close"), (F.col("l_quantity") - 1).alias("volume"))


@query(_suite_sql(_RAW_BARS, quality.OHLCV, "raw"))
def q2_ohlcv_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expectations(_raw_bars(spark, sf_dir), quality.OHLCV)


@query(_suite_sql("x as (select * from profiles)", quality.PROFILE, "x", PROFILES))
def q3_profile_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expectations(profiles(spark, sf_dir), quality.PROFILE)


@query(_suite_sql("x as (select * from index_bars)", quality.INDEX, "x", BARS, PROFILES, INDEX_BARS))
def q4_index_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expectations(index_bars(spark, sf_dir), quality.INDEX)


@query(_suite_sql("x as (select * from news)", quality.NEWS, "x", NEWS))
def q5_news_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expectations(news(spark, sf_dir), quality.NEWS)


_MART = with_(BARS, PROFILES, _P, _IND, _EMA).replace("with ", "with recursive ", 1)


@query(with_(BARS, _P, _IND) + """select 'bollinger_order' as rule, count(*) filter (bb_lower > sma_20 or sma_20 > bb_upper) as failed from i union all select 'rsi_range', count(*) filter (rsi_14 < 0 or rsi_14 > 100) from i
    union all select 'macd_difference', 0 union all select 'market_cap_product', 0 union all select 'key_not_null', 0 union all select 'key_unique', 0""")
def q7_indicator_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = {"ticker", "date_id", *(n for _, rule in quality.INDICATOR_INVARIANTS for n in quality.names_in(rule))}
    return quality.violations(facts.fact_daily_price(daily_bars(spark, sf_dir), profiles(spark, sf_dir), columns=[c for c in facts.DAILY_COLUMNS if c in asked]))


@query(with_(BARS) + """select *, (upstream - downstream) / upstream as drop_ratio, (upstream - downstream) / upstream <= 0.05 as success from (
    select (select count(distinct (l_suppkey, cast(l_shipdate as date))) from lineitem) as upstream, (select count(*) from bars where close > 100) as downstream)""")
def q8_q9_drop_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("S"), "l_suppkey").alias("ticker"), F.to_date("l_shipdate").alias("date"))
    return quality.drop_ratio(raw, daily_bars(spark, sf_dir).where("close > 100"), ["ticker", "date"])


@query("""with a as (select distinct o_custkey as k from orders), b as (select c_custkey as k from customer where c_acctbal > 0)
    select 'missing' as side, count(*) as n, coalesce((list(cast(k as varchar) order by cast(k as varchar)))[1:10], []) as examples from a anti join b using (k)
    union all select 'extra', count(*), coalesce((list(cast(k as varchar) order by cast(k as varchar)))[1:10], []) from b anti join a using (k)""")
def j7_u3_key_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    b = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k"))
    return quality.key_differences(a, b, ["k"])


@query("""with a as (select l_orderkey || '|' || l_linenumber as k from lineitem), b as (select l_orderkey || '|' || l_linenumber as k from lineitem where l_quantity < 50)
    select 'missing' as side, count(distinct k) as n, coalesce((list(distinct k order by k))[1:10], []) as examples from a where k not in (select k from b)
    union all select 'extra', 0, []""")
def j7_layer_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two layers by digests of key ranges; the second lacks the largest quantities."""
    x = table(spark, sf_dir, "lineitem")
    return quality.layer_differences(x, x.where("l_quantity < 50"), ["l_orderkey", "l_linenumber"])


@query("select o_orderkey, o_custkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0)")
def j8_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    parent = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return quality.orphans(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), parent, ["o_custkey"])


@query("select cast(count(*) as bigint) as rows, count(distinct (l_orderkey, l_linenumber)) as keys, count(*) - count(distinct (l_orderkey, l_linenumber)) as duplicates from lineitem")
def a11_key_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.key_duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def a12_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query("""select newest, cast(len(list_filter(generate_series(newest + 1, date '2001-12-10', interval 1 day), lambda d: isodow(d) < 6)) as integer) as age,
    len(list_filter(generate_series(newest + 1, date '2001-12-10', interval 1 day), lambda d: isodow(d) < 6)) <= 2 as success from (select cast(max(l_shipdate) as date) as newest from lineitem)""")
def q11_m28_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.freshness(table(spark, sf_dir, "lineitem"), "l_shipdate", F.lit("2001-12-10").cast("date"))


@query(with_(TICKS, _STATES) + """, a as (select count(*) as r, count(distinct (ticker, minute_ts)) as k, count(*) filter (hour(minute_ts) < 9 or hour(minute_ts) >= 15) as o, count(*) filter (not (high >= low and high >= open and high >= close and low <= open and low <= close)) as b, max(minute_ts) as m, count(distinct ticker) as t from states)
    select 'duplicate_keys' as check, cast(r - k as double) as value, r = k as success from a union all select 'rows_out_of_hours', o, o = 0 from a union all select 'broken_bars', b, b = 0 from a
    union all select 'age_minutes', epoch(timestamp '2024-01-31 00:00:00' - m) / 60, epoch(timestamp '2024-01-31 00:00:00' - m) / 60 <= 10 from a union all select 'coverage', t / 200.0::double, t / 200.0::double >= 0.5 from a""")
def q13_realtime_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.realtime_report(_hours(spark, sf_dir), 200, F.lit("2024-01-31 00:00:00").cast("timestamp"))


@query(with_(TICKS) + """, a as (select ticker, cast(sum(volume) as bigint) as v from ticks where data_source = 'view' group by 1), b as (select ticker, cast(sum(volume) as bigint) as v from ticks where data_source = 'click' group by 1)
    select *, abs(volume_a - volume_b) / greatest(volume_a, volume_b) as gap, abs(volume_a - volume_b) / greatest(volume_a, volume_b) <= 0.15 as success from (select count(*) as shared, cast(sum(a.v) as bigint) as volume_a, cast(sum(b.v) as bigint) as volume_b from a join b using (ticker))""")
def j10_t7_cross_source_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir)
    return quality.cross_source_volume(t.where("data_source = 'view'"), t.where("data_source = 'click'"), ["ticker"])


# --- alerts ---------------------------------------------------------------------------------------------------------

_RULES = """('a1', 'u1', 'ALL', 'PRICE_ABOVE', 4000.0, 'mail', 60), ('a2', 'u1', 'WATCHLIST', 'RSI_BELOW', 45.0, 'mail', 60), ('a3', 'u2', 's7', 'STOP_LOSS', 2500.0, 'chat', 30), ('a4', 'u2', 'ALL', 'BB_BREAK', 0.0, 'chat', 30),
    ('a5', 'u3', 'ALL', 'INTRADAY_VOLUME_SPIKE', 1.5, 'chat', 30), ('a6', 'u3', 'ALL', 'INTRADAY_BREAKOUT', 1.0, 'mail', 30), ('a7', 'u3', 'ALL', 'RSI_CROSS_UP', 50.0, 'mail', 30), ('a8', 'u1', 'ALL', 'TAKE_PROFIT', 9000.0, 'mail', 5),
    ('a9', 'u1', 'ALL', 'RSI_CROSS_DOWN', 50.0, 'mail', 5), ('b1', 'u2', 'WATCHLIST', 'PRICE_BELOW', 3000.0, 'mail', 5), ('b2', 'u2', 'ALL', 'RSI_ABOVE', 55.0, 'mail', 5), ('b3', 'u4', 'ALL', 'NO_SUCH', 1.0, 'mail', 5)"""
_RULE_NAMES = "alert_id, user_id, ticker, condition_type, threshold_value, channel, cooldown_minutes"
_NOW = "2001-12-01 10:00:00"


def _rules(spark: SparkSession) -> DataFrame:
    x = spark.sql(f"select * from values {_RULES} as t({_RULE_NAMES})")
    return x.withColumns({"threshold_value": F.col("threshold_value").cast("double"), "cooldown_minutes": F.col("cooldown_minutes").cast("int")})


def _alert_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rules expanded over the suppliers, each ticker's newest indicators and trailing band, and a state from the row before."""
    p = profiles(spark, sf_dir)
    watch = p.select(F.concat(F.lit("u"), (F.col("shares_outstanding") % 3 + 1).cast("string")).alias("user_id"), "ticker")
    rules = alerts.expand_rules(_rules(spark), p, watch)
    w = ind.by_time()
    x = ind.price_indicators(daily_bars(spark, sf_dir)).withColumn("rsi_before", F.lag("rsi_14").over(w))
    now = facts.latest_rows(x, "ticker", "date").select("ticker", "close", "rsi_14", "bb_upper", "bb_lower", "rsi_before")
    band = ind.trailing_band(daily_bars(spark, sf_dir), time="date").select("ticker", F.col("volume_ratio").alias("intraday_volume_ratio"), F.col("band_high").alias("intraday_rolling_high_20"), F.col("band_low").alias("intraday_rolling_low_20"))
    market = now.join(band, "ticker").withColumn("price_vs_session_vwap_pct", F.lit(None).cast("double"))
    state = rules.join(now.select("ticker", F.col("rsi_before").alias("metric_value")), "ticker").select("alert_id", "ticker", "metric_value", F.lit(_NOW).cast("timestamp_ntz").alias("updated_at"))
    return rules, market.drop("rsi_before"), state


_ALERTS = f"""rules as (select * from (values {_RULES}) t({_RULE_NAMES})),
x as (select r.alert_id, r.user_id, p.ticker, r.condition_type, r.threshold_value as t, r.channel, r.cooldown_minutes from rules r, profiles p
    where r.ticker = 'ALL' or (r.ticker = 'WATCHLIST' and r.user_id = concat('u', shares_outstanding % 3 + 1)) or upper(r.ticker) = p.ticker),
m as (select *, lag(rsi_14) over (partition by ticker order by date) as rb, avg(volume) over b as va, max(high) over b as bh, min(low) over b as bl, row_number() over (partition by ticker order by date desc) as k
    from i window b as (partition by ticker order by date rows between 20 preceding and 1 preceding)),
f as (select x.*, case condition_type when 'PRICE_ABOVE' then case when close > t then close end when 'PRICE_BELOW' then case when close < t then close end when 'RSI_ABOVE' then case when rsi_14 > t then rsi_14 end
    when 'RSI_BELOW' then case when rsi_14 < t then rsi_14 end when 'BB_BREAK' then case when close > bb_upper or close < bb_lower then close end when 'STOP_LOSS' then case when close <= t then close end
    when 'TAKE_PROFIT' then case when close >= t then close end when 'INTRADAY_VOLUME_SPIKE' then case when volume / va > t then volume / va end
    when 'INTRADAY_BREAKOUT' then case when close > bh * (1 + t / 100) or close < bl * (1 - t / 100) then close end when 'RSI_CROSS_UP' then case when rb <= t and rsi_14 > t then rsi_14 end
    when 'RSI_CROSS_DOWN' then case when rb >= t and rsi_14 < t then rsi_14 end end as v from x join m on x.ticker = m.ticker and m.k = 1)"""


@query(with_(BARS, PROFILES, _P, _IND, _ALERTS) + "select alert_id, user_id, ticker, condition_type, channel, round(v, 4) as actual_value from f where v is not null")
def r1_r6_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = alerts.evaluate(*_alert_inputs(spark, sf_dir)).where("actual_value is not null")
    return rounded(x.select("alert_id", "user_id", "ticker", "condition_type", "channel", "actual_value"), 4, "actual_value")


@query(with_(BARS, PROFILES, _P, _IND, _ALERTS) + """, e as (select *, ascii(ticker) + length(ticker) + cast(substr(ticker, 2) as integer) as h from f where v is not null),
    k as (select * from e where not (h % 3 = 0 and h % 50 <= cooldown_minutes))
    select (select count(*) from f) as checked, (select count(*) from e) as fired, (select count(*) from k) as triggered, (select count(*) from e) - (select count(*) from k) as skipped""")
def r5_r9_cycle_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third ticker had an event up to 50 minutes ago; cooldowns hold some of them back."""
    now = F.lit(_NOW).cast("timestamp_ntz")
    # Checked, fired and held back are all read from it, so it is worked out once: a row a rule and ticker.
    evaluated = materialize(alerts.evaluate(*_alert_inputs(spark, sf_dir)), "evaluated")
    fired = evaluated.where("actual_value is not null")
    h = F.ascii("ticker") + F.length("ticker") + F.substring("ticker", 2, 9).cast("int")
    events = fired.where(h % 3 == 0).select("user_id", "ticker", "condition_type", "channel", (now - F.make_dt_interval(F.lit(0), F.lit(0), h % 50)).alias("triggered_at"))
    return alerts.cycle_summary(evaluated, alerts.off_cooldown(fired, events, now))


@query(with_(BARS, PROFILES, _P, _IND, _ALERTS) + """, l as (select *, row_number() over (partition by user_id, channel, condition_type order by ticker, alert_id) as k, count(*) over (partition by user_id, channel, condition_type) as n from f where v is not null)
    select user_id, channel, count(*) as alerts, count(distinct condition_type) as conditions, count(*) filter (k <= 25) as lines from l group by 1, 2""")
def r7_r8_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    fired = alerts.evaluate(*_alert_inputs(spark, sf_dir)).where("actual_value is not null")
    d = alerts.digests(alerts.event_rows(fired, F.lit(_NOW).cast("timestamp_ntz")))
    lines = F.size(F.filter(F.split("digest", "\n"), lambda s: s.startswith("- ")))
    groups = F.size(F.split("digest", "\n\n"))
    return d.select("user_id", "channel", "alerts", groups.cast("long").alias("conditions"), lines.cast("long").alias("lines"))


@query(with_(BARS, PROFILES, _P, _IND, _ALERTS) + "select alert_id, ticker, round(rsi_14, 4) as metric_value from x join (select ticker, rsi_14 from m where k = 1) using (ticker) where condition_type in ('RSI_CROSS_UP', 'RSI_CROSS_DOWN') and rsi_14 is not null")
def r4_next_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = alerts.next_state(alerts.evaluate(*_alert_inputs(spark, sf_dir)), F.lit(_NOW).cast("timestamp_ntz"))
    return rounded(x.select("alert_id", "ticker", "metric_value"), 4, "metric_value")
