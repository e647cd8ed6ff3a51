"""Registered queries: boards, lists and series over the marts, and branches that other queries don't reach (A, IO, J, K, M, N, Q, R)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import alerts, facts, labels, marts, quality
from tidemill.operators import indicators as ind
from tidemill.operators import news as nw
from tidemill.sources import tables
from tidemill.storage import materialize, new_folder
from tidemill.streaming import alerts as watch

from .adapters import BARS, INDEX_BARS, NEWS, PROFILES, TICKS, _nudge, daily_bars, index_bars, news, profiles, rounded, sessions, table, ticks, with_
from .continuous import _WATCHED, _recursive, _watch_rules
from .layers import _CHECKS, _DETAIL, _detail
from .prices import _EMA, _IND, _INDEX_P, _P
from .realtime import _ALERTS, _DEV, _NOW, _STATES, _VWAP, _alert_inputs, _vwap
from .registry import query

_DAILY = "daily as (select i.*, e12 as ema_12, e26 as ema_26, e12 - e26 as macd, sig as macd_signal from i join e using (ticker, date))"


def _recent_mart(spark: SparkSession, sf_dir: str, days: int = 35) -> DataFrame:
    """The newest days of the mart; its windows and means are over all of history."""
    since = sessions(spark, sf_dir).agg(F.date_sub(F.max("date"), days)).scalar()
    return facts.fact_daily_price(daily_bars(spark, sf_dir), profiles(spark, sf_dir), where=F.col("date") >= since)


# --- scans with MACD ------------------------------------------------------------------------------------------------

_FIRST = "when close > bb_upper then 'breakout' when close < bb_lower then 'breakdown'"
_SECOND = "when rsi_14 > 70 then 'overbought' when rsi_14 < 30 then 'oversold'"


@query(_recursive(BARS, _P, _IND, _EMA, _DAILY) + f"""select ticker, trading_date, signal from (select ticker, date as trading_date, case {_FIRST} {_SECOND} when volume > 1.5 * coalesce(volume_sma_20, volume) then 'volume_spike'
    when macd > 0 and macd > macd_signal then 'macd_positive' end as signal from daily where date >= (select max(date) - 35 from bars)) where signal is not null""")
def m22_macd_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.signal_scan(_recent_mart(spark, sf_dir)).select("ticker", "trading_date", "signal")


@query(_recursive(BARS, _P, _IND, _EMA, _DAILY) + f"""select ticker, trading_date, signal from (select ticker, date as trading_date, case {_SECOND} {_FIRST} when volume > 1.4 * coalesce(volume_sma_20, volume) then 'volume_spike'
    when macd > macd_signal then 'macd_positive' end as signal, m from (select *, abs(pct_change) as m from daily where date >= (select max(date) - 35 from bars) order by abs(pct_change) desc, ticker limit 80)) where signal is not null
    order by m desc, ticker limit 30""")
def m24_macd_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.snapshot_scan(_recent_mart(spark, sf_dir)).select("ticker", "trading_date", "signal")


# --- boards ---------------------------------------------------------------------------------------------------------

_VN = """vn as (select i.ticker as index_id, i.date as trading_date, close as close_point, price_change as point_change, pct_change, volume as total_volume, value as total_value, b.a, b.d, b.u from i left join (
    select exchange as index_id, date, count(*) filter (close > open) as a, count(*) filter (close < open) as d, count(*) filter (close = open) as u from bars join profiles using (ticker) where exchange in ('ASIA', 'EUROPE') group by 1, 2) b
    on b.index_id = i.ticker and b.date = i.date)"""


def _index_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index bars by region; breadth is known for two of them."""
    members = profiles(spark, sf_dir).where(F.col("exchange").isin("ASIA", "EUROPE")).select("ticker", F.col("exchange").alias("index_id"))
    return facts.index_fact(index_bars(spark, sf_dir), facts.index_breadth(daily_bars(spark, sf_dir), members))


@query(with_(BARS, PROFILES, INDEX_BARS, _INDEX_P, _IND, _VN) + """select index_id, trading_date, round(close_point, 4) as close_point, coalesce(a, 0) as advance_count, coalesce(d, 0) as decline_count, coalesce(u, 0) as unchanged_count,
    round(coalesce(case when d = 0 then a else a / d end, 0), 6) as advance_decline_ratio from vn""")
def m13_j3_index_breadth(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _index_fact(spark, sf_dir).select("index_id", "trading_date", "close_point", "advance_count", "decline_count", "unchanged_count", "advance_decline_ratio")
    return rounded(rounded(x, 4, "close_point"), 6, "advance_decline_ratio")


@query(with_(BARS, PROFILES, INDEX_BARS, _INDEX_P, _IND, _VN) + """, l as (select *, row_number() over (partition by index_id order by trading_date desc) as k from vn)
    select index_id, max(trading_date) as trading_date, round(max(close_point) filter (k = 1), 4) as close_point, round(max(point_change) filter (k = 1), 4) as point_change, round(max(pct_change) filter (k = 1), 4) as pct_change,
        max(coalesce(a, 0)) filter (k = 1) as advance_count, max(coalesce(d, 0)) filter (k = 1) as decline_count, count(*) as sessions, string_agg(concat(strftime(trading_date, '%m-%d'), ' ', cast(round(close_point, 0) as bigint)), ',' order by trading_date) as history
    from l where k <= 30 group by 1""")
def m20_index_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = marts.index_block(_index_fact(spark, sf_dir))
    line = F.array_join(F.transform("history", lambda h: F.concat(F.date_format(h.day, "MM-dd"), F.lit(" "), F.round(h.value + 1.37e-2, 0).cast("long"))), ",")
    x = x.select("index_id", "trading_date", "close_point", "point_change", "pct_change", "advance_count", "decline_count", F.size("history").cast("long").alias("sessions"), line.alias("history"))
    return rounded(x, 4, "close_point", "point_change", "pct_change")


@query(with_(TICKS, _STATES, _VWAP) + f""", s as (select *, {_DEV} as dev from vwap where trading_date = (select max(trading_date) from vwap))
    select ticker, round(last(close order by minute_ts, data_source), 4) as close, round(last(session_vwap order by minute_ts, data_source), 4) as session_vwap, round(last(dev order by minute_ts, data_source), 4) as deviation, max(minute_ts) as minute_ts,
    cast(sum(volume) as bigint) as volume, count(*) filter (abs(dev) >= 2) as far, count(*) filter (dev > 0) as above, count(*) filter (dev < 0) as below from s group by 1""")
def m21_newest_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = marts.vwap_board(_vwap(spark, sf_dir)).select("ticker", "close", "session_vwap", F.col("price_vs_session_vwap_pct").alias("deviation"), "minute_ts", "volume", "far", "above", "below")
    return rounded(x, 4, "close", "session_vwap", "deviation")


@query(with_(TICKS, _STATES, _VWAP) + f"""select ticker, data_source, minute_ts, round(close, 4) as price, round(vwap_1m, 4) as vwap_1m, round(session_vwap, 4) as session_vwap, volume, round({_DEV}, 4) as deviation
    from vwap where trading_date = (select max(trading_date) from vwap) and ticker in (select ticker from ticks group by 1 having count(*) >= 60)""")
def m21_vwap_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    busy = ticks(spark, sf_dir).groupBy("ticker").agg(F.count("*").alias("n")).where("n >= 60")
    return rounded(marts.vwap_series(_vwap(spark, sf_dir), busy), 4, "price", "vwap_1m", "session_vwap", "deviation")


_STAMPED = """stamped as (select detail.*, timestamp '2024-02-02' + interval 1 minute * length(title) as inferred_at from detail)"""


def _stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _detail(spark, sf_dir).withColumn("inferred_at", F.lit("2024-02-02").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.length("title")))


_NAMES25 = "stocks as (select concat('T', n_nationkey) as ticker, case when n_nationkey % 3 = 0 then '' else n_name end as company_name from nation)"


@query(with_(NEWS, _DETAIL, _STAMPED, _NAMES25) + """select article_id, s.ticker, coalesce(nullif(company_name, ''), s.ticker) as name, title, published_at, sentiment_label, inferred_at from (
    select * from stamped where published_at >= date '2024-01-20' - 7 order by inferred_at desc, article_id, ticker limit 120) s left join stocks using (ticker)""")
def m25_article_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest articles whatever their ticker: the list's own limit."""
    x = marts.article_list(_stamped(spark, sf_dir), _stocks(spark, sf_dir), F.lit("2024-01-20").cast("date"))
    return x.select("article_id", "ticker", "name", "title", "published_at", "sentiment_label", "inferred_at")


def _stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.concat(F.lit("T"), "n_nationkey").alias("ticker"), F.when(F.col("n_nationkey") % 3 == 0, "").otherwise(F.col("n_name")).alias("company_name"))


@query(with_(NEWS, _DETAIL, _STAMPED, _NAMES25) + """select article_id, s.ticker, coalesce(nullif(company_name, ''), s.ticker) as name, title, inferred_at from (
    select * from stamped where published_at >= date '2024-01-20' - 30 and ticker in (select ticker from stocks) qualify row_number() over (partition by ticker order by inferred_at desc, article_id) <= 5) s left join stocks using (ticker)""")
def m25_articles_by_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    stocks = _stocks(spark, sf_dir)
    x = marts.article_list(_stamped(spark, sf_dir), stocks, F.lit("2024-01-20").cast("date"), 30, 5, tickers=stocks)
    return x.select("article_id", "ticker", "name", "title", "inferred_at")


@query(with_(BARS, PROFILES, INDEX_BARS, NEWS, _DETAIL) + """, a as (select ticker, published_at as day, avg(sentiment_score) as s from (select distinct on (article_id, ticker) * from detail) where published_at is not null group by 1, 2)
    select 'index' as part, upper(index_code) as name, date as day, round(avg(close), 4) as value from index_bars group by 2, 3 union all select 'sentiment', 'all', day, round(avg(s), 4) from a group by 3
    union all (select 'traded', ticker, null, round(v, 4) from (select ticker, max(close * volume) as v from bars group by 1 order by 2 desc, 1 limit 10))""")
def a19_daily_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = facts.index_fact(index_bars(spark, sf_dir))
    top = daily_bars(spark, sf_dir).withColumn("value", F.col("close") * F.col("volume"))
    return rounded(marts.daily_means(index, nw.sentiment_daily(_detail(spark, sf_dir)), top), 4, "value")


@query(with_(BARS, _P, _IND, NEWS, _DETAIL) + """, s as (select ticker, volume / volume_sma_20 as r from i where date = (select max(date) from bars) and volume_sma_20 > 0), n as (select ticker, count(distinct article_id) as n from detail group by 1)
    (select 'volume_ratio' as board, ticker, round(r, 4) as value from s where r is not null order by r desc, ticker limit 8) union all (select 'news', ticker, cast(n as double) from n order by n desc, ticker limit 8)""")
def k7_volume_and_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = marts.newest_session(ind.price_indicators(daily_bars(spark, sf_dir)), "date").select("ticker", F.try_divide(F.col("volume").cast("double"), F.col("volume_sma_20")).alias("value")).where("value is not null")
    count = _detail(spark, sf_dir).groupBy("ticker").agg(F.count_distinct("article_id").cast("double").alias("value"))
    board = lambda df, name: marts.topped(df, 8, F.desc("value"), "ticker").select(F.lit(name).alias("board"), "ticker", "value")
    return rounded(board(day, "volume_ratio"), 4, "value").unionByName(board(count, "news"))


@query(with_(TICKS, _STATES, _VWAP) + f"""select ticker, minute_ts, round(dev, 4) as deviation from (select *, {_DEV} as dev from vwap where trading_date = (select max(trading_date) from vwap)) order by abs(dev) desc, ticker, minute_ts, data_source limit 8""")
def k3_largest_deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = marts.newest_session(_vwap(spark, sf_dir)).withColumn("deviation", F.col("price_vs_session_vwap_pct"))
    x = marts.topped(x, 8, F.abs("deviation").desc(), "ticker", "minute_ts", "data_source")
    return rounded(x.select("ticker", "minute_ts", "deviation"), 4, "deviation")


# --- alerts ---------------------------------------------------------------------------------------------------------


@query(_WATCHED)
def r2_r5_past_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ticks at once: VWAP deviations and crossings, prices and cooldowns, by windows."""
    t = ticks(spark, sf_dir).select("ticker", "trade_ts", "seq", "price", "volume")
    x = watch.past_events(t, _watch_rules(spark, t.select("ticker").distinct()), float(_nudge(6)))
    return rounded(x.select("alert_id", "user_id", "ticker", "condition_type", "channel", "triggered_at", "seq", "threshold_value", "actual_value"), 4, "actual_value")


@query(with_(BARS, PROFILES, _P, _IND, _ALERTS) + r""", l as (select user_id, channel, condition_type, ticker, sha1(concat(alert_id, '|', ticker, '|2001-12-01 10:00:00')) as id, v from f where v is not null),
    k as (select *, row_number() over (partition by user_id, channel, condition_type order by ticker, id) as k from l),
    g as (select user_id, channel, condition_type, concat(condition_type, ' (', count(*), ')', chr(10), string_agg(concat('- ', ticker), chr(10) order by k) filter (k <= 25), case when count(*) > 25 then concat(chr(10), '… ', count(*) - 25, ' more') else '' end) as t from k group by 1, 2, 3)
    select user_id, channel, string_agg(t, chr(10) || chr(10) order by condition_type) as digest from g group by 1, 2""")
def r8_digest_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole digests, but for the numbers in their lines, whose last digit may hang on an engine's rounding."""
    fired = alerts.evaluate(*_alert_inputs(spark, sf_dir)).where("actual_value is not null")
    d = alerts.digests(alerts.event_rows(fired, F.lit(_NOW).cast("timestamp_ntz")))
    return d.select("user_id", "channel", F.regexp_replace("digest", r"(?m)^(- [^:\n]*): [-0-9.]+$", "$1").alias("digest"))


# --- tables ---------------------------------------------------------------------------------------------------------


@query("select s_suppkey as id, s_name as name from supplier union all select c_custkey, c_name from customer")
def io13_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made from one frame takes another, and an empty one changes nothing."""
    name, path = f"appended_{uuid.uuid4().hex}", new_folder(spark, "appended")
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    s.write.option("path", path).saveAsTable(name)
    tables.append(c, name)
    tables.append(c.limit(0), name)
    x = spark.read.schema(s.schema).parquet(path)
    spark.sql(f"drop table {name}")
    return x


@query("""select split, cast(doc_id as bigint) as doc_id, f as format from (select case when quality = 1 then 'train' else 'test' end as split, doc_id from labels), (values ('parquet'), ('json'), ('csv')) t(f)""")
def io16_three_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "datasets")
    tables.write_datasets(table(spark, sf_dir, "labels").withColumn("split", F.when(F.col("quality") == 1, "train").otherwise("test")), path)
    read = {"parquet": spark.read.parquet(f"{path}/parquet"), "json": spark.read.json(f"{path}/json"), "csv": spark.read.csv(f"{path}/csv", header=True)}
    one = lambda f: read[f].select("split", F.col("doc_id").cast("long").alias("doc_id"), F.lit(f).alias("format"))
    return one("parquet").unionByName(one("json")).unionByName(one("csv"))


@query("select 'region' as mart, cast(r_regionkey as bigint) as id, r_name as name from region union all select 'nation', n_nationkey, n_name from nation")
def io23_both_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "bundle")
    tables.write_bundle({"region": table(spark, sf_dir, "region"), "nation": table(spark, sf_dir, "nation")}, path)
    one = lambda m, p: spark.read.json(f"{path}/{m}", schema=f"{p}_{m}key bigint, {p}_name string").select(F.lit(m).alias("mart"), F.col(f"{p}_{m}key").alias("id"), F.col(f"{p}_name").alias("name"))
    return one("region", "r").unionByName(one("nation", "n"))


@query("select lower(trim(p_name)) as term, round(avg(p_size / 100.0::double - (p_partkey % 7) / 10.0::double), 6) as polarity from part where p_partkey % 5 <> 0 group by 1")
def n23_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lexicon of tab-separated lines; a fifth are comments or short."""
    path, p = new_folder(spark, "lexicon"), F.col("p_partkey")
    line = F.concat_ws("\t", F.lit("n"), p.cast("string"), (F.col("p_size") / 100).cast("string"), (p % 7 / 10).cast("string"), F.concat(F.lit(" "), F.upper("p_name")), F.lit("gloss"))
    bad = F.when(p % 10 == 0, F.concat(F.lit("# "), line)).otherwise(F.concat_ws("\t", F.lit("n"), "p_name"))
    table(spark, sf_dir, "part").select(F.when(p % 5 != 0, line).otherwise(bad).alias("value")).write.text(path)
    return rounded(labels.read_lexicon(spark, path), 6, "polarity")


@query(with_(BARS, PROFILES, INDEX_BARS, NEWS) + _CHECKS.replace("gb as (select * from cb where high > low)", "gb as (select * from cb union all select * from cb where volume >= 90)").replace("gi as (select * from index_bars where high > low)", "gi as (select * from index_bars union all select * from index_bars where volume >= 900)") + f""", v as (
    select 'bars_same_count' as "check", (select count(*) from cb) - (select count(*) from gb) as value, false as success union all select 'bars_same_keys', 0, true
    union all select 'bars_keys_once', (select count(*) from gb) - (select count(distinct (ticker, date)) from gb), (select count(*) = count(distinct (ticker, date)) from gb)
    union all select 'index_keys_once', (select count(*) from gi) - (select count(distinct (index_code, date)) from gi), (select count(*) = count(distinct (index_code, date)) from gi))
    select "check", cast(value as double) as value, case when "check" = 'bars_same_count' then value = 0 else success end as success from v""")
def q12_repeated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published layers that hold some rows twice."""
    bars, n = materialize(daily_bars(spark, sf_dir), "bars"), news(spark, sf_dir)
    index = materialize(index_bars(spark, sf_dir, bars), "index-bars")
    kept = bars.where("volume >= 10")
    gold = n.where("category = 'en'").withColumn("ticker", F.col("source"))
    twice = (kept.unionByName(kept.where("volume >= 90")), index.unionByName(index.where("volume >= 900")))
    x = quality.reconciliation((bars, kept, twice[0]), (index, index, twice[1]), (n, n.where(F.length("content") >= 50), gold), F.lit("2001-12-05").cast("date"))
    return x.where(F.col("check").isin("bars_same_count", "bars_same_keys", "bars_keys_once", "index_keys_once"))
