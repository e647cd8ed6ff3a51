"""The market domain's tables, built from the given ones, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier = ticker, ship date = session, unit price = trade price.

    Rows go by ticker, not by ticker and date: what follows by ticker then needs no further shuffle or sort, and there
    is about one row a bar, so tasks have nothing to add up before a shuffle.
    """
    x = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), "l_suppkey").alias("ticker"), F.to_date("l_shipdate").alias("date"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("p"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("o"), "l_quantity",
    )
    return x.repartition("ticker").groupBy("ticker", "date").agg(
        F.min_by("p", "o").alias("open"), F.max("p").alias("high"), F.min("p").alias("low"), F.max_by("p", "o").alias("close"), F.sum("l_quantity").cast("long").alias("volume")
    )


BARS = """bars as (
    select concat('S', l_suppkey) as ticker, cast(l_shipdate as date) as date,
        first(l_extendedprice / l_quantity order by l_orderkey, l_linenumber, l_partkey, l_extendedprice) as open,
        max(l_extendedprice / l_quantity) as high, min(l_extendedprice / l_quantity) as low,
        last(l_extendedprice / l_quantity order by l_orderkey, l_linenumber, l_partkey, l_extendedprice) as close,
        cast(sum(l_quantity) as bigint) as volume
    from lineitem group by 1, 2)"""


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    x = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return x.select(
        F.concat(F.lit("S"), "s_suppkey").alias("ticker"), F.col("s_name").alias("company_name"), F.col("n_name").alias("sector_name"),
        F.col("r_name").alias("exchange"), F.abs(F.col("s_acctbal") * 1000).cast("long").alias("shares_outstanding"),
    )


PROFILES = """profiles as (
    select concat('S', s_suppkey) as ticker, s_name as company_name, n_name as sector_name, r_name as exchange,
        cast(trunc(abs(s_acctbal * 1000)) as bigint) as shares_outstanding
    from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dates of all bars, one or more rows a bar: their newest is known without the bars."""
    return table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"))


def index_bars(spark: SparkSession, sf_dir: str, bars: DataFrame | None = None) -> DataFrame:
    """One index a region: mean open and close, extremes, summed volume and value of its tickers."""
    x = (daily_bars(spark, sf_dir) if bars is None else bars).join(profiles(spark, sf_dir).select("ticker", F.col("exchange").alias("index_code")), "ticker")
    return x.groupBy("index_code", "date").agg(
        F.avg("open").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.avg("close").alias("close"), F.sum("volume").alias("volume"),
        F.sum(F.col("close") * F.col("volume")).alias("trading_value"),
    )


INDEX_BARS = """index_bars as (
    select exchange as index_code, date, avg(open) as open, max(high) as high, min(low) as low, avg(close) as close,
        cast(sum(volume) as bigint) as volume, sum(close * volume) as trading_value
    from bars join profiles using (ticker) group by 1, 2)"""


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), "user_id").alias("ticker"), F.col("ts").alias("trade_ts"), F.col("value").alias("price"),
        (F.get_json_object("props", "$.k").cast("long") + 1).alias("volume"), F.col("event_type").alias("data_source"), F.col("event_id").alias("seq"),
    )


TICKS = """ticks as (
    select concat('U', user_id) as ticker, ts as trade_ts, value as price, 1 + cast(json_extract_string(props, '$.k') as bigint) as volume,
        event_type as data_source, event_id as seq from events)"""


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.sha1(F.col("doc_id").cast("string")).alias("article_id"), F.concat(F.lit("https://news.example/"), "doc_id").alias("url"),
        F.substring(F.element_at(F.split("text", "\n", 2), 1), 1, 120).alias("title"), F.col("text").alias("content"), "source", F.col("lang").alias("category"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("published_at"), "doc_id",
    )


NEWS = """news as (
    select sha1(cast(doc_id as varchar)) as article_id, concat('https://news.example/', doc_id) as url,
        substr(split_part(text, chr(10), 1), 1, 120) as title, text as content, source, lang as category,
        cast(date '2024-01-01' + cast(doc_id % 30 as integer) as date) as published_at, doc_id from documents)"""


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def _nudge(digits: int) -> str:
    """Added before results are rounded for comparison, so that decimal ties don't hang on an engine's last bit."""
    return f"1.37e-{digits + 2}"


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + float(_nudge(digits)), digits) for c in columns})


def sql_rounds(digits: int, *columns: str) -> str:
    """Rounded columns in SQL; registry adds what rounded() adds."""
    return ", ".join(f"round({c}, {digits}) as {c}" for c in columns)
