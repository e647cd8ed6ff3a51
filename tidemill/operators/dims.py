"""Dimension tables (M1 to M4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import clean, dedup

#: Coarse sector names and what they become.
COARSE_SECTORS = {"CÔNG_TY_CHỨNG_KHOÁN": "CHUNG_KHOAN", "CÔNG_TY_BẢO_HIỂM": "BAO_HIEM", "CÔNG_TY_QUẢN_LÝ_QUỸ": "TAI_CHINH_KHAC", "CÔNG_TY_CỔ_PHẦN": "KHAC"}
#: The two indices and the exchanges that they follow.
INDICES = (("VNINDEX", "VN-Index", "HOSE"), ("VN30", "VN30 Index", "HOSE"))
_DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def dim_date(spark: SparkSession, start: str = "2020-01-01", end: str = "2030-12-31") -> DataFrame:
    """M1: one row a day."""
    d = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date"))
    return d.select(
        F.date_format("date", "yyyyMMdd").cast("int").alias("date_id"), "date", F.year("date").alias("year"), F.quarter("date").alias("quarter"), F.month("date").alias("month"),
        F.weekofyear("date").alias("week"), F.element_at(F.array(*map(F.lit, _DAYS)), F.weekday("date") + 1).alias("day_of_week"), (F.weekday("date") < 5).cast("int").alias("is_trading_day"),
    )


def date_id(date: Column | str) -> Column:
    return F.date_format(date, "yyyyMMdd").cast("int")


def dim_sector(profiles: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """M2: mapped sectors, then observed ones; the first of each id stays."""
    name = F.coalesce(F.nullif(F.trim("sector_name"), F.lit("")), F.lit("Unknown"))
    own = profiles.select(name.alias("sector_name")).distinct().select(clean.sector_slug("sector_name").alias("sector_id"), "sector_name", F.col("sector_name").alias("industry_group"), F.lit(1).alias("rank"))
    if mapping is not None:
        own = own.unionByName(mapping.select("sector_id", "sector_name", "industry_group", F.lit(0).alias("rank")).distinct())
    x = dedup.keep_first(own, ["sector_id"], ["rank", "sector_name", "industry_group"]).drop("rank")
    return x.withColumn("description", F.concat(F.lit("Nhóm ngành "), "sector_name"))


def dim_stock(profiles: DataFrame | None, tickers: DataFrame | None = None, mapping: DataFrame | None = None) -> DataFrame:
    """M3: from profiles, or from tickers alone; a mapped sector wins over the profile's remapped one."""
    if profiles is not None:
        x = profiles.withColumn("_own", clean.remap(clean.sector_slug("sector_name"), COARSE_SECTORS))
    else:
        x = tickers.select("ticker", F.lit(None).cast("string").alias("company_name"), F.lit(None).cast("string").alias("exchange"), F.lit(0).cast("long").alias("shares_outstanding"), F.lit("UNKNOWN").alias("_own"))
    x = x.withColumn("ticker", F.upper("ticker"))
    if mapping is not None:
        x = x.join(mapping.select(F.upper("ticker").alias("ticker"), F.col("sector_id").alias("_mapped")), "ticker", "left")
    else:
        x = x.withColumn("_mapped", F.lit(None).cast("string"))
    return x.select(
        "ticker", F.coalesce("company_name", "ticker").alias("company_name"), F.coalesce("exchange", F.lit("UNKNOWN")).alias("exchange"),
        F.coalesce("_mapped", "_own", F.lit("UNKNOWN")).alias("sector_id"), F.lit("ACTIVE").alias("status"), F.coalesce("shares_outstanding", F.lit(0)).cast("long").alias("shares_outstanding"),
    ).dropDuplicates(["ticker"])


def dim_index(spark: SparkSession, indices=INDICES) -> DataFrame:
    """M4: the static rows."""
    rows = F.array(*(F.struct(F.lit(i).alias("index_id"), F.lit(n).alias("index_name"), F.lit(e).alias("exchange")) for i, n, e in indices))
    return spark.range(1).select(F.inline(rows))


def read_sector_mapping(spark: SparkSession, path: str) -> DataFrame:
    """IO9: a CSV of ticker, sector_id, sector_name, industry_group; blanks go and the first row of a ticker stays."""
    x = spark.read.csv(path, header=True, schema="ticker string, sector_id string, sector_name string, industry_group string")
    x = x.select(F.upper(F.trim("ticker")).alias("ticker"), F.upper(F.trim("sector_id")).alias("sector_id"), F.trim("sector_name").alias("sector_name"), F.trim("industry_group").alias("industry_group"))
    x = x.where("ticker <> '' and sector_id <> ''").withColumn("_o", F.monotonically_increasing_id())
    return dedup.keep_first(x, ["ticker"], ["_o"]).drop("_o")
