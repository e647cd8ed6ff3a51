"""Reading and writing lakehouse tables (IO1 to IO24)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators import clean
from tidemill.schemas import conform, may_overwrite


def _layout(path: str) -> str | None:
    """The columns and types in the footer of a Parquet file, or of the first one in a folder; null if only Spark can read there."""
    import pyarrow.fs as pf
    import pyarrow.parquet as pq

    try:
        fs, where = pf.FileSystem.from_uri(path)
    except (ValueError, OSError, NotImplementedError):
        return None
    info = fs.get_file_info(where)
    if info.type == pf.FileType.NotFound:
        return None
    if info.type == pf.FileType.Directory:
        hidden = lambda f: any(part[0] in "._" for part in f.path[len(where) :].split("/") if part)
        files = sorted(f.path for f in fs.get_file_info(pf.FileSelector(where, recursive=True)) if f.is_file and not hidden(f))
        if not files:
            return None
        where = files[0]
    return str(pq.read_schema(where, filesystem=fs).remove_metadata())


def path_layouts(spark: SparkSession, paths: Sequence[str], rows_each: int = 64) -> list[list[str]]:
    """IO1: the paths by their columns and types, in order of their first path.

    Footers are read by tasks, rows_each of them a task, and grouped there; a path in a store that tasks can't open
    by themselves is a layout of its own, found when it is read.
    """

    def read(batches):
        for pdf in batches:
            yield pdf.assign(layout=[_layout(p) for p in pdf["path"]])

    x = spark.createDataFrame(list(enumerate(paths)), "at bigint, path string").repartition(-(-len(paths) // rows_each) or 1)
    x = x.mapInPandas(read, "at bigint, path string, layout string")
    x = x.groupBy(F.coalesce("layout", F.concat(F.lit("?"), "at"))).agg(F.array_sort(F.collect_list(F.struct("at", "path"))).alias("p"))
    return [[p.path for p in r.p] for r in sorted(x.select("p").collect(), key=lambda r: r.p[0]["at"])]


def read_drifting(spark: SparkSession, paths: Sequence[str], schema: str | T.StructType, aliases: dict[str, str] | None = None) -> DataFrame:
    """IO1, IO2, U1: sources whose columns drift, cleaned and cast to the contract, then united by name.

    Paths of equal columns are one scan, so plan and driver work grow with the number of layouts and not of days.
    """
    out = None
    for same in path_layouts(spark, paths) if paths else []:
        x = conform(clean.apply_aliases(clean.normalize_names(spark.read.parquet(*same)), aliases or {}), schema)
        out = x if out is None else out.unionByName(x, allowMissingColumns=True)
    if out is None:
        raise ValueError("no paths given")
    return out


def read_keyed(spark: SparkSession, root: str, schema: str | T.StructType | None = None) -> DataFrame:
    """IO3: a tree of key=value folders; keys become columns."""
    reader = spark.read.option("basePath", root)
    return (reader.schema(schema) if schema is not None else reader).parquet(root)


def in_range(df: DataFrame, start: str | None = None, end: str | None = None, tickers: DataFrame | None = None, date: str = "date") -> DataFrame:
    """IO4: a date range, pushed to the scan, and a set of tickers as a semi join."""
    if start is not None:
        df = df.where(F.col(date) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(date) <= F.lit(end).cast("date"))
    return df if tickers is None else df.join(tickers.select("ticker").distinct(), "ticker", "left_semi")


def with_partitions(df: DataFrame, date: str, day: bool = False) -> DataFrame:
    """IO5: year and month (and day) of the row's own date, not of the run."""
    x = df.withColumns({"year": F.year(date), "month": F.month(date)})
    return x.withColumn("day", F.dayofmonth(date)) if day else x


def write_monthly(df: DataFrame, path: str, date: str, sort: Sequence[str] = ("ticker",), day: bool = False) -> None:
    """IO5, IO8: partitioned files, sorted for scans that skip.

    Rows are dealt by month (or day) so that files stay few; a month beyond the session's advisory partition size is
    split over several tasks, each with its own file, and small ones share a task.
    """
    parts = ["year", "month", *(["day"] if day else [])]
    x = with_partitions(df, date, day).hint("rebalance", *parts).sortWithinPartitions(*parts, *sort)
    x.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def write_snapshot(df: DataFrame, path: str, snapshot: str) -> None:
    """IO7: a dated copy; writing a date again replaces it."""
    x = df.withColumn("snapshot_date", F.lit(snapshot).cast("date"))
    x.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(path)


def merged(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """IO6: old and new rows, the new one where a key is in both; a key twice in the new rows keeps its larger row."""
    rest = [c for c in old.columns if c not in keys]
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("_new", *(F.col(c).cast("string") for c in rest))).alias("_r")).select(*keys, "_r.*")


def touched_months(df: DataFrame, date: str = "trading_date", lookback: int = 35) -> DataFrame:
    """IO21: all rows of the months that begin to change within `lookback` days of the newest row."""
    top = df.agg(F.trunc(F.date_sub(F.max(date), lookback), "month").alias("_from"))
    return df.join(F.broadcast(top), F.col(date) >= F.col("_from")).drop("_from")


def append(df: DataFrame, table: str) -> None:
    """IO13: by name into an existing table; no rows, no files."""
    df.write.insertInto(table, overwrite=False)


def overwrite(df: DataFrame, path: str, table: str) -> None:
    """IO24: replaces a table that no stream owns."""
    may_overwrite(table)
    df.write.mode("overwrite").parquet(path)


def retained(df: DataFrame, time: str, days: int) -> DataFrame:
    """IO18: rows within `days` of the newest."""
    top = df.agg((F.max(time) - F.make_dt_interval(F.lit(days))).alias("_from"))
    return df.join(F.broadcast(top), F.col(time) >= F.col("_from")).drop("_from")


def rescope(df: DataFrame, universe: DataFrame, name: str, key: str = "ticker") -> tuple[DataFrame, DataFrame]:
    """IO19: rows of the allowed universe, and a manifest of rows before and after."""
    kept = df.join(universe.select(key).distinct(), key, "left_semi")
    manifest = df.agg(F.count("*").alias("rows_before")).crossJoin(F.broadcast(kept.agg(F.count("*").alias("rows_after"))))
    return kept, manifest.select(F.lit(name).alias("table_name"), "rows_before", "rows_after", (F.col("rows_before") - F.col("rows_after")).alias("removed"))


def read_tickers(spark: SparkSession, path: str) -> DataFrame:
    """IO10: a CSV's symbol or ticker column, whatever its case, upper-cased, each once, sorted."""
    x = clean.normalize_names(spark.read.csv(path, header=True))
    name = next((c for c in ("symbol", "ticker") if c in x.columns), None)
    if name is None:
        raise ValueError(f"{path} has neither a symbol nor a ticker column")
    return x.select(F.upper(F.trim(name)).alias("ticker")).where("ticker <> ''").distinct().orderBy("ticker")


def capped_news(raw: DataFrame, target: int, publishers: int = 3, least: int = 200, order: str = "article_id") -> DataFrame:
    """IO11: articles longer than `least` characters, at most target // publishers of each source."""
    from pyspark.sql import Window

    x = raw.withColumnRenamed("content", "raw_content").where(F.length("raw_content") > least)
    w = Window.partitionBy("source").orderBy(order)
    return x.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= target // publishers).drop("_n")


def demo_ticks(spark: SparkSession, tickers: DataFrame, start: Column, minutes: int = 60, trades: int = 3) -> DataFrame:
    """IO17: the same ticks each time: every ticker, minute and trade, prices and volumes by arithmetic."""
    m = spark.range(minutes * trades).select((F.col("id") / trades).cast("int").alias("m"), (F.col("id") % trades).cast("int").alias("k"))
    x = tickers.select("ticker", (F.crc32(F.col("ticker").cast("binary")) % 1000).alias("h")).crossJoin(F.broadcast(m))
    at = start + F.make_dt_interval(F.lit(0), F.lit(0), F.col("m"), F.col("k") * 60 / trades)
    return x.select("ticker", at.alias("trade_ts"), (10 + F.col("h") / 10 + (F.col("m") % 7) * 0.1 + F.col("k") * 0.05).alias("price"), (100 * (1 + (F.col("m") + F.col("k")) % 5)).cast("long").alias("volume"), F.lit("demo").alias("data_source"))


def write_report(report: DataFrame, path: str) -> None:
    """IO14: quality reports as JSON, appended."""
    report.write.mode("append").json(path)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """IO15: reports that count errors."""
    return spark.read.json(path, schema="generated_at timestamp, source_name string, record_count bigint, error_count bigint, success boolean, expectations array<struct<rule:string,failed:bigint,success:boolean>>").where("error_count > 0")


def write_datasets(df: DataFrame, path: str, split: str = "split") -> None:
    """IO16: the labelled set as Parquet, CSV and JSON, a folder a split."""
    df.write.mode("overwrite").partitionBy(split).parquet(f"{path}/parquet")
    df.write.mode("overwrite").partitionBy(split).json(f"{path}/json")
    flat = df.select(*(F.to_json(c).alias(c) if isinstance(df.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(c) for c in df.columns))
    flat.write.mode("overwrite").option("header", True).csv(f"{path}/csv")


def write_bundle(marts: dict[str, DataFrame], path: str) -> None:
    """IO23: every mart as JSON lines in a folder of its own."""
    for name, df in marts.items():
        df.write.mode("overwrite").json(f"{path}/{name}")
