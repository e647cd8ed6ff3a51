"""Keys, versions and priorities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in a total order. With few columns beside the order, max_by is cheaper."""
    return _pick(df, keys, [F.col(c).desc_nulls_last() for c in order])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in a total order."""
    return _pick(df, keys, [F.col(c).asc_nulls_last() for c in order])


def latest(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The newest version's columns, combined map-side before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*version))
    return df.groupBy(*keys).agg(newest.alias("_r")).select(*keys, "_r.*")


def first_known(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """D3: for each column the first value that isn't null."""
    rest = [c for c in df.columns if c not in (*keys, order)]
    return df.groupBy(*keys).agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in rest))


def prefer_source(df: DataFrame, keys: Sequence[str], primary: str, version: str, source: str = "data_source") -> DataFrame:
    """The primary source's newest row, else another source's newest; ties go to the larger source name."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct((F.col(source) == primary).alias("p"), F.col(version).alias("v"), F.col(source).alias("s"))
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_r")).select(*keys, "_r.*")


def active_version(df: DataFrame, configured: str | None = None, version: str = "model_version", at: str = "inferred_at") -> DataFrame:
    """Rows of the configured model version, else of the one inferred last, as one broadcast row."""
    if configured is not None:
        return df.where(F.col(version) == configured)
    top = df.agg(F.max_by(version, F.struct(at, version)).alias(version))
    return df.join(F.broadcast(top), version, "left_semi")


def title_links(links: DataFrame, news: DataFrame) -> DataFrame:
    """(ticker, title) to the newest article's url."""
    x = links.join(news.select("article_id", "url", "title", "published_at"), "article_id")
    return x.groupBy("ticker", "title").agg(F.max_by("url", F.struct("published_at", "url")).alias("url"))


def known_urls(pages: DataFrame, url: Column, order: str) -> DataFrame:
    """Each normalised url once, from its first page."""
    x = pages.withColumn("url_key", url)
    return keep_first(x, ["url_key"], [order])
