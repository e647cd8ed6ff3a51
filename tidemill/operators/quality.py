"""Expectations, gates and reconciliation (Q1 to Q16). Every rule of a suite is counted in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.schemas import ContractError


@dataclass(frozen=True)
class Suite:
    """Required columns, named row rules as SQL (unknown fails), and the key that has to be unique."""

    name: str
    required: tuple[str, ...]
    rules: tuple[tuple[str, str], ...]
    key: tuple[str, ...]


def _text(c: str) -> tuple[str, str]:
    return f"{c}_not_empty", f"length(trim({c})) > 0"


OHLCV = Suite("ohlcv", ("ticker", "date", "open", "high", "low", "close", "volume"), (
    _text("ticker"), ("date_not_null", "date is not null"), ("close_not_null", "close is not null"), ("volume_not_null", "volume is not null"), ("open_positive", "open > 0"), ("high_positive", "high > 0"),
    ("low_positive", "low > 0"), ("close_positive", "close > 0"), ("volume_not_negative", "volume >= 0"), ("high_at_least_low", "high >= low"), ("high_at_least_open", "high >= open"),
    ("high_at_least_close", "high >= close"), ("low_at_most_open", "low <= open"), ("low_at_most_close", "low <= close")), ("ticker", "date"))
PROFILE = Suite("profile", ("ticker", "company_name", "exchange"), (
    _text("ticker"), _text("company_name"), _text("exchange"), ("exchange_known", "exchange in ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST', 'HOSE', 'HNX', 'UPCOM')"), ("shares_not_negative", "shares_outstanding >= 0")), ("ticker",))
INDEX = Suite("index", ("index_code", "date", "open", "high", "low", "close", "volume"), (
    _text("index_code"), ("date_not_null", "date is not null"), ("open_not_null", "open is not null"), ("high_not_null", "high is not null"), ("low_not_null", "low is not null"), ("close_not_null", "close is not null"),
    ("volume_not_negative", "volume >= 0"), ("close_positive", "close > 0"), ("high_at_least_low", "high >= low"), ("high_at_least_open", "high >= open"), ("high_at_least_close", "high >= close"),
    ("low_at_most_open", "low <= open"), ("low_at_most_close", "low <= close")), ("index_code", "date"))
NEWS = Suite("news", ("url", "title", "content"), (
    _text("url"), _text("title"), _text("source"), ("content_long_enough", "length(content) >= 50"), ("published_known", "published_at is not null")), ("url",))
SENTIMENT = Suite("sentiment", ("article_id", "ticker", "sentiment_label", "sentiment_score", "confidence_score", "model_version"), (
    ("label_known", "sentiment_label in ('positive', 'negative', 'neutral')"), ("score_in_range", "sentiment_score between -1 and 1"), ("confidence_in_range", "confidence_score between 0 and 1"), _text("ticker")),
    ("article_id", "ticker", "model_version"))
#: Q7: invariants of the indicator mart; a null is no violation.
INDICATOR_INVARIANTS = (
    ("bollinger_order", "bb_lower > bb_middle or bb_middle > bb_upper"), ("rsi_range", "rsi_14 < 0 or rsi_14 > 100"), ("macd_difference", "abs(macd - (ema_12 - ema_26)) > 1e-4"),
    ("market_cap_product", "abs(market_cap - close * shares_outstanding) > 1e-4"), ("key_not_null", "ticker is null or date_id is null"))


def surplus(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row with how many rows are beyond the first of their key."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("failed"))


def expectations(df: DataFrame, suite: Suite) -> DataFrame:
    """Q1 to Q6: (suite, rule, failed, success). A lacking column is the only result then."""
    lacking = sorted(set(suite.required) - set(df.columns))
    if lacking:
        rows = F.array(*(F.struct(F.lit(f"has_{c}").alias("rule"), F.lit(1).cast("long").alias("failed")) for c in lacking))
        x = df.sparkSession.range(1).select(F.inline(rows))
    else:
        rules = [(n, r) for n, r in suite.rules if not set(names_in(r)) - set(df.columns)]
        counts = df.agg(*(F.count_if(~F.coalesce(F.expr(r), F.lit(False))).alias(n) for n, r in rules))
        x = counts.unpivot([], [n for n, _ in rules], "rule", "failed")
        x = x.unionByName(surplus(df, suite.key).select(F.lit("key_unique").alias("rule"), "failed"))
    return x.select(F.lit(suite.name).alias("suite"), "rule", "failed", (F.col("failed") == 0).alias("success"))


def names_in(rule: str) -> list[str]:
    """The words of a rule that may be columns."""
    import re

    known = {"length", "trim", "is", "not", "null", "in", "between", "and", "or", "abs"}
    return [w for w in re.findall(r"[a-z_][a-z_0-9]*", re.sub(r"'[^']*'", "", rule)) if w not in known]


def violations(mart: DataFrame, rules=INDICATOR_INVARIANTS, key: Sequence[str] = ("ticker", "date_id")) -> DataFrame:
    """Q7: (rule, failed) of rows that break an invariant, and surplus keys. The mart, which is costly, is worked out once."""
    names = [*(n for n, _ in rules), "key_unique"]
    by_key = mart.groupBy(*key).agg(*(F.count_if(F.expr(r)).alias(n) for n, r in rules), (F.count("*") - 1).alias("key_unique"))
    return by_key.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names)).unpivot([], names, "rule", "failed")


def report(results: DataFrame, source: str, as_of: Column, records: DataFrame) -> DataFrame:
    """One report row: counts and the results as an array; the clock is a parameter (IO14 writes it as JSON)."""
    x = results.agg(F.sum("failed").alias("error_count"), F.every("success").alias("success"), F.array_sort(F.collect_list(F.struct("rule", "failed", "success"))).alias("expectations"))
    return x.crossJoin(F.broadcast(records.agg(F.count("*").alias("record_count")))).select(as_of.alias("generated_at"), F.lit(source).alias("source_name"), "record_count", "error_count", "success", "expectations")


def failed_reports(reports: DataFrame) -> DataFrame:
    """IO15: reports with errors."""
    return reports.where("error_count > 0")


def gate(results: DataFrame, what: str) -> None:
    """Q14, Q15: raises with the failed rules; a suite's results are a few rows."""
    bad = results.where("not success").select("suite", "rule", "failed").limit(100).collect()
    if bad:
        raise ContractError(f"{what}: " + ", ".join(f"{r.suite}.{r['rule']} ({r.failed})" for r in bad))


def run_suites(frames: dict[str, tuple[DataFrame, Suite]], stop_at_first: bool = True) -> list[DataFrame]:
    """Q15: the results of each suite in order; with stop_at_first, the gate of each comes before the next."""
    out = []
    for name, (df, suite) in frames.items():
        results = expectations(df, suite)
        if stop_at_first:
            gate(results, name)
        out.append(results)
    return out


def drop_ratio(up: DataFrame, down: DataFrame, key: Sequence[str], most: float = 0.05) -> DataFrame:
    """Q8, Q9: distinct keys above and below, their drop ratio, and whether it is within `most`; nothing above passes only with nothing below."""
    count = lambda d: d.select(*key).distinct().agg(F.count("*").alias("n"))
    x = count(up).select(F.col("n").alias("upstream")).crossJoin(F.broadcast(count(down).select(F.col("n").alias("downstream"))))
    ratio = F.when(F.col("upstream") == 0, F.lit(0.0)).otherwise((F.col("upstream") - F.col("downstream")) / F.col("upstream"))
    x = x.withColumn("drop_ratio", ratio)
    return x.withColumn("success", F.when(F.col("upstream") == 0, F.col("downstream") == 0).otherwise(F.col("drop_ratio") <= most))


def key_differences(left: DataFrame, right: DataFrame, key: Sequence[str], sample: int = 10) -> DataFrame:
    """Keys on one side alone: (side, n, examples), the examples being the smallest `sample`."""
    name = F.concat_ws("|", *(F.col(k).cast("string") for k in key)).alias("key")
    a, b = left.select(name).distinct(), right.select(name).distinct()
    out = None
    for side, x in (("missing", a.join(b, "key", "left_anti")), ("extra", b.join(a, "key", "left_anti"))):
        small = x.orderBy("key").limit(sample).agg(F.array_sort(F.collect_list("key")).alias("examples"))
        one = x.agg(F.count("*").alias("n")).crossJoin(F.broadcast(small)).select(F.lit(side).alias("side"), "n", "examples")
        out = one if out is None else out.unionByName(one)
    return out


def range_digests(df: DataFrame, key: Sequence[str], ranges: int = 4096) -> DataFrame:
    """(range, n, total, mixed) of a layer: its keys, dealt to ranges by hash, as a count, a sum and an exclusive or of two 64-bit hashes.

    The digests don't depend on order and add up in the tasks, so at most `ranges` rows a task are shuffled.
    """
    name = F.concat_ws("|", *(F.col(k).cast("string") for k in key))
    x = df.select(name.alias("key"))
    return x.groupBy(F.pmod(F.hash("key"), F.lit(ranges)).alias("range")).agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("total"), F.bit_xor(F.xxhash64(F.lit(1), F.col("key"))).alias("mixed")
    )


def differing_ranges(left: DataFrame, right: DataFrame, key: Sequence[str], ranges: int = 4096) -> list[int]:
    """The ranges whose digests differ; at most `ranges` numbers. Equal digests of unequal keys would need both 64-bit hashes to agree by chance."""
    a, b = (range_digests(d, key, ranges) for d in (left, right))
    b = b.toDF("range", "n2", "total2", "mixed2")
    same = F.col("n").eqNullSafe(F.col("n2")) & F.col("total").eqNullSafe(F.col("total2")) & F.col("mixed").eqNullSafe(F.col("mixed2"))
    return sorted(r[0] for r in a.join(b, "range", "full").where(~same).select("range").collect())


def layer_differences(left: DataFrame, right: DataFrame, key: Sequence[str], sample: int = 10, ranges: int = 4096) -> DataFrame:
    """key_differences by digests: only keys of ranges that differ are compared one by one, so equal layers shuffle no keys.

    A range with a key that is repeated on one side is compared too, and comes out equal there.
    """
    apart = differing_ranges(left, right, key, ranges)
    name = F.concat_ws("|", *(F.col(k).cast("string") for k in key))
    of = lambda d: d.where(F.pmod(F.hash(name), F.lit(ranges)).isin(apart) if apart else F.lit(False))
    return key_differences(of(left), of(right), key, sample)


def orphans(child: DataFrame, parent: DataFrame, key: Sequence[str]) -> DataFrame:
    """Child rows without a parent."""
    return child.join(parent.select(*key).distinct(), list(key), "left_anti")


def key_duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows, different keys, and rows beyond them."""
    x = df.groupBy(*key).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("keys"))
    return x.withColumn("duplicates", F.col("rows") - F.col("keys"))


def business_days(start: Column, end: Column) -> Column:
    """Q11: weekdays after start up to end; none if end isn't later."""
    days = F.sequence(F.date_add(start, 1), F.greatest(end, F.date_add(start, 1)))
    return F.when(end <= start, F.lit(0)).otherwise(F.size(F.filter(days, lambda d: F.weekday(d) < 5)))


def freshness(df: DataFrame, date: str, as_of: Column, most: int = 2, business: bool = True) -> DataFrame:
    """Newest date, its age at as_of, and whether that is at most `most` days."""
    x = df.agg(F.max(F.col(date).cast("date")).alias("newest"))
    age = business_days(F.col("newest"), as_of) if business else F.datediff(as_of, F.col("newest"))
    x = x.withColumn("age", age)
    return x.withColumn("success", F.coalesce(F.col("age") <= most, F.lit(False)))


def realtime_report(candles: DataFrame, universe: int, as_of: Column, open_hour: int = 9, close_hour: int = 15, least_coverage: float = 0.5, most_gap_minutes: int = 10) -> DataFrame:
    """Q13: (check, value, success) of one pass: duplicate keys, rows out of hours, broken bars, age in minutes, coverage."""
    x = candles.withColumn("_out", (F.hour("minute_ts") < open_hour) | (F.hour("minute_ts") >= close_hour))
    a = x.agg(
        F.count("*").alias("rows"), F.count_distinct("ticker", "minute_ts").alias("keys"), F.count_if("_out").alias("out"), F.count_if(F.expr("not coalesce(high >= low and high >= open and high >= close and low <= open and low <= close, false)")).alias("broken"),
        F.max("minute_ts").alias("newest"), F.count_distinct("ticker").alias("tickers"),
    )
    age = (F.unix_timestamp(as_of) - F.unix_timestamp(F.col("newest").cast("timestamp"))) / 60
    one = lambda name, value, ok: F.struct(F.lit(name).alias("check"), value.cast("double").alias("value"), F.coalesce(ok, F.lit(False)).alias("success"))
    extra, share = F.col("rows") - F.col("keys"), F.col("tickers") / universe
    checks = F.array(
        one("duplicate_keys", extra, extra == 0), one("rows_out_of_hours", F.col("out"), F.col("out") == 0), one("broken_bars", F.col("broken"), F.col("broken") == 0),
        one("age_minutes", age, age <= most_gap_minutes), one("coverage", share, share >= least_coverage),
    )
    return a.select(F.inline(checks))


def cross_source_volume(a: DataFrame, b: DataFrame, key: Sequence[str], most: float = 0.15) -> DataFrame:
    """Volumes that both sources have, summed, and whether they differ by at most `most`."""
    one = a.groupBy(*key).agg(F.sum("volume").alias("va")).join(b.groupBy(*key).agg(F.sum("volume").alias("vb")), list(key))
    x = one.agg(F.count("*").alias("shared"), F.coalesce(F.sum("va"), F.lit(0)).alias("volume_a"), F.coalesce(F.sum("vb"), F.lit(0)).alias("volume_b"))
    gap = F.try_divide(F.abs(F.col("volume_a") - F.col("volume_b")).cast("double"), F.greatest("volume_a", "volume_b").cast("double"))
    return x.withColumn("gap", F.coalesce(gap, F.lit(0.0))).withColumn("success", F.col("gap") <= most)


def layer_counts(raw: DataFrame, clean_: DataFrame, gold: DataFrame, key: Sequence[str], date: str) -> DataFrame:
    """One row of what reconciliation asks of three layers, from one aggregate by key that all of them go into once.

    upstream and downstream: different raw and clean keys; clean and gold: rows; missing and extra: clean keys that gold
    lacks and the reverse; untraced: extra keys without a null; surplus: gold rows beyond the first of their key; newest:
    gold's last day. A null is a value of the key.
    """
    layers = {"_r": raw, "_c": clean_, "_g": gold}
    day = lambda n, x: (F.col(date).cast("date") if n == "_g" else F.lit(None).cast("date")).alias("_day")
    rows = None
    for n, x in layers.items():
        one = x.select(*key, day(n, x), *(F.lit(int(m == n)).cast("long").alias(m) for m in layers))
        rows = one if rows is None else rows.unionByName(one)
    x = rows.groupBy(*key).agg(*(F.sum(n).alias(n) for n in layers), F.max("_day").alias("_day"))
    r, c, g = (F.col(n) > 0 for n in layers)
    total = lambda column: F.coalesce(F.sum(column), F.lit(0))
    known = F.lit(True)
    for k in key:
        known = known & F.col(k).isNotNull()
    return x.agg(
        F.count_if(r).alias("upstream"), F.count_if(c).alias("downstream"), total(F.col("_c")).alias("clean"), total(F.col("_g")).alias("gold"), F.count_if(c & ~g).alias("missing"), F.count_if(g & ~c).alias("extra"),
        F.count_if(g & ~c & known).alias("untraced"), total(F.when(g, F.col("_g") - 1)).alias("surplus"), F.max("_day").alias("newest"),
    )


def reconciliation(bars: tuple[DataFrame, DataFrame, DataFrame], index: tuple[DataFrame, DataFrame, DataFrame], articles: tuple[DataFrame, DataFrame, DataFrame], as_of: Column, most_drop: float = 0.05, most_days: int = 2) -> DataFrame:
    """Q12: (check, value, success) of all 14 checks between the raw, clean and published layers of bars, index bars and articles.

    For bars and index bars: the drop from raw to clean, equal counts and equal keys from clean to published, and
    surplus published keys; for articles the drop, published urls that the clean layer lacks, and surplus keys; and
    for each the newest published day, in business days but for articles. value is a ratio, a count or an age.
    """
    one = lambda name, value, ok: F.struct(F.lit(name).alias("check"), value.cast("double").alias("value"), F.coalesce(ok, F.lit(False)).alias("success"))
    c, whole = F.col, None
    dropped = F.when(c("upstream") == 0, F.lit(0.0)).otherwise((c("upstream") - c("downstream")) / c("upstream"))
    drop = lambda what: one(f"{what}_raw_to_clean", dropped, F.when(c("upstream") == 0, c("downstream") == 0).otherwise(dropped <= most_drop))
    for what, layers, key in (("bars", bars, ("ticker", "date")), ("index", index, ("index_code", "date"))):
        age = business_days(c("newest"), as_of)
        x = layer_counts(*layers, key, "date").select(F.inline(F.array(
            drop(what), one(f"{what}_same_count", c("clean") - c("gold"), c("clean") == c("gold")), one(f"{what}_same_keys", c("missing") + c("extra"), c("missing") + c("extra") == 0),
            one(f"{what}_keys_once", c("surplus"), c("surplus") == 0), one(f"{what}_fresh", age, age <= most_days),
        )))
        whole = x if whole is None else whole.unionByName(x)
    age = F.datediff(as_of, c("newest"))
    x = layer_counts(*articles, ["url"], "published_at").crossJoin(F.broadcast(surplus(articles[2], ["article_id", "ticker"])))
    return whole.unionByName(x.select(F.inline(F.array(
        drop("articles"), one("articles_traceable", c("untraced"), c("untraced") == 0), one("articles_keys_once", c("failed"), c("failed") == 0), one("articles_fresh", age, age <= most_days),
    ))))
