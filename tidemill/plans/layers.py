"""Registered queries: tables written and read back, contracts, details, marts and the reconciliation report (IO, P, D, M, N, Q, R, T)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.operators import alerts, clean, dedup, dims, facts, labels, marts, quality
from tidemill.operators import indicators as ind
from tidemill.operators import news as nw
from tidemill.sources import tables
from tidemill.storage import materialize, new_folder

from .adapters import BARS, INDEX_BARS, NEWS, PROFILES, TICKS, daily_bars, index_bars, news, profiles, rounded, table, ticks, with_
from .prices import _IND, _P
from .realtime import _DEV, _STATES, _VWAP, _vwap
from .registry import query


@query("select s_name as name, s_acctbal as balance, s_nationkey as nation, null::varchar as segment from supplier union all select c_name, c_acctbal, c_nationkey, c_mktsegment from customer")
def io1_u1_read_drifting(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = {f"{p}_{a}": b for p in "sc" for a, b in (("name", "name"), ("acctbal", "balance"), ("nationkey", "nation"), ("mktsegment", "segment"))}
    return tables.read_drifting(spark, [f"{sf_dir}/{t}.parquet" for t in ("supplier", "customer")], "name string, balance double, nation int, segment string", aliases)


_MONTHS = "select year(o_orderdate) as year, month(o_orderdate) as month, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by 1, 2"


@query(_MONTHS)
def io3_io5_monthly_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "monthly")
    tables.write_monthly(table(spark, sf_dir, "orders"), path, "o_orderdate", sort=("o_orderkey",))
    return rounded(tables.read_keyed(spark, path).groupBy("year", "month").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total")), 2, "total")


@query("select year(ts) as year, month(ts) as month, day(ts) as day, count(*) as n from events group by 1, 2, 3")
def io8_daily_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "daily")
    tables.write_monthly(table(spark, sf_dir, "events"), path, "ts", sort=("event_id",), day=True)
    return tables.read_keyed(spark, path).groupBy("year", "month", "day").agg(F.count("*").alias("n"))


@query("select s_suppkey, s_name, d as snapshot_date from supplier, (values (date '2024-01-01'), (date '2024-01-02')) t(d)")
def io7_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, x = new_folder(spark, "snapshots"), table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    for day in ("2024-01-01", "2024-01-02", "2024-01-01"):
        tables.write_snapshot(x, path, day)
    return tables.read_keyed(spark, path)


@query("select concat('S', s_suppkey) as ticker, n_name as sector_name, upper(n_name) as sector_id, null::varchar as industry_group from supplier join nation on s_nationkey = n_nationkey where s_acctbal > 0")
def io9_sector_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV holds blanks around its values, blank sectors, and each ticker a second time in lower case."""
    path, x = new_folder(spark, "sectors"), profiles(spark, sf_dir).join(table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("ticker"), "s_acctbal"), "ticker")
    row = lambda t: x.select(t.alias("ticker"), F.when(F.col("s_acctbal") > 0, F.lower("sector_name")).otherwise(" ").alias("sector_id"), "sector_name", F.lit(None).cast("string").alias("industry_group"))
    row(F.concat(F.lit(" "), "ticker")).unionByName(row(F.lower("ticker"))).coalesce(1).write.option("header", True).csv(path)
    return dims.read_sector_mapping(spark, path)


@query("select distinct upper(trim(c_mktsegment)) as ticker from customer")
def io10_ticker_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tickers")
    table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("Symbol")).write.option("header", True).csv(path)
    return tables.read_tickers(spark, path)


@query("select doc_id, quality, toxic from labels")
def io16_datasets_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "datasets")
    tables.write_datasets(table(spark, sf_dir, "labels").withColumn("split", F.when(F.col("quality") == 1, "train").otherwise("test")), path)
    return spark.read.parquet(f"{path}/parquet").select("doc_id", "quality", "toxic")


@query("select r_regionkey, r_name from region")
def io23_bundle_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "bundle")
    tables.write_bundle({"region": table(spark, sf_dir, "region"), "nation": table(spark, sf_dir, "nation")}, path)
    return spark.read.json(f"{path}/region", schema="r_regionkey int, r_name string")


@query("select n_nationkey, n_name, n_regionkey from nation")
def io24_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "overwritten")
    for part in (table(spark, sf_dir, "nation").limit(1), table(spark, sf_dir, "nation")):
        tables.overwrite(part, path, "dim_nation")
    return spark.read.parquet(path)


@query("select c_custkey as alert_id, c_mktsegment as condition_type from customer where c_acctbal > 0")
def io20_active_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("alert_id"), F.col("c_mktsegment").alias("condition_type"), (F.col("c_acctbal") > 0).alias("is_active"))
    return alerts.active(x).drop("is_active")


@query("select o_orderkey as ticker, try_cast(substr(o_orderpriority, 1, 1 + cast(o_orderkey % 2 as integer)) as integer) as code, o_totalprice as close, null::bigint as volume, null::date as date from orders")
def p1_p5_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names to clean, an alias whose target is there and one whose target is not, casts that fail, columns that lack."""
    x = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias(" Symbol "), F.col("o_orderpriority").substr(F.lit(1), (1 + F.col("o_orderkey") % 2).cast("int")).alias("Code"), F.col("o_totalprice").alias("Close"))
    x = clean.apply_aliases(clean.normalize_names(x), {"symbol": "ticker", "code": "ticker"})
    schemas.require_columns(x, ("ticker", "close"), "orders")
    return schemas.conform(clean.lenient(x, code="int"), "ticker bigint, code int, close double, volume bigint, date date")


@query(with_(BARS) + "select ticker, date, volume, '1d' as resolution from (select *, case when volume % 7 = 0 then null when volume % 5 = 0 then -open else open end as o from bars) where o > 0")
def p8_valid_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = daily_bars(spark, sf_dir)
    v = F.col("volume")
    x = x.withColumn("open", F.when(v % 7 == 0, F.lit(None)).when(v % 5 == 0, -F.col("open")).otherwise(F.col("open")))
    return clean.valid_candles(x, "1d").select("ticker", "date", "volume", "resolution")


@query("select upper(s_name) as ticker, s_suppkey, timestamp '2024-01-02 03:04:05' as ingested_at, timestamp '2024-01-02 03:04:05' as processed_at, 'supplier' as source_name from supplier")
def p12_audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.audited(table(spark, sf_dir, "supplier").select(F.col("s_name").alias("ticker"), "s_suppkey"), "supplier", F.lit("2024-01-02 03:04:05").cast("timestamp_ntz"))


@query(with_(NEWS) + "select source as ticker, title, last(url order by published_at, url) as url from news group by 1, 2")
def d9_title_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = news(spark, sf_dir)
    return dedup.title_links(n.select("article_id", F.col("source").alias("ticker")), n)


#: Each article is about one ticker; two model versions have judged it, the second later.
_DETAIL = """detail as (select article_id, concat('T', length(content) % 20) as ticker, published_at, source, title, 1 + length(content) % 3 as match_score,
    case doc_id % 3 when 0 then 'positive' when 1 then 'negative' else 'neutral' end as sentiment_label, (doc_id % 7 - 3) / 3.0::double as sentiment_score, (doc_id % 10) / 10.0::double as confidence_score, 'v2' as model_version from news)"""


def _detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, d = news(spark, sf_dir), F.col("doc_id")
    label = F.when(d % 3 == 0, "positive").when(d % 3 == 1, "negative").otherwise("neutral")
    p = n.select("article_id", label.alias("sentiment_label"), ((d % 7 - 3) / F.lit(3.0)).alias("sentiment_score"), (d % 10 / F.lit(10.0)).alias("confidence_score"), F.explode(F.array(F.lit("v1"), F.lit("v2"))).alias("model_version"))
    p = p.withColumn("inferred_at", F.when(F.col("model_version") == "v2", F.lit("2024-02-02")).otherwise(F.lit("2024-02-01")).cast("timestamp_ntz"))
    p = p.withColumn("sentiment_score", F.when(F.col("model_version") == "v1", F.lit(0.0)).otherwise(F.col("sentiment_score")))
    size = F.length("content")
    links = n.select("article_id", F.concat(F.lit("t"), size % 20).alias("ticker"), "published_at", "source", "title", (1 + size % 3).alias("match_score"))
    return nw.sentiment_detail(p, links)


@query(with_(NEWS, _DETAIL) + "select article_id, ticker, published_at, source, title, cast(match_score as integer) as match_score, sentiment_label, round(sentiment_score, 6) as sentiment_score, round(confidence_score, 6) as confidence_score, model_version from detail")
def n12_n14_sentiment_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = nw.publishable(_detail(spark, sf_dir)).drop("inferred_at")
    return rounded(x.withColumn("match_score", F.col("match_score").cast("int")), 6, "sentiment_score", "confidence_score")


@query(with_(NEWS, _DETAIL) + """, a as (select ticker, published_at as day, count(distinct article_id) as n, count(*) filter (sentiment_label = 'positive') as p, count(*) filter (sentiment_label = 'negative') as m, avg(sentiment_score) as s, last(title order by match_score, article_id) as h from detail where published_at is not null group by 1, 2),
    x as (select ticker, cast(sum(n) as bigint) as news, cast(sum(p) as bigint) as positive, cast(sum(m) as bigint) as negative, avg(s) as score, last(h order by day) as headline from a where day >= date '2024-01-13' group by 1),
    c as (select ticker, avg(confidence_score) as confidence from detail where published_at >= date '2024-01-13' group by 1)
    select ticker, news, positive, negative, round(score, 6) as score, headline, round(confidence, 6) as confidence from x left join c using (ticker)""")
def a14_m25_sentiment_by_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _detail(spark, sf_dir)
    return rounded(marts.sentiment_by_ticker(nw.sentiment_daily(x), x, F.lit("2024-01-20").cast("date")), 6, "score", "confidence")


@query(with_(NEWS, _DETAIL) + """, y as (select *, case when confidence_score > 0.85 then 2.0 else sentiment_score end as s, case when source in ('src1', 'src2') then 'odd' else sentiment_label end as l from detail)
    select suite, rule, failed, failed = 0 as success from (select 'sentiment' as suite, 'label_known' as rule, count(*) filter (l not in ('positive', 'negative', 'neutral')) as failed from y
    union all select 'sentiment', 'score_in_range', count(*) filter (not coalesce(s between -1 and 1, false)) from y union all select 'sentiment', 'confidence_in_range', count(*) filter (not coalesce(confidence_score between 0 and 1, false)) from y
    union all select 'sentiment', 'ticker_not_empty', count(*) filter (not coalesce(length(trim(ticker)) > 0, false)) from y union all select 'sentiment', 'key_unique', cast(count(*) - count(distinct (article_id, ticker, model_version)) as bigint) from y)""")
def q6_sentiment_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _detail(spark, sf_dir)
    x = x.withColumns({"sentiment_score": F.when(F.col("confidence_score") > 0.85, 2.0).otherwise(F.col("sentiment_score")), "sentiment_label": F.when(F.col("source").isin("src1", "src2"), "odd").otherwise(F.col("sentiment_label"))})
    return quality.expectations(x, quality.SENTIMENT)


@query(with_(NEWS, _DETAIL, PROFILES) + """, g as (select count(*) as n, count(*) filter (confidence_score not between 0 and 1) as bad from detail), p as (select count(*) as n from profiles)
    select 'sentiment' as source_name, g.n as record_count, cast(g.bad as bigint) as error_count from g where g.bad > 0 union all select 'profile', p.n, p.n from p""")
def io14_io15_q14_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A suite that passes its gate and one that fails are reported; those with errors are read back."""
    path, detail, p = new_folder(spark, "reports"), _detail(spark, sf_dir), profiles(spark, sf_dir)
    at, never = F.lit("2024-02-02").cast("timestamp"), quality.Suite("profile", ("ticker",), (("no_ticker", "ticker is null"),), ("ticker",))
    found = quality.run_suites({"sentiment": (detail, quality.SENTIMENT), "profile": (p, never)}, stop_at_first=False)
    quality.gate(found[0], "sentiment")
    for results, name, x in zip(found, ("sentiment", "profile"), (detail, p), strict=True):
        tables.write_report(quality.report(results, name, at, x), path)
    return tables.read_reports(spark, path).select("source_name", "record_count", "error_count")


@query("select sha1(cast(doc_id as varchar)) as id, length(text) as chars, source as choice, n_chars / 100.0::double as score from documents")
def n19_review_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "documents").select(F.sha1(F.col("doc_id").cast("string")).alias("article_id"), "text", F.col("source").alias("label"), (F.col("n_chars") / 100).alias("confidence"))
    p = F.element_at("predictions", 1)
    return labels.review_tasks(x).select("data.id", F.length("data.text").cast("long").alias("chars"), F.element_at(F.element_at(p["result"], 1)["value"]["choices"], 1).alias("choice"), p["score"].alias("score"))


@query("with b as (select lang, count(*) as n from documents where source is not null group by 1), e as (select lang, least(count(*), 40) as n from documents group by 1) select lang, b.n + e.n as n from b join e using (lang)")
def n24_external_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 40 external rows of each label, however many there are: the operator's own limit."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return labels.add_external(d.where("source is not null"), d, "lang", 40, "doc_id").groupBy("lang").agg(F.count("*").alias("n"))


@query("""with r as (select url, max_by(status, ts) as status from (select concat('u', user_id) as url, case event_type when 'view' then 'discovered' else 'success' end as status, struct_pack(a := ts, b := event_id) as ts from events) group by 1),
    s as (select distinct 'seed' as source, concat('u', c_custkey) as url from customer)
    select source, status, count(*) as n from (select 'registry' as source, status from r union all select source, 'discovered' from s where url not in (select url from r)) group by 1, 2""")
def n5_seeded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("u"), "user_id").alias("url"), F.when(F.col("event_type") == "view", "discovered").otherwise("success").alias("status"), F.struct("ts", "event_id").alias("at"))
    known = e.groupBy("url").agg(F.max_by("status", "at").alias("status")).withColumn("source", F.lit("registry"))
    seeds = table(spark, sf_dir, "customer").select(F.concat(F.lit("u"), "c_custkey").alias("url"), F.lit("discovered").alias("status"), F.lit("seed").alias("source")).distinct()
    return nw.status_counts(nw.seeded(known, seeds))


@query(with_(BARS, _P, _IND) + """select date as trading_date, round(close, 4) as close, round(coalesce(rsi_14, 50), 4) as rsi_14, round(coalesce(bb_upper, high), 4) as bb_upper, round(coalesce(bb_lower, low), 4) as bb_lower from i where ticker = 'S1' order by date desc limit 100""")
def m19_candle_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = ind.price_indicators(daily_bars(spark, sf_dir)).withColumn("trading_date", F.col("date"))
    return rounded(marts.candle_series(x, "S1", 100).select("trading_date", "close", "rsi_14", "bb_upper", "bb_lower"), 4, "close", "rsi_14", "bb_upper", "bb_lower")


_BAND = """band as (select * from (select ticker, close, volume / nullif(avg(volume) over w, 0) as ratio, max(high) over w as hi, min(low) over w as lo, row_number() over (partition by ticker order by date desc) as k
    from bars window w as (partition by ticker order by date rows between 20 preceding and 1 preceding)) where k = 1)"""


@query(with_(BARS, _P, _IND, TICKS, _STATES, _VWAP, _BAND) + f""", day as (select ticker, close, rsi_14, bb_upper, bb_lower from i where date = (select max(date) from bars)),
    live as (select replace(ticker, 'U', 'S') as ticker, last({_DEV} order by minute_ts, data_source) as dev from vwap group by 1)
    select coalesce(day.ticker, live.ticker, band.ticker) as ticker, round(coalesce(band.close, day.close), 4) as close, round(rsi_14, 4) as rsi_14, round(bb_upper, 4) as bb_upper, round(bb_lower, 4) as bb_lower, round(dev, 4) as deviation, round(ratio, 4) as ratio, round(hi, 4) as hi, round(lo, 4) as lo
    from day full join live on live.ticker = day.ticker full join band on band.ticker = coalesce(day.ticker, live.ticker)""")
def r1_market_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = daily_bars(spark, sf_dir)
    v = _vwap(spark, sf_dir).withColumns({"ticker": F.replace("ticker", F.lit("U"), F.lit("S")), "minute_ts": F.struct("minute_ts", "data_source")})
    x = alerts.market_context(ind.price_indicators(bars).withColumn("trading_date", F.col("date")), v, bars.withColumnRenamed("date", "minute_ts"))
    x = x.select("ticker", "close", "rsi_14", "bb_upper", "bb_lower", F.col("price_vs_session_vwap_pct").alias("deviation"), F.col("intraday_volume_ratio").alias("ratio"), F.col("intraday_rolling_high_20").alias("hi"), F.col("intraday_rolling_low_20").alias("lo"))
    return rounded(x, 4, *x.columns[1:])


_CHECKS = """, rb as (select ticker, date from bars), cb as (select * from bars where volume >= 10), gb as (select * from cb where high > low),
    ri as (select index_code, date from index_bars), gi as (select * from index_bars where high > low),
    cn as (select * from news where length(content) >= 50), gn as (select article_id, url, source as ticker, published_at from news where category = 'en')"""
_BUSINESS = "(select case when date '2001-12-05' <= n then 0 else len(list_filter(generate_series(cast(n as timestamp) + interval 1 day, timestamp '2001-12-05', interval 1 day), lambda d: isodow(d) < 6)) end from (select max(date) as n from {0}))"


@query(with_(BARS, PROFILES, INDEX_BARS, NEWS) + _CHECKS + f""", v as (
    select 'bars_raw_to_clean' as "check", ((select count(*) from rb) - (select count(*) from cb)) / cast((select count(*) from rb) as double) as value, 0.05 as most
    union all select 'bars_same_count', (select count(*) from cb) - (select count(*) from gb), 0 union all select 'bars_same_keys', (select count(*) from cb anti join gb using (ticker, date)), 0
    union all select 'bars_keys_once', 0, 0 union all select 'bars_fresh', {_BUSINESS.format('gb')}, 2
    union all select 'index_raw_to_clean', 0, 0.05 union all select 'index_same_count', (select count(*) from index_bars) - (select count(*) from gi), 0 union all select 'index_same_keys', (select count(*) from index_bars anti join gi using (index_code, date)), 0
    union all select 'index_keys_once', 0, 0 union all select 'index_fresh', {_BUSINESS.format('gi')}, 2
    union all select 'articles_raw_to_clean', ((select count(distinct url) from news) - (select count(distinct url) from cn)) / cast((select count(distinct url) from news) as double), 0.05
    union all select 'articles_traceable', (select count(distinct url) from gn where url not in (select url from cn)), 0
    union all select 'articles_keys_once', (select count(*) - count(distinct (article_id, coalesce(ticker, '~'))) from gn), 0 union all select 'articles_fresh', date '2001-12-05' - (select max(published_at) from gn), 2)
    select "check", round(cast(value as double), 6) as value, value <= most and ("check" not like '%same_count' or value = 0) as success from v""")
def q12_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published bars lack those without a range, clean ones those of little volume; published articles are the English ones."""
    bars, n = materialize(daily_bars(spark, sf_dir), "bars"), news(spark, sf_dir)
    index = materialize(index_bars(spark, sf_dir, bars), "index-bars")
    kept = bars.where("volume >= 10")
    gold = n.where("category = 'en'").withColumn("ticker", F.col("source"))
    x = quality.reconciliation((bars, kept, kept.where("high > low")), (index, index, index.where("high > low")), (n, n.where(F.length("content") >= 50), gold), F.lit("2001-12-05").cast("date"))
    return rounded(x, 6, "value")
