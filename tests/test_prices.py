import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemill.operators import clean, dedup, dims, facts, marts
from tidemill.operators import indicators as ind
from tidemill.schemas import SILVER_OHLCV, ContractError, conform, may_overwrite, require_columns

BARS = "ticker string, date date, open double, high double, low double, close double, volume bigint"
D = dt.date


def bars(spark, n, ticker="AAA", close=lambda i: 10.0 + i):
    return spark.createDataFrame([(ticker, D(2024, 1, 1) + dt.timedelta(i), close(i) - 1, close(i) + 1, close(i) - 2, close(i), 100 * (i + 1)) for i in range(n)], BARS)


def test_raw_bars_become_valid_silver(spark):
    raw = spark.createDataFrame([("aaa", "2024-01-02", "1", "2", "1", "2", "10"), ("aaa", "2024-01-02", "1", "3", "1", "3", "11"), ("bbb", "2024-01-02", "1", "1", "2", "1", "5"), ("ccc", "2024-01-02", "1", "2", "1", "2", "-1"), ("ddd", "no day", "x", "2", "1", "2", "5")], "` Symbol` string, Time string, Open string, High string, Low string, Close string, Vol string")
    x = conform(clean.apply_aliases(clean.normalize_names(raw), clean.OHLCV_ALIASES), SILVER_OHLCV)
    kept = dedup.keep_last(clean.valid_bars(x), ["ticker", "date"], ["close"])
    assert rows(kept) == [("aaa", D(2024, 1, 2), 1.0, 3.0, 1.0, 3.0, 11)]


def test_aliases_keep_a_present_target(spark):
    df = spark.createDataFrame([(1, 2)], "symbol int, ticker int")
    assert clean.apply_aliases(df, clean.OHLCV_ALIASES).columns == ["symbol", "ticker"]


def test_contracts(spark):
    with pytest.raises(ContractError, match="lacks b, c"):
        require_columns(spark.range(1), ["id", "c", "b"])
    with pytest.raises(ContractError):
        may_overwrite("fact_alert_event")
    assert may_overwrite("dim_date") == "dim_date"


def test_indicators_need_their_history(spark):
    x = rows(ind.price_indicators(bars(spark, 25)).select("sma_20", "rsi_14", "bb_upper", "price_change", "overbought_flag", "breakout_flag", "date"), "date")
    assert [r[0] is None for r in x] == [True] * 19 + [False] * 6
    assert [r[1] is None for r in x] == [True] * 13 + [False] * 12
    assert x[19][0] == pytest.approx(sum(range(10, 30)) / 20)
    assert x[24][1] == 100.0 and x[24][4] == 1
    assert x[0][3] == 0.0 and x[1][3] == 1.0
    assert x[19][2] == pytest.approx(19.5 + 2 * 5.9160797831)


def test_exponential_means_recur(spark):
    x = rows(ind.exponential_means(bars(spark, 3)).select("date", "ema_12", "ema_26", "macd", "macd_signal"), "date")
    a, b = 2 / 13, 2 / 27
    assert x[0][1:] == (10.0, 10.0, 0.0, 0.0)
    assert x[1][1] == pytest.approx(a * 11 + (1 - a) * 10) and x[1][2] == pytest.approx(b * 11 + (1 - b) * 10)
    assert x[2][4] == pytest.approx(0.2 * x[2][3] + 0.8 * x[1][4])


def test_fact_daily_price_joins_shares(spark):
    shares = spark.createDataFrame([("AAA", 100)], "ticker string, shares_outstanding long")
    f = facts.fact_daily_price(bars(spark, 2).unionByName(bars(spark, 1, "BBB")), shares)
    assert f.columns == facts.DAILY_COLUMNS
    got = rows(f.select("ticker", "date_id", "market_cap", "price_change", "pct_change"), "ticker", "date_id")
    assert got == [("AAA", 20240101, 1000.0, 0.0, 0.0), ("AAA", 20240102, 1100.0, 1.0, 10.0), ("BBB", 20240101, 0.0, 0.0, 0.0)]


def test_breadth_and_ratio(spark):
    x = spark.createDataFrame([("A", D(2024, 1, 1), 1.0, 2.0, 1.0, 2.0, 1), ("B", D(2024, 1, 1), 2.0, 2.0, 1.0, 1.0, 1), ("C", D(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1)], BARS)
    p = spark.createDataFrame([("A", "HOSE", 5), ("B", "HOSE", 9), ("C", "HNX", 1)], "ticker string, exchange string, shares_outstanding long")
    m = facts.index_members(p, {"HOSE": "VNINDEX"}, top=1)
    assert rows(facts.index_breadth(x, m), "index_id") == [("VN30", D(2024, 1, 1), 0, 1, 0, 0.0), ("VNINDEX", D(2024, 1, 1), 1, 1, 0, 1.0)]
    i = facts.index_fact(spark.createDataFrame([("vnindex", D(2024, 1, 1), 1.0, 2.0, 1.0, 2.0, 1)], "index_code string, date date, open double, high double, low double, close double, volume bigint"), facts.index_breadth(x, m))
    assert rows(i.select("index_id", "advance_count", "advance_decline_ratio")) == [("VNINDEX", 1, 1.0)]


def test_vwap_of_three_ticks(spark):
    t = spark.createDataFrame([("A", dt.datetime(2024, 1, 1, 9, 0, 1), 100.0, 100, "x"), ("A", dt.datetime(2024, 1, 1, 9, 0, 30), 115.0, 100, "x"), ("A", dt.datetime(2024, 1, 1, 9, 1, 0), 120.0, 300, "x")], "ticker string, trade_ts timestamp_ntz, price double, volume long, data_source string")
    x = rows(facts.vwap(facts.merge_states(facts.minute_states(t))).select("minute_ts", "vwap_1m", "session_vwap", "open", "close", "trades"), "minute_ts")
    assert [r[1:] for r in x] == [(107.5, 107.5, 100.0, 115.0, 2), (120.0, 115.0, 120.0, 120.0, 1)]


def test_a_distance_from_a_vwap_of_zero_is_no_number(spark):
    t = spark.createDataFrame([(k, dt.datetime(2024, 1, 1, h), p, v, "x") for k, h, p, v in (("A", 9, 0.0, 1), ("A", 10, 4.0, 3), ("B", 9, 5.0, 1), ("C", 9, 1.0, 0))], "ticker string, trade_ts timestamp_ntz, price double, volume long, data_source string")
    v = facts.vwap(facts.merge_states(facts.minute_states(t, "hour")))
    assert [(r[0], str(r[1])[:5]) for r in rows(v.select("ticker", "price_vs_session_vwap_pct"), "ticker", "minute_ts")] == [("A", "nan"), ("A", "33.33"), ("B", "0.0"), ("C", "None")]
    assert rows(marts.vwap_board(v).select("ticker", "far", "above", "below"), "ticker") == [("A", 2, 2, 0), ("B", 0, 0, 0), ("C", 0, 0, 0)]
    assert [r[0] for r in rows(marts.topped(v, 2, F.abs("price_vs_session_vwap_pct").desc(), "ticker").select("minute_ts"))] == [dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 1, 10)]
    x = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (float("nan"), 0.0), (1.0, 2.0), (None, 0.0), (1.0, None)], "a double, b double")
    assert [str(r[0]) for r in rows(x.select(ind.ratio(F.col("a"), F.col("b"))))] == ["inf", "-inf", "nan", "nan", "0.5", "None", "None"]


def test_states_merge_in_any_split(spark):
    t = spark.createDataFrame([("A", dt.datetime(2024, 1, 1, 9, 0, s), float(p), 1, "x") for s, p in enumerate((5, 9, 2, 7))], "ticker string, trade_ts timestamp_ntz, price double, volume long, data_source string")
    whole = rows(facts.merge_states(facts.minute_states(t)))
    parts = facts.minute_states(t.where("price > 6")).unionByName(facts.minute_states(t.where("price <= 6")))
    assert rows(facts.merge_states(parts)) == whole
    assert whole[0][3:7] == (5.0, 9.0, 2.0, 7.0)


def test_dims(spark):
    p = spark.createDataFrame([("a", None, "HOSE", "Công ty chứng khoán", 5), ("b", "B", None, " ", None)], "ticker string, company_name string, exchange string, sector_name string, shares_outstanding long")
    assert rows(dims.dim_stock(p), "ticker") == [("A", "A", "HOSE", "CHUNG_KHOAN", "ACTIVE", 5), ("B", "B", "UNKNOWN", "UNKNOWN", "ACTIVE", 0)]
    assert [r[0] for r in rows(dims.dim_sector(p).select("sector_id"), "sector_id")] == ["CÔNG_TY_CHỨNG_KHOÁN", "UNKNOWN"]
    assert [r[0] for r in rows(dims.dim_index(spark), "index_id")] == ["VN30", "VNINDEX"]
    assert rows(dims.dim_date(spark, "2024-01-06", "2024-01-07").select("date_id", "day_of_week", "is_trading_day"), "date_id") == [(20240106, "Saturday", 0), (20240107, "Sunday", 0)]
    m = spark.createDataFrame([("a", "BANK", "Bank", "Finance")], "ticker string, sector_id string, sector_name string, industry_group string")
    assert rows(dims.dim_stock(None, spark.createDataFrame([("a",)], "ticker string"), m).select("ticker", "company_name", "sector_id")) == [("A", "A", "BANK")]


def test_first_known_and_priority(spark):
    x = spark.createDataFrame([("V", 1, None, 7), ("V", 2, "Bank", None), ("V", 3, "Later", 9)], "k string, o int, name string, n int")
    assert rows(dedup.first_known(x, ["k"], "o")) == [("V", "Bank", 7)]
    y = spark.createDataFrame([("A", 1, "other", 9.0), ("A", 1, "main", 1.0), ("B", 1, "other", 5.0)], "k string, v int, data_source string, p double")
    assert rows(dedup.prefer_source(y, ["k"], "main", "v").select("k", "p"), "k") == [("A", 1.0), ("B", 5.0)]


@pytest.mark.parametrize("url,want", [
    ("HTTPS://Ex.COM/A?utm_source=x&b=1#top", "https://ex.com/A?b=1"), ("http://e.com/?fbclid=1", "http://e.com/"), ("http://e.com/p?a=1&gclid=2&c=3", "http://e.com/p?a=1&c=3"),
])
def test_normalize_url(spark, url, want):
    assert spark.range(1).select(clean.normalize_url(F.lit(url))).first()[0] == want


@pytest.mark.parametrize("text,want", [("2024-05-06T01:02", "2024-05-06"), ("6/5/2024 10:00", "2024-05-06"), ("06-05-2024", "2024-05-06"), ("yesterday evening", "yesterday ")])
def test_article_date(spark, text, want):
    assert spark.range(1).select(clean.article_date(F.lit(text))).first()[0] == want


@pytest.mark.parametrize("value", ["1704074400", "1704074400000", "1704074400000000", '{"Seconds": 1704074400, "Nanos": 5}'])
def test_epoch_times(spark, value):
    assert spark.range(1).select(clean.epoch_time(F.lit(value))).first()[0] == dt.datetime(2024, 1, 1, 9, 0)


def test_messages_unwrap(spark):
    x = spark.createDataFrame([('{"data":{"symbol":"a","price":1.5,"volume":2,"time":"1704074400"}}',), ('{"payload":{"symbol":"b","matchPrice":2,"matchQtty":3,"time":"1704074400"}}',), ('{"symbol":"c","price":3,"volume":4,"time":"1704074400"}',), ('{"symbol":"d"}',), ("no json",)], "value string")
    got = clean.shape_ticks(x.select(clean.unwrap_message("value").alias("body")))
    assert rows(got.select("ticker", "price", "volume"), "ticker") == [("A", 1.5, 2), ("B", 2.0, 3), ("C", 3.0, 4)]


def test_resample_and_band(spark):
    c = spark.createDataFrame([("A", dt.datetime(2024, 1, 1, 9, m), float(m), m + 2.0, m - 1.0, m + 1.0, 10 * (m + 1)) for m in range(10)], "ticker string, minute_ts timestamp_ntz, open double, high double, low double, close double, volume long")
    x = rows(facts.resample(c, 5).select("open", "high", "low", "close", "volume"), "open")
    assert x == [(0.0, 6.0, -1.0, 5.0, 150), (5.0, 11.0, 4.0, 10.0, 400)]
    band = ind.trailing_band(c, n=3).first()
    assert (band.volume_avg, band.band_high, band.band_low, band.volume_ratio) == (80.0, 10.0, 5.0, 1.25)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_for_the_mart_work_out_no_windows(spark):
    shares = spark.createDataFrame([("AAA", 100)], "ticker string, shares_outstanding long")
    whole = facts.fact_daily_price(bars(spark, 40), shares)
    thin = facts.fact_daily_price(bars(spark, 40), shares, columns=facts.MART_INPUTS)
    assert "Window" not in _plan(thin) and thin.columns == facts.MART_INPUTS
    marts_ = [facts.price_indicator_mart(facts.stage_daily_price(x)) for x in (whole, thin)]
    assert rows(marts_[0], "date_id") == rows(marts_[1], "date_id") and marts_[1].columns == facts.DAILY_COLUMNS


def test_newest_facts_are_those_of_the_whole_history(spark):
    shares = spark.createDataFrame([("AAA", 100)], "ticker string, shares_outstanding long")
    x = bars(spark, 40).unionByName(bars(spark, 3, "BBB"))
    since = x.agg(F.date_sub(F.max("date"), 5)).scalar()
    newest = facts.fact_daily_price(x, shares, where=F.col("date") >= since)
    want = facts.fact_daily_price(x, shares).where("trading_date >= date '2024-02-04'")
    assert rows(newest, "date_id") == rows(want, "date_id") and newest.count() == 6
