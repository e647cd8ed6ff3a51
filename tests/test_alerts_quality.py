import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemill.operators import alerts, marts, quality
from tidemill.schemas import ContractError

RULE = "alert_id string, user_id string, ticker string, condition_type string, threshold_value double, channel string, cooldown_minutes int"
MARKET = "ticker string, close double, rsi_14 double, bb_upper double, bb_lower double, price_vs_session_vwap_pct double, intraday_volume_ratio double, intraday_rolling_high_20 double, intraday_rolling_low_20 double"
STATE = "alert_id string, ticker string, metric_value double, updated_at timestamp"
NOW = dt.datetime(2024, 1, 5, 10, 0)

CASES = [  # condition, threshold, market fields, previous metric, value expected
    ("PRICE_ABOVE", 10.0, {"close": 10.0}, None, None), ("PRICE_ABOVE", 10.0, {"close": 10.1}, None, 10.1), ("PRICE_BELOW", 10.0, {"close": 10.0}, None, None), ("PRICE_BELOW", 10.0, {"close": 9.0}, None, 9.0),
    ("PRICE_ABOVE", 10.0, {}, None, None), ("RSI_ABOVE", 70.0, {"rsi_14": 71.0}, None, 71.0), ("RSI_BELOW", 30.0, {"rsi_14": 29.0}, None, 29.0), ("RSI_BELOW", 30.0, {"rsi_14": 30.0}, None, None),
    ("BB_BREAK", 0.0, {"close": 11.0, "bb_upper": 10.0}, None, 11.0), ("BB_BREAK", 0.0, {"close": 7.0, "bb_upper": 10.0, "bb_lower": 8.0}, None, 7.0), ("BB_BREAK", 0.0, {"close": 9.0, "bb_upper": 10.0, "bb_lower": 8.0}, None, None),
    ("VWAP_DEVIATION", 2.0, {"price_vs_session_vwap_pct": -2.5}, None, -2.5), ("VWAP_DEVIATION", 2.0, {"price_vs_session_vwap_pct": 2.0}, None, None),
    ("INTRADAY_VOLUME_SPIKE", 2.0, {"intraday_volume_ratio": 2.1}, None, 2.1), ("INTRADAY_BREAKOUT", 1.0, {"close": 102.0, "intraday_rolling_high_20": 100.0}, None, 102.0),
    ("INTRADAY_BREAKOUT", 1.0, {"close": 100.5, "intraday_rolling_high_20": 100.0, "intraday_rolling_low_20": 90.0}, None, None), ("INTRADAY_BREAKOUT", 1.0, {"close": 80.0, "intraday_rolling_low_20": 90.0}, None, 80.0),
    ("STOP_LOSS", 10.0, {"close": 10.0}, None, 10.0), ("TAKE_PROFIT", 10.0, {"close": 10.0}, None, 10.0), ("TAKE_PROFIT", 10.0, {"close": 9.9}, None, None),
    ("VWAP_CROSS_UP", 0.0, {"price_vs_session_vwap_pct": 0.5}, 0.0, 0.5), ("VWAP_CROSS_UP", 0.0, {"price_vs_session_vwap_pct": 0.5}, None, None), ("VWAP_CROSS_UP", 0.0, {"price_vs_session_vwap_pct": 0.5}, 0.1, None),
    ("VWAP_CROSS_DOWN", 0.0, {"price_vs_session_vwap_pct": -0.5}, 0.2, -0.5), ("RSI_CROSS_UP", 30.0, {"rsi_14": 32.0}, 28.0, 32.0), ("RSI_CROSS_UP", 30.0, {"rsi_14": 32.0}, 31.0, None), ("RSI_CROSS_DOWN", 70.0, {"rsi_14": 69.0}, 70.0, 69.0),
    ("NO_SUCH", 1.0, {"close": 5.0}, None, None),
]


def test_every_condition(spark):
    names = MARKET.replace(" double", "").replace(" string", "").split(", ")
    rules = spark.createDataFrame([(f"r{i}", "u", f"T{i}", c, t, "mail", 5) for i, (c, t, *_) in enumerate(CASES)], RULE)
    market = spark.createDataFrame([tuple([f"T{i}", *(m.get(n) for n in names[1:])]) for i, (_, _, m, *_) in enumerate(CASES)], MARKET)
    state = spark.createDataFrame([(f"r{i}", f"T{i}", p, NOW) for i, (_, _, _, p, _) in enumerate(CASES) if p is not None] + [("r24", "T24", 99.0, NOW - dt.timedelta(days=1))], STATE)
    got = {r.alert_id: r.actual_value for r in alerts.evaluate(rules, market, state).collect()}
    assert got == {f"r{i}": want for i, (*_, want) in enumerate(CASES)}
    assert rows(alerts.unknown_rules(rules).select("condition_type")) == [("NO_SUCH",)]


def test_expansion_cooldown_state_and_digest(spark):
    rules = spark.createDataFrame([("a", "u", "ALL", "PRICE_ABOVE", 1.0, "mail", 60), ("b", "u", "WATCHLIST", "RSI_CROSS_UP", 50.0, "mail", 5), ("c", "v", "x", "STOP_LOSS", 9.0, "chat", 5)], RULE)
    universe = spark.createDataFrame([("X",), ("Y",)], "ticker string")
    watch = spark.createDataFrame([("u", "Y"), ("w", "X")], "user_id string, ticker string")
    full = alerts.expand_rules(rules, universe, watch)
    assert rows(full.select("alert_id", "ticker"), "alert_id", "ticker") == [("a", "X"), ("a", "Y"), ("b", "Y"), ("c", "X")]
    market = spark.createDataFrame([("X", 5.0, 40.0, *[None] * 6), ("Y", 6.0, 60.0, *[None] * 6)], MARKET)
    ev = alerts.evaluate(full, market, spark.createDataFrame([], STATE))
    now = F.lit(NOW)
    fired = ev.where("actual_value is not null")
    assert rows(fired.select("alert_id", "ticker", "actual_value"), "alert_id", "ticker") == [("a", "X", 5.0), ("a", "Y", 6.0), ("c", "X", 5.0)]
    assert rows(alerts.next_state(ev, now).select("alert_id", "ticker", "metric_value")) == [("b", "Y", 60.0)]
    old = spark.createDataFrame([("u", "X", "PRICE_ABOVE", "mail", NOW - dt.timedelta(minutes=59)), ("u", "Y", "PRICE_ABOVE", "mail", NOW - dt.timedelta(minutes=61))], "user_id string, ticker string, condition_type string, channel string, triggered_at timestamp")
    kept = alerts.off_cooldown(fired, old, now)
    assert rows(kept.select("alert_id", "ticker"), "alert_id", "ticker") == [("a", "Y"), ("c", "X")]
    assert rows(alerts.cycle_summary(ev, kept)) == [(4, 3, 2, 1)]
    many = alerts.event_rows(fired.where("alert_id = 'a' and ticker = 'X'").crossJoin(spark.range(27)).drop("id"), now)
    text = alerts.digests(many).first()
    assert text.alerts == 27 and text.digest.startswith("PRICE_ABOVE (27)\n- X: 5.00\n") and text.digest.endswith("… 2 more")


def test_suites_count_every_rule_and_gate(spark):
    good = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1.0, 2.0, 1.0, 2.0, 5)], "ticker string, date date, open double, high double, low double, close double, volume bigint")
    bad = good.unionByName(good).unionByName(spark.createDataFrame([("", None, -1.0, 1.0, 2.0, None, -5)], good.schema))
    assert quality.expectations(good, quality.OHLCV).where("not success").count() == 0
    got = {r["rule"]: r.failed for r in quality.expectations(bad, quality.OHLCV).where("not success").collect()}
    assert got == {"ticker_not_empty": 1, "date_not_null": 1, "close_not_null": 1, "open_positive": 1, "close_positive": 1, "volume_not_negative": 1, "high_at_least_low": 1, "high_at_least_close": 1, "low_at_most_open": 1, "low_at_most_close": 1, "key_unique": 1}
    quality.gate(quality.expectations(good, quality.OHLCV), "silver")
    with pytest.raises(ContractError, match="ohlcv.has_close"):
        quality.gate(quality.expectations(good.drop("close"), quality.OHLCV), "silver")
    report = quality.report(quality.expectations(bad, quality.OHLCV), "x", F.lit(NOW), bad).first()
    assert (report.record_count, report.error_count, report.success) == (3, 11, False)


def test_sentiment_gate(spark):
    schema = "article_id string, ticker string, sentiment_label string, sentiment_score double, confidence_score double, model_version string"
    ok = spark.createDataFrame([("1", "A", "positive", 0.5, 0.9, "v1")], schema)
    no = spark.createDataFrame([("1", "", "great", 2.0, 1.2, "v1")], schema)
    assert quality.expectations(ok, quality.SENTIMENT).where("not success").count() == 0
    assert quality.expectations(no, quality.SENTIMENT).where("not success").count() == 4


def test_reconciliation_sees_a_swap(spark):
    a, b = spark.createDataFrame([("A", 1), ("B", 1)], "k string, d int"), spark.createDataFrame([("A", 1), ("C", 1)], "k string, d int")
    assert rows(quality.key_differences(a, b, ["k", "d"]), "side") == [("extra", 1, ["C|1"]), ("missing", 1, ["B|1"])]
    assert rows(quality.drop_ratio(a, b.limit(1), ["k", "d"])) == [(2, 1, 0.5, False)]
    assert rows(quality.drop_ratio(a.limit(0), b.limit(0), ["k"])) == [(0, 0, 0.0, True)]
    assert rows(quality.orphans(b, a, ["k"]).select("k")) == [("C",)]


@pytest.mark.parametrize("start,end,want", [("2024-01-05", "2024-01-08", 1), ("2024-01-05", "2024-01-05", 0), ("2024-01-01", "2024-01-15", 10), ("2024-01-10", "2024-01-05", 0)])
def test_business_days(spark, start, end, want):
    assert spark.range(1).select(quality.business_days(F.lit(start).cast("date"), F.lit(end).cast("date"))).first()[0] == want


def test_realtime_report_fails_on_coverage_and_volume(spark):
    c = spark.createDataFrame([("A", dt.datetime(2024, 1, 5, 9, 59), 1.0, 2.0, 1.0, 2.0, 100), ("A", dt.datetime(2024, 1, 5, 9, 59), 1.0, 2.0, 1.0, 2.0, 100)], "ticker string, minute_ts timestamp_ntz, open double, high double, low double, close double, volume bigint")
    got = {r.check: r.success for r in quality.realtime_report(c, 403, F.lit(NOW)).collect()}
    assert got == {"duplicate_keys": False, "rows_out_of_hours": True, "broken_bars": True, "age_minutes": True, "coverage": False}
    other = c.limit(1).withColumn("volume", F.lit(1000).cast("long"))
    assert quality.cross_source_volume(c.limit(1), other, ["ticker"]).first().success is False


def test_signal_precedence_and_session_status(spark):
    s = spark.createDataFrame([("A", 1, 0, 1, 0, 9, 1, 1.0, 0.0), ("B", 0, 0, 0, 0, 9, 1, 0.0, 0.0), ("C", 0, 0, 0, 0, 1, 1, 2.0, 1.0), ("D", 0, 0, 0, 0, 1, 1, 0.0, 1.0)], "ticker string, breakout_flag int, breakdown_flag int, overbought_flag int, oversold_flag int, volume long, volume_sma_20 double, macd double, macd_signal double".replace("volume_sma_20 double", "volume_sma_20 long"))
    assert rows(marts.signal_scan(s).select("ticker", "signal"), "ticker") == [("A", "breakout"), ("B", "volume_spike"), ("C", "macd_positive")]
    assert marts.signal_scan(s, order=marts.SNAPSHOT_ORDER).where("ticker = 'A'").first().signal == "overbought"
    for clock, want in (("2024-01-05 09:00", "OPEN"), ("2024-01-05 12:00", "LUNCH"), ("2024-01-05 14:50", "CLOSING"), ("2024-01-06 10:00", "CLOSED")):
        assert spark.range(1).select(marts.session_status(F.lit(clock).cast("timestamp"))).first()[0] == want


def test_the_cycle_summary_reads_evaluated_rules_once(spark):
    from tidemill.plans import realtime

    x = realtime.r5_r9_cycle_summary(spark, "/root/testdata/sf0.001")
    assert "lineitem" not in x._jdf.queryExecution().toString() and x.count() == 1


def test_layers_are_reconciled_in_one_aggregate_by_key(spark):
    day = lambda n: f"2024-01-{n:02d}"
    frame = lambda *v: spark.createDataFrame([(k, d) for k, d in v], "ticker string, d string").select("ticker", F.to_date("d").alias("date"))
    raw, clean_ = frame(("a", day(1)), ("a", day(1)), ("b", day(2)), (None, day(2)), ("c", day(3))), frame(("a", day(1)), ("b", day(2)), (None, day(2)))
    gold = frame(("a", day(1)), ("a", day(1)), (None, day(2)), ("z", day(4)))
    x = quality.layer_counts(raw, clean_, gold, ["ticker", "date"], "date").first()
    assert tuple(x)[:8] == (4, 3, 3, 4, 1, 1, 1, 1) and str(x.newest) == day(4)
    assert tuple(quality.layer_counts(raw.limit(0), clean_.limit(0), gold.limit(0), ["ticker"], "date").first()) == (0,) * 8 + (None,)
    index = raw.withColumnRenamed("ticker", "index_code")
    pages = spark.createDataFrame([("1", "u", "T", "2024-01-03"), ("1", "u", "T", "2024-01-03"), ("2", None, "T", "2024-01-02")], "article_id string, url string, ticker string, published_at string")
    r = quality.reconciliation((raw, clean_, gold), (index, index, index), (pages, pages.limit(0), pages), F.lit("2024-01-05").cast("date"))
    got = {v.check: (v.value, v.success) for v in r.collect()}
    assert got["bars_raw_to_clean"] == (0.25, False) and got["bars_same_count"] == (-1.0, False) and got["bars_same_keys"] == (2.0, False) and got["bars_keys_once"] == (1.0, False)
    assert got["bars_fresh"] == (1.0, True) and got["index_same_keys"] == (0.0, True) and got["index_keys_once"] == (1.0, False)
    assert got["articles_traceable"] == (1.0, False) and got["articles_keys_once"] == (1.0, False) and got["articles_fresh"] == (2.0, True) and len(got) == 14
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def test_violations_work_the_mart_out_once(spark):
    x = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 3.0), (None, 1, -1.0)], "ticker string, date_id int, v double")
    mart = x.mapInArrow(lambda batches: batches, x.schema)
    r = quality.violations(mart, (("positive", "v < 0"), ("key_not_null", "ticker is null")))
    assert sorted(rows(r)) == [("key_not_null", 1), ("key_unique", 1), ("positive", 1)]
    assert r._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("MapInArrow") == 1
    assert sorted(rows(quality.violations(mart.where("v > 9"), (("positive", "v < 0"),)))) == [("key_unique", 0), ("positive", 0)]
