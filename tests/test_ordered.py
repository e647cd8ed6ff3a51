import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemill import storage
from tidemill.operators import indicators as ind
from tidemill.operators import ordered, resume
from tidemill.sources import versions

D = dt.date(2024, 1, 1)


def test_running_ids_are_those_of_the_window(spark):
    r = random.Random(1)
    x = spark.createDataFrame([(r.choice("abc"), r.randint(0, 50), i) for i in range(500)] + [(None, None, 500)], "k string, n int, i int")
    for order in ((F.desc("n"), F.col("k"), F.col("i")), (F.col("k").asc_nulls_last(), F.desc("i"))):
        got = ordered.running_ids(x, *order, parts=7)
        assert sorted(rows(got), key=str) == sorted(rows(ind.running_ids(x, *order)), key=str)
        assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    assert ordered.running_ids(x.limit(0), "i").count() == 0
    assert [v.row_id for v in ordered.running_ids(x.limit(3), "i", parts=40).orderBy("i").collect()] == [1, 2, 3]


def bars(spark, seed=2, nulls=False, days=400):
    r = random.Random(seed)
    data = []
    for ticker, n in (("HOT", days), ("B", 30), ("C", 1), ("D", 2), ("E", 90)):
        close = 50.0
        for i in range(n):
            close *= 1 + r.uniform(-0.04, 0.04)
            data.append((ticker, D + dt.timedelta(days=i), close, None if nulls and (r.random() < 0.3 or (ticker == "E" and i < 40)) else close, r.randint(0, 900)))
    return spark.createDataFrame(data, "ticker string, date date, c double, close double, volume bigint").withColumns({"open": F.col("c") * 0.99, "high": F.col("c") * 1.01, "low": F.col("c") * 0.98})


@pytest.mark.parametrize("parts", [1, 4, 23])
def test_scan_equals_the_fold(spark, parts):
    x = bars(spark)
    fold = {(v.ticker, v.date): v for v in ind.exponential_means(x).collect()}
    got = ordered.exponential_means(x.repartition(6), parts=parts).collect()
    assert len(got) == len(fold)
    for v in got:
        for c in ("ema_12", "ema_26", "macd", "macd_signal"):
            assert abs(v[c] - fold[v.ticker, v.date][c]) < 1e-9
    assert ordered.exponential_means(x.limit(0), parts=parts).count() == 0


def test_scan_keeps_its_value_over_nulls(spark):
    x = bars(spark, nulls=True)
    one, many = (ordered.exponential_means(x, parts=n).orderBy("ticker", "date").collect() for n in (1, 31))
    known: dict = {}
    for a, b in zip(one, many, strict=True):
        if a.close is not None:
            y = known.get(a.ticker)
            known[a.ticker] = a.close if y is None else y + 2 / 13 * (a.close - y)
        want = known.get(a.ticker)
        for v in (a, b):
            assert (v.ema_12 is None) == (want is None) and (want is None or abs(v.ema_12 - want) < 1e-9)
    assert any(v.ema_12 is None for v in one)


@pytest.mark.parametrize("parts", [1, 9])
def test_running_sums_are_those_of_the_window(spark, parts):
    x = bars(spark).withColumn("month", F.month("date"))
    want = ind.session_running(x.withColumn("v", F.col("close") * F.col("volume")), ["ticker", "month"], "date", "v", "volume").select("ticker", "date", F.round("session_value", 4), F.col("session_volume").cast("double"))
    got = ordered.running_sums(x, ["ticker", "month"], ["date"], {"value": F.col("close") * F.col("volume"), "n": F.col("volume")}, parts)
    assert sorted(rows(got.select("ticker", "date", F.round("value", 4), "n"))) == sorted(rows(want))


def test_resumed_indicators_are_those_of_the_whole_history(spark):
    x = bars(spark)
    names = ["ticker", "date", "history", "previous_close", "price_change", "pct_change", "sma_20", "bb_std_20", "volume_sma_20", "rsi_14", "bb_upper", "value", "breakout_flag", "ema_12", "ema_26", "macd", "macd_signal"]
    whole = ind.exponential_means(ind.price_indicators(x), keep=names[2:13])
    whole = {(v.ticker, v.date): v for v in whole.select(*names).collect()}
    state = resume.no_state(spark)
    for k, (a, b) in enumerate([(0, 5), (5, 25), (25, 28), (28, 200)]):
        piece = x.where((F.col("date") >= F.lit(D) + F.expr(f"interval {a} day")) & (F.col("date") < F.lit(D) + F.expr(f"interval {b} day")))
        piece = piece if k else piece.where("ticker <> 'E'")  # a ticker that comes later
        state = storage.materialize(resume.advanced(state, piece), "state")
    rest = x.where(F.col("date") >= F.lit(D) + F.expr("interval 150 day"))  # days before the state's are left out
    got = resume.resumed(state, rest).select(*names).collect()
    assert len(got) == 200 and {v.ticker for v in got} == {"HOT"}
    held = {v.ticker: v for v in state.collect()}
    assert {t: v.history for t, v in held.items()} == {"HOT": 200, "B": 30, "C": 1, "D": 2, "E": 85} and len(held["HOT"].tail) == 20
    for v in got:
        for c in names:
            a, b = v[c], whole[v.ticker, v.date][c]
            assert a == b or abs(a - b) < 1e-9, c
    assert resume.resumed(state, x.limit(0)).count() == 0 and resume.advanced(state, x.limit(0)).count() == 5


def month_rows(spark, *data):
    return spark.createDataFrame([(t, int(d.replace("-", "")), dt.date.fromisoformat(d), v) for t, d, v in data], "ticker string, date_id int, trading_date date, v int")


def test_keys_are_replaced_by_one_switch(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    see = lambda: sorted((r.ticker, str(r.trading_date), r.v) for r in versions.read_current(spark, root).collect())
    with pytest.raises(ValueError):
        versions.read_current(spark, root)
    versions.replace_keys(month_rows(spark, ("A", "2024-01-01", 1), ("B", "2024-01-02", 2), ("A", "2024-02-01", 3)), root)
    january = storage.read_pointer(spark, root)[1]["months"]["2024-01"]
    new = month_rows(spark, ("A", "2024-02-01", 9), ("C", "2024-02-05", 8), ("A", "2024-03-01", 7))
    for _ in range(2):
        versions.replace_keys(new, root)
        want = [("A", "2024-01-01", 1), ("A", "2024-02-01", 9), ("A", "2024-03-01", 7), ("B", "2024-01-02", 2), ("C", "2024-02-05", 8)]
        assert see() == want
    assert storage.read_pointer(spark, root)[1]["months"]["2024-01"] == january  # not rewritten
    number = versions.replace_keys(new.limit(0), root)
    assert number == 3 and see() == want
    first, switch = versions.read_current(spark, root), versions.switch_pointer
    monkeypatch.setattr(versions, "switch_pointer", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):  # stops before the switch
        versions.replace_keys(month_rows(spark, ("A", "2024-02-01", 0)), root)
    assert see() == want

    def late(s, r, n, c):  # another writer publishes meanwhile
        switch(s, r, n, storage.read_pointer(s, r)[1])
        switch(s, r, n, c)

    monkeypatch.setattr(versions, "switch_pointer", late)
    with pytest.raises(RuntimeError):
        versions.replace_keys(month_rows(spark, ("A", "2024-02-01", 0)), root)
    assert see() == want and first.count() == 5
    assert len(versions.vacuum(spark, root)) == 3 and see() == want


def test_pointers_go_up_by_one(spark, tmp_path):
    root = str(tmp_path / "p")
    assert storage.read_pointer(spark, root) == (0, None)
    storage.switch_pointer(spark, root, 0, {"a": 1})
    with pytest.raises(RuntimeError):
        storage.switch_pointer(spark, root, 0, {"a": 2})
    storage.switch_pointer(spark, root, 1, ["ü"])
    assert storage.read_pointer(spark, root) == (2, ["ü"])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def test_a_state_moves_on_by_one_shuffle_without_a_join_or_windows_of_indicators(spark):
    x = bars(spark)
    state = storage.materialize(resume.advanced(resume.no_state(spark), x.where(F.col("date") < F.lit(D) + F.expr("interval 40 day"))), "state")
    p = plan(resume.advanced(state, x))
    assert p.count("Exchange") == 1 and "Join" not in p and "FlatMapGroups" not in p and "stddev" not in p and "MapInArrow" in p


def test_folds_don_t_hang_on_where_batches_end(spark):
    x = bars(spark).unionByName(bars(spark, 3).withColumn("ticker", F.lit(None).cast("string"))).dropDuplicates(["ticker", "date"])
    first = x.where(F.col("date") < F.lit(D) + F.expr("interval 33 day"))
    found = []
    for n in ("10000", "7"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
        state = storage.materialize(resume.advanced(resume.no_state(spark), first), "state")
        found.append([sorted(map(str, d.collect())) for d in (ind.exponential_means(x), state, resume.resumed(state, x))])
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found[0] == found[1] and len(found[0][0]) == x.count()
