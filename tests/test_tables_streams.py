import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemill.operators import clean, facts
from tidemill.schemas import SILVER_OHLCV
from tidemill.sources import tables
from tidemill.streaming import ticks as st

D = dt.date


def test_drifting_sources_unite(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([("A", "2024-01-01", "1.5", "oops")], "Symbol string, Date string, Close string, Volume string").write.parquet(a)
    spark.createDataFrame([("B", D(2024, 1, 2), 2.0, 7)], "ticker string, date date, close double, vol long").write.parquet(b)
    x = tables.read_drifting(spark, [a, b], SILVER_OHLCV, clean.OHLCV_ALIASES)
    assert rows(x.select("ticker", "date", "close", "volume", "open"), "ticker") == [("A", D(2024, 1, 1), 1.5, None, None), ("B", D(2024, 1, 2), 2.0, 7, None)]


def test_many_drifting_paths_are_one_scan_a_layout(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    kinds = [{"Symbol": "A", "Close": "1.5"}, {"ticker": "B", "close": 2.0}, {"ticker": "C", "close": 3.0, "vol": 7}]
    paths = []
    for i in range(600):
        where = tmp_path / f"day={i}"
        where.mkdir()
        pq.write_table(pa.table({k: [v] for k, v in kinds[i % 3].items()}), where / "part-0.parquet")
        (where / "_SUCCESS").write_text("")
        paths.append(str(where) if i % 2 else f"file://{where}/part-0.parquet")
    read, calls = type(spark.read).parquet, []
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *p, **k: calls.append(p) or read(self, *p, **k))
    x = tables.read_drifting(spark, paths, SILVER_OHLCV, clean.OHLCV_ALIASES)
    assert len(calls) == 3 and sorted(p for c in calls for p in c) == sorted(paths)
    got = x.groupBy("ticker").agg(F.count("*").alias("n"), F.sum("close").alias("c"), F.sum("volume").alias("v"))
    assert rows(got, "ticker") == [("A", 200, 300.0, None), ("B", 200, 400.0, None), ("C", 200, 600.0, 1400)]
    with pytest.raises(ValueError):
        tables.read_drifting(spark, [], SILVER_OHLCV)
    (tmp_path / "empty").mkdir()
    assert tables.path_layouts(spark, [paths[1], "nosuch://x/y", str(tmp_path / "empty")]) == [[paths[1]], ["nosuch://x/y"], [str(tmp_path / "empty")]]


def test_monthly_write_replaces_touched_months_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    x = spark.createDataFrame([("A", D(2024, 1, 1), 1), ("A", D(2024, 2, 1), 2)], "ticker string, date date, v int")
    tables.write_monthly(x, path, "date")
    tables.write_monthly(x.where("v = 2").withColumn("v", F.lit(9)), path, "date")
    assert rows(tables.read_keyed(spark, path).select("date", "v", "year", "month"), "date") == [(D(2024, 1, 1), 1, 2024, 1), (D(2024, 2, 1), 9, 2024, 2)]
    tables.write_snapshot(x, str(tmp_path / "s"), "2024-03-01")
    tables.write_snapshot(x.limit(1), str(tmp_path / "s"), "2024-03-01")
    assert spark.read.parquet(str(tmp_path / "s")).count() == 1


def test_merge_scope_and_reports(spark, tmp_path):
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert rows(tables.merged(old, new, ["k"]), "k") == [(1, "a"), (2, "c"), (3, "d")]
    kept, manifest = tables.rescope(old, spark.createDataFrame([(1,)], "k int"), "t", "k")
    assert rows(kept) == [(1, "a")] and rows(manifest) == [("t", 2, 1, 1)]
    f = tmp_path / "tickers.csv"
    f.write_text("No,SYMBOL\n1,vcb\n2,FPT\n3,vcb\n4,\n")
    assert rows(tables.read_tickers(spark, str(f))) == [("FPT",), ("VCB",)]


def test_datasets_round_trip(spark, tmp_path):
    x = spark.createDataFrame([(1, ["a"], "train"), (2, [], "test")], "id int, tags array<string>, split string")
    tables.write_datasets(x, str(tmp_path / "d"))
    assert spark.read.json(str(tmp_path / "d" / "json")).count() == 2 and spark.read.csv(str(tmp_path / "d" / "csv"), header=True).count() == 2
    tables.write_bundle({"one": x, "two": x}, str(tmp_path / "b"))
    assert spark.read.json(str(tmp_path / "b" / "two")).count() == 2


def tick(symbol, second, price, volume):
    return json.dumps({"data": {"symbol": symbol, "price": price, "volume": volume, "time": str(1704074400 + second)}})


@pytest.fixture
def feed(tmp_path):
    src = tmp_path / "in"
    src.mkdir()

    def put(name, lines):
        (tmp_path / name).write_text("\n".join(lines))
        (tmp_path / name).rename(src / name)

    return src, put


def test_stream_equals_batch_and_takes_late_ticks(spark, tmp_path, feed):
    src, put = feed
    raw, states, ck = (str(tmp_path / n) for n in ("raw", "states", "ck"))
    first = [tick("a", s, 10.0 + s % 7, 5) for s in range(0, 150, 10)]
    late = [tick("a", 5, 99.0, 1), "no json", tick("b", 70, 3.0, 2)]

    def run():
        q = st.land_ticks(st.parsed_ticks(st.message_stream(spark, str(src), files_per_trigger=1)), raw, states, ck).trigger(availableNow=True).start()
        q.awaitTermination(120)

    put("1.json", first)
    run()
    put("2.json", late)
    run()
    batch = facts.vwap(facts.merge_states(facts.minute_states(st.parsed_ticks(spark.read.text(str(src))))))
    names = ["ticker", "minute_ts", "open", "high", "low", "close", "volume", "traded_value", "trades", "session_vwap"]
    want = rows(batch.select(*names), "ticker", "minute_ts")
    assert rows(st.vwap_view(spark, states).select(*names), "ticker", "minute_ts") == want and len(want) == 4
    for _ in range(2):
        st.replay(spark, raw, states, "2024-01-01")
        assert rows(st.vwap_view(spark, states).select(*names), "ticker", "minute_ts") == want


def test_candle_corrections_converge(spark, tmp_path, feed):
    src, put = feed
    path, ck = str(tmp_path / "c"), str(tmp_path / "ck")
    one = lambda c: json.dumps({"symbol": "a", "resolution": "1", "open": 1, "high": 9, "low": 1, "close": c, "volume": 5, "time": "1704074400"})
    for i, close in enumerate((2, 3)):
        put(f"{i}.json", [one(close), json.dumps({"symbol": "a", "resolution": "5", "close": 1})])
        q = st.land_candles(st.parsed_candles(st.message_stream(spark, str(src))), path, ck, now=lambda: F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert spark.read.parquet(path).count() == 2
    assert rows(st.newest_candles(spark, path).select("ticker", "close")) == [("A", 3.0)]


def test_a_replay_that_stops_leaves_the_states_of_before(spark, tmp_path, feed, monkeypatch):
    src, put = feed
    raw, states, ck = (str(tmp_path / n) for n in ("raw", "states", "ck"))

    def run(name, lines):
        put(name, lines)
        q = st.land_ticks(st.parsed_ticks(st.message_stream(spark, str(src))), raw, states, ck).trigger(availableNow=True).start()
        q.awaitTermination(120)

    see = lambda: rows(st.merged_minutes(spark, states), "ticker", "minute_ts", "data_source")
    batch = lambda: rows(facts.merge_states(facts.minute_states(st.parsed_ticks(spark.read.text(str(src))))), "ticker", "minute_ts", "data_source")
    run("1.json", [tick("a", s, 10.0 + s % 7, 5) for s in range(0, 150, 10)])
    run("2.json", [tick("a", 5, 99.0, 1), tick("b", 70, 3.0, 2)])
    switch = st.switch_pointer
    for name in ("switch_pointer", "switch_pointer"):
        monkeypatch.setattr(st, name, lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):  # the new partials are written, the switch isn't made
            st.replay(spark, raw, states, "2024-01-01")
        assert see() == batch()
    monkeypatch.setattr(facts, "minute_states", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        st.replay(spark, raw, states, "2024-01-01")
    monkeypatch.undo()
    assert st.switch_pointer is switch and see() == batch()
    st.replay(spark, raw, states, "2024-01-01")
    assert see() == batch()
    assert st.current_states(spark, states).count() == len(batch())  # one partial a minute now
    run("3.json", [tick("a", 7, 1.0, 1), tick("a", 100000, 5.0, 1)])  # late ticks after the replay, and another day
    assert see() == batch()
    st.replay(spark, raw, states, "2024-01-02")
    st.replay(spark, raw, states, "2024-01-01")
    assert see() == batch() and st.current_states(spark, states).count() == len(batch())


def test_lag_of_a_running_stream(spark, tmp_path, feed):
    src, put = feed
    for i in range(3):
        put(f"{i}.json", [tick("a", i, 1.0, 1)])
    log = st.ProgressLog()
    spark.streams.addListener(log)
    try:
        q = st.message_stream(spark, str(src), files_per_trigger=1).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        spark._jsc.sc().listenerBus().waitUntilEmpty()
        got = log.lag(spark, str(q.id)).orderBy("batch_id").collect()
        assert [r.batch_id for r in got][:3] == [0, 1, 2]
        assert [r.committed_offset for r in got][:3] == [0, 1, 2] and all(r.end_offset >= r.committed_offset and r.lag == r.end_offset - r.committed_offset for r in got)
        assert got[-1].lag == 0
    finally:
        spark.streams.removeListener(log)
    kafka = {"sources": [{"description": "KafkaV2[Subscribe[t]]", "endOffset": {"t": {"0": 5, "1": 7}}, "latestOffset": {"t": {"0": 9, "1": 7, "2": 4}}}]}
    assert st.offset_rows(kafka) == [("KafkaV2[Subscribe[t]]", "t-0", 9, 5), ("KafkaV2[Subscribe[t]]", "t-1", 7, 7), ("KafkaV2[Subscribe[t]]", "t-2", 4, None)]


def test_candle_messages_are_written_compressed(spark):
    from pathlib import Path

    from tidemill import storage
    from tidemill.plans import continuous

    shared, d = Path(storage.shared_dir(spark).removeprefix("file:")), "/root/testdata/sf0.001"
    before = set(shared.glob("candle-messages-*"))
    n = continuous.t4_corrected_candles(spark, d).count()
    (made,) = set(shared.glob("candle-messages-*")) - before
    files = [f for f in made.iterdir() if f.name.startswith("part-")]
    assert n == continuous.daily_bars(spark, d).count() and spark.read.text(str(made)).count() > 2 * n
    assert files and sum(f.stat().st_size for f in files) < 75 * 2 * n  # a message has about 160 characters
