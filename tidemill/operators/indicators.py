"""Per-entity indicators over one window of time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from tidemill.schemas import ddl


def by_time(key: str | list[str] = "ticker", time: str = "date") -> WindowSpec:
    """The one window that all indicators of a key share, so that Spark sorts once."""
    return Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(time)


def last_rows(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(1 - n, 0)


def rolling(value: Column, w: WindowSpec, n: int, of=F.avg) -> Column:
    """An aggregate of the last n rows, null before there are n."""
    return F.when(F.row_number().over(w) >= n, of(value).over(last_rows(w, n)))


def change(value: str, w: WindowSpec) -> Column:
    """Difference to the row before; 0 in the first."""
    return F.coalesce(F.col(value) - F.lag(value).over(w), F.lit(0.0))


def pct_change(value: str, w: WindowSpec) -> Column:
    """The same in percent of the row before; 0 in the first and after a 0."""
    before = F.lag(value).over(w)
    return F.coalesce(F.try_divide(F.col(value) - before, before) * 100, F.lit(0.0))


def ratio(a: Column, b: Column) -> Column:
    """a / b as floating point has it, where Spark's own is null or fails: 0 / 0 is NaN, other numbers over 0 are infinite."""
    over_zero = F.when(a > 0, F.when(F.isnan(a), a).otherwise(float("inf"))).when(a < 0, float("-inf")).when(a == 0, float("nan"))
    return F.coalesce(F.try_divide(a, b), F.when(b == 0, over_zero))


def rsi(delta: Column, w: WindowSpec, n: int = 14) -> Column:
    """M5: 100 - 100 / (1 + mean gain / mean loss) of the last n rows; 100 where there was no loss; null before n rows."""
    gain = F.avg(F.greatest(delta, F.lit(0.0))).over(last_rows(w, n))
    loss = F.avg(F.greatest(-delta, F.lit(0.0))).over(last_rows(w, n))
    return F.when(F.row_number().over(w) >= n, F.when(loss == 0, 100.0).otherwise(100 - 100 / (1 + gain / loss)))


def flag(condition: Column) -> Column:
    """M8: 1 or 0; unknown is 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def price_indicators(bars: DataFrame, key: str = "ticker", time: str = "date") -> DataFrame:
    """Changes, SMA20, Bollinger bands, RSI14, volume mean, value and flags, in one sort."""
    w = by_time(key, time)
    x = bars.withColumns({
        "previous_close": F.coalesce(F.lag("close").over(w), F.col("close")), "price_change": change("close", w), "pct_change": pct_change("close", w),
        "history": F.row_number().over(w), "sma_20": rolling(F.col("close"), w, 20), "volume_sma_20": rolling(F.col("volume"), w, 20),
        "bb_std_20": rolling(F.col("close"), w, 20, F.stddev_samp),
    })
    x = x.withColumns({
        "rsi_14": rsi(F.col("price_change"), w), "bb_middle": F.col("sma_20"),
        "bb_upper": F.col("sma_20") + 2 * F.col("bb_std_20"), "bb_lower": F.col("sma_20") - 2 * F.col("bb_std_20"),
        "value": (F.col("open") + F.col("high") + F.col("low") + F.col("close")) / 4 * F.col("volume"),
    })
    return x.withColumns({
        "overbought_flag": flag(F.col("rsi_14") > 70), "oversold_flag": flag(F.col("rsi_14") < 30),
        "breakout_flag": flag(F.col("close") > F.col("bb_upper")), "breakdown_flag": flag(F.col("close") < F.col("bb_lower")),
    })


def whole_keys(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Sorted batches as tables that hold each of their keys whole; what a batch ends in waits for the next one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and held[0].column(key)[0].as_py() != batch.column(key)[0].as_py():
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        codes = batch.column(key).dictionary_encode(null_encoding="encode").indices.to_numpy()
        before = np.flatnonzero(codes != codes[-1])
        if len(before):
            cut = int(before[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            held, batch = [], batch.slice(cut)
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def runs(rows: pa.Table, key: str) -> np.ndarray:
    """The number of each row's key, from 0, in a table that is sorted by it."""
    codes = rows.column(key).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    return np.concatenate([[0], np.cumsum(codes[1:] != codes[:-1])])


def means_by_run(x: np.ndarray, run: np.ndarray, span: int) -> np.ndarray:
    """The exponential mean of each run of rows, which begins with the run's first value."""
    return pd.Series(x).groupby(run, sort=False).ewm(span=span, adjust=False).mean().to_numpy()


def by_key(df: DataFrame, key: str, time: str) -> DataFrame:
    """df with each key's rows in one partition, in order; after windows by the same key and time it costs nothing."""
    return df.repartition(key).sortWithinPartitions(key, time)


def exponential_means(bars: DataFrame, key: str = "ticker", time: str = "date", value: str = "close", keep: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """ema_12, ema_26, macd and macd_signal by the recursion y = a x + (1 - a) y before, y of the first row its x.

    The recursion is the one indicator that a window frame can't hold. Tasks fold batches of many keys at once; a key's
    history (a row a session) has to fit in one of them. Further columns in keep pass through it, so that nothing has
    to be joined to them again; after windows by the same key it needs no shuffle of its own. Only rows that satisfy
    `where` come out, of means over all rows.
    """
    out = list(dict.fromkeys([key, time, *keep]))
    schema = T.StructType([*bars.select(*out).schema.fields, *ddl("ema_12 double, ema_26 double, macd double, macd_signal double").fields])
    every = where is None

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_keys(batches, key):
            run, x = runs(rows, key), rows.column(value).to_pandas().to_numpy(dtype=float, na_value=np.nan)
            fast, slow = (means_by_run(x, run, n) for n in (12, 26))
            means = (fast, slow, fast - slow, means_by_run(fast - slow, run, 9))
            leave = None if every else rows.column("_out").combine_chunks()
            rows = rows.select(out)
            for name, mean in zip(("ema_12", "ema_26", "macd", "macd_signal"), means, strict=True):
                rows = rows.append_column(name, pa.array(mean, pa.float64(), from_pandas=True))
            yield from (rows if leave is None else rows.filter(leave)).to_batches()

    x = bars if every else bars.withColumn("_out", F.coalesce(where, F.lit(False)))
    x = x.select(*dict.fromkeys([*out, value]), *([] if every else ["_out"]))
    return by_key(x, key, time).mapInArrow(fold, schema)


def trailing_band(candles: DataFrame, key: str = "ticker", time: str = "minute_ts", n: int = 20) -> DataFrame:
    """The latest row of each entity beside the n rows before it: volume ratio, high and low band."""
    w = by_time(key, time)
    before = w.rowsBetween(-n, -1)
    x = candles.withColumns({
        "volume_avg": F.avg("volume").over(before), "band_high": F.max("high").over(before), "band_low": F.min("low").over(before),
        "_n": F.row_number().over(Window.partitionBy(key).orderBy(F.col(time).desc())),
    })
    return x.where("_n = 1").drop("_n").withColumn("volume_ratio", F.try_divide(F.col("volume").cast("double"), F.col("volume_avg")))


def session_running(x: DataFrame, keys: list[str], time: str, value: str, volume: str) -> DataFrame:
    """Value and volume summed from the session's start; keys name the session."""
    w = by_time(keys, time).rowsBetween(Window.unboundedPreceding, 0)
    return x.withColumns({"session_value": F.sum(value).over(w), "session_volume": F.sum(volume).over(w)})


def running_ids(df: DataFrame, *order: Column) -> DataFrame:
    """Ids by a total order over the whole frame; for results of bounded size, as it is one task's sort."""
    return df.withColumn("row_id", F.row_number().over(Window.orderBy(*order)))
