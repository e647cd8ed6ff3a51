"""Indicators that go on from a state, so that a new day costs a day and not all of history (IO21, W1 to W7, M5 to M9)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.schemas import ddl

from . import indicators as ind
from .ordered import Means

#: Rows that the widest window looks back on; a change needs one more than its own window of 14.
TAIL = 20
_BAR = "date date, open double, high double, low double, close double, volume bigint"
STATE = f"ticker string, as_of date, history bigint, ema_12 double, ema_26 double, macd_signal double, tail array<struct<{_BAR}>>"
_FIELDS = ("date", "open", "high", "low", "close", "volume")
_MEANS = ("_e12", "_e26", "_sig")


def no_state(spark: SparkSession) -> DataFrame:
    """The state before any bar."""
    return spark.createDataFrame([], STATE)


def _going_on(close: np.ndarray, run: np.ndarray, begins: list[np.ndarray]) -> list[np.ndarray]:
    """ema_12, ema_26 and macd_signal of each run of closes, going on from one state a run, or beginning where that is null."""
    first = np.flatnonzero(np.diff(run, prepend=-1))
    starts = (close[first], close[first], np.zeros(len(first)))
    begin = np.stack([np.where(np.isnan(b), s, b) for b, s in zip(begins, starts, strict=True)])
    at, own = np.insert(run, first, run[first]), np.ones(len(run) + len(first), bool)
    own[first + np.arange(len(first))] = False  # the row before a run's first holds its state
    mean = lambda x, b, span: ind.means_by_run(np.insert(x, first, b), at, span)[own]
    scan = Means()
    fast, slow = mean(close, begin[0], scan.fast), mean(close, begin[1], scan.slow)
    return [fast, slow, mean(fast - slow, begin[2], scan.signal)]


def _column(rows: pa.Table, name: str) -> np.ndarray:
    return rows.column(name).to_pandas().to_numpy(dtype=float, na_value=np.nan)


def _means(x: DataFrame) -> DataFrame:
    """ema_12, ema_26, macd and macd_signal of each ticker's rows, going on from _e12, _e26 and _sig where these are known."""
    out = [c for c in x.columns if c not in _MEANS]
    schema = T.StructType([*x.select(*out).schema.fields, *ddl("ema_12 double, ema_26 double, macd double, macd_signal double").fields])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in ind.whole_keys(batches, "ticker"):
            run = ind.runs(rows, "ticker")
            first = np.flatnonzero(np.diff(run, prepend=-1))
            fast, slow, signal = _going_on(_column(rows, "close"), run, [_column(rows, c)[first] for c in _MEANS])
            rows = rows.select(out)
            for name, y in (("ema_12", fast), ("ema_26", slow), ("macd", fast - slow), ("macd_signal", signal)):
                rows = rows.append_column(name, pa.array(y))
            yield from rows.to_batches()

    return ind.by_key(x, "ticker", "date").mapInArrow(fold, schema)


def _with_tails(state: DataFrame, bars: DataFrame) -> DataFrame:
    """The bars after each ticker's state (_new), and the state's last rows before them; what else a state holds is on all of its ticker's rows.

    The two meet in the shuffle by ticker that the windows need, so no bar is joined.
    """
    s = state.select("*", (F.col("history") - F.size("tail")).alias("_before"))
    old = s.select("ticker", F.explode("tail").alias("_b"), "as_of", F.col("ema_12").alias("_e12"), F.col("ema_26").alias("_e26"), F.col("macd_signal").alias("_sig"), "_before")
    old = old.select("ticker", *[f"_b.{c}" for c in _FIELDS], F.lit(False).alias("_new"), "as_of", *_MEANS, "_before")
    new = bars.select("ticker", *_FIELDS, F.lit(True).alias("_new"))
    both = new.unionByName(old, allowMissingColumns=True)
    ticker = ind.by_time().rowsBetween(ind.Window.unboundedPreceding, ind.Window.unboundedFollowing)
    both = both.withColumns({c: F.max(c).over(ticker) for c in ("as_of", *_MEANS, "_before")})
    return both.where("not _new or as_of is null or date > as_of")


def resumed(state: DataFrame, bars: DataFrame) -> DataFrame:
    """All indicators of the bars after each ticker's state, as the whole history would give them.

    The state's last rows stand before the new ones for the windows and the recursions go on from its means. Bars up
    to the state's date are left out; a ticker without a state begins. Closes are not null. One shuffle by ticker.
    """
    x = ind.price_indicators(_with_tails(state, bars)).where("_new")
    x = x.withColumn("history", (F.col("history") + F.coalesce("_before", F.lit(0))).cast("long"))
    return _means(x.drop("_new", "_before", "as_of"))


def advanced(state: DataFrame, bars: DataFrame) -> DataFrame:
    """The state after the bars that follow it; tickers without new bars keep theirs. Only the new bars are read.

    A state needs no windows: a task folds its tickers' bars to one row each.
    """
    schema = ddl(STATE)
    x = _with_tails(state, bars).select("ticker", *_FIELDS, "_new", *_MEANS, "_before")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in ind.whole_keys(batches, "ticker"):
            run, new = ind.runs(rows, "ticker"), rows.column("_new").to_numpy()
            first = np.flatnonzero(np.diff(run, prepend=-1))
            size = np.diff(np.append(first, len(run)))
            held = [_column(rows, c)[first] for c in _MEANS]
            if new.any():
                some = np.unique(run[new])  # tickers with new bars, all of which follow the state's
                made = _going_on(_column(rows, "close")[new], np.searchsorted(some, run[new]), [h[some] for h in held])
                last = np.cumsum(np.bincount(run[new], minlength=len(first))[some]) - 1
                for h, y in zip(held, made, strict=True):
                    h[some] = y[last]
            before = np.nan_to_num(_column(rows, "_before")[first]).astype(np.int64)
            kept = np.minimum(size, TAIL)
            offsets = np.concatenate([[0], np.cumsum(kept)])
            at = np.repeat(first + size - kept - offsets[:-1], kept) + np.arange(offsets[-1])
            bar = rows.select(_FIELDS).take(at).to_struct_array().combine_chunks()
            tail = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), bar)
            ends = rows.select(["ticker", "date"]).take(first + size - 1).combine_chunks()
            columns = [ends.column("ticker"), ends.column("date"), before + size, *held, tail]
            yield from pa.table(columns, schema.names).to_batches()

    return ind.by_key(x, "ticker", "date").mapInArrow(fold, schema)
