"""Work that follows a total order without one task seeing all of it: row ids, running sums, recursions.

Rows are dealt to range partitions and written once in order. What a partition needs to know of those before it is one
small row a partition, put together on the driver: as many numbers as there are partitions, whatever the table holds.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.schemas import ddl
from tidemill.storage import materialize

_PART = 33  # monotonically_increasing_id holds the place in a partition in the bits below


def _parts(df: DataFrame, parts: int | None) -> int:
    return parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _in_order(df: DataFrame, order: Sequence[Column | str], parts: int | None) -> DataFrame:
    return df.repartitionByRange(_parts(df, parts), *order).sortWithinPartitions(*order)


def running_ids(df: DataFrame, *order: Column | str, parts: int | None = None) -> DataFrame:
    """row_id from 1 by a total order over the whole frame.

    Each partition counts its own rows; the offset of a partition is the sum of the counts before it. Rows that are
    equal in the order get ids next to each other in no defined sequence, and share a partition.
    """
    x = materialize(_in_order(df, order, parts).withColumn("_o_id", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_o_id", _PART).cast("int")
    counts = dict(x.groupBy(part.alias("part")).count().collect())
    before = np.concatenate([[0], np.cumsum([counts.get(p, 0) for p in range(max(counts, default=0) + 1)])])
    offsets = F.expr(f"array({','.join(f'{n}L' for n in before)})")
    place = F.col("_o_id").bitwiseAND(F.lit((1 << _PART) - 1))
    return x.withColumn("row_id", F.get(offsets, part) + place + 1).drop("_o_id")


class Sums(NamedTuple):
    """Running sums of a number of columns; nulls add nothing."""

    n: int

    def start(self, x: Sequence[float]) -> np.ndarray:
        return np.zeros(self.n)

    def run(self, x: np.ndarray, state: np.ndarray) -> np.ndarray:
        return state + np.cumsum(x, axis=0)

    def carry(self, steps: int, state: np.ndarray) -> np.ndarray:
        return state

    def carried(self, steps: Column, state: list[Column]) -> list[Column]:
        return state


class Means(NamedTuple):
    """Exponential means of two spans and of their difference: y = a x + (1 - a) y before, the first y its x.

    A step is an affine map, so k steps change a state that began elsewhere by the k-th power of its matrix alone.
    """

    fast: int = 12
    slow: int = 26
    signal: int = 9

    def _decay(self) -> tuple[float, float, float]:
        return tuple(1 - 2 / (n + 1) for n in self)

    def start(self, x: Sequence[float]) -> np.ndarray:
        return np.array([x[0], x[0], 0.0])

    def run(self, x: np.ndarray, state: np.ndarray) -> np.ndarray:
        mean = lambda y, before, span: pd.Series(np.append(before, y)).ewm(span=span, adjust=False).mean().to_numpy()[1:]
        fast, slow = mean(x[:, 0], state[0], self.fast), mean(x[:, 0], state[1], self.slow)
        return np.stack([fast, slow, mean(fast - slow, state[2], self.signal)], axis=1)

    def _power(self, steps, state):
        p, q, r = self._decay()
        power = lambda b: F.pow(F.lit(b), steps) if isinstance(steps, Column) else b**steps
        pk, qk, rk = power(p), power(q), power(r)
        return [pk * state[0], qk * state[1], rk * state[2] + (1 - r) * (p * (pk - rk) / (p - r) * state[0] - q * (qk - rk) / (q - r) * state[1])]

    def carry(self, steps: int, state: np.ndarray) -> np.ndarray:
        return np.array(self._power(steps, state))

    def carried(self, steps: Column, state: list[Column]) -> list[Column]:
        return self._power(steps, state)


def _local(scan, n_in: int, n_keys: int):
    """Scans sorted batches of one partition as if its first key began there; steps counts the values of that first key's rows."""

    def fold(batches):
        key, state, first = None, None, None
        steps = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.schema.names
            keys = [batch.column(i) for i in range(n_keys)]
            x = np.stack([batch.column(n_keys + i).cast(pa.float64()).to_numpy(zero_copy_only=False) for i in range(n_in)], axis=1)
            codes = [k.dictionary_encode(null_encoding="encode").indices.to_numpy() for k in keys]
            cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in codes], axis=0)) + 1
            out, count = np.full((len(x), len(scan.start(np.zeros(n_in)))), np.nan), np.full(len(x), -1, np.int64)
            for a, b in zip([0, *cuts], [*cuts, len(x)], strict=True):
                at = tuple(k[int(a)].as_py() for k in keys)
                if key is None or at != key:
                    first = key is None
                    key, state, steps = at, None, 0
                known = np.isfinite(x[a:b]).all(axis=1) if not isinstance(scan, Sums) else np.ones(b - a, bool)
                values = np.nan_to_num(x[a:b][known]) if isinstance(scan, Sums) else x[a:b][known]
                part = np.full((b - a, out.shape[1]), np.nan)
                if len(values):
                    begin = scan.start(values[0]) if state is None else state
                    part[known] = scan.run(values, begin)
                rank = np.cumsum(known)
                if state is not None:
                    part[rank == 0] = state
                held = np.maximum.accumulate(np.where(known, np.arange(b - a), -1))
                part[held >= 0] = part[held[held >= 0]]
                out[a:b] = part
                if first:
                    count[a:b] = steps + rank
                steps += int(rank[-1])
                if not np.isnan(part[-1]).any():
                    state = part[-1].copy()
            cols = [*(batch.column(i) for i in range(len(names))), *(pa.array(c, from_pandas=True) for c in out.T), pa.array(np.where(count < 0, 0, count), mask=count < 0)]
            yield pa.RecordBatch.from_arrays(cols, [*names, *(f"_s_{i}" for i in range(out.shape[1])), "_s_steps"])

    return fold


def segmented_scan(df: DataFrame, scan: Sums | Means, keys: Sequence[str], order: Sequence[str], values: Sequence[Column], names: Sequence[str], parts: int | None = None) -> DataFrame:
    """df with the running values of a scan for each key in order, whatever number of rows a key has.

    Rows go once to range partitions of (keys, order), which split a key with many rows. Each partition is scanned
    batch by batch as if its first key began there, and written. One row a partition then tells what its last key ends
    with and how far its first key came; composing these in turn gives the state that each partition should have
    begun with, and rows of a continued first key are corrected by what that difference has become after their steps.
    Sums skip nulls; Means keep the last value where the input is null, and are null before the first.
    """
    n_out = len(scan.start(np.zeros(max(len(values), 1))))
    own = df.columns
    x = df.select(*[F.col(k).alias(f"_s_key{i}") for i, k in enumerate(keys)], *[v.cast("double").alias(f"_s_in{i}") for i, v in enumerate(values)], *own)
    x = _in_order(x, [*keys, *order], parts)
    schema = T.StructType([*x.schema.fields, *ddl(", ".join([*(f"_s_{i} double" for i in range(n_out)), "_s_steps bigint"])).fields])
    x = x.mapInArrow(_local(scan, len(values), len(keys)), schema).withColumn("_s_id", F.monotonically_increasing_id())
    x = materialize(x, "scanned").withColumn("_s_part", F.shiftright("_s_id", _PART).cast("int"))

    key = F.struct(*[f"_s_key{i}" for i in range(len(keys))])
    inputs = F.array(*[f"_s_in{i}" for i in range(len(values))])
    state = F.array(*[f"_s_{i}" for i in range(n_out)])
    found = x.groupBy("_s_part").agg(
        F.min_by(key, "_s_id").alias("first"), F.max_by(key, "_s_id").alias("last"), F.max_by(state, "_s_id").alias("state"), F.max_by(F.struct("_s_steps"), "_s_id").alias("steps"),
        F.min_by(inputs, F.when(F.col("_s_steps") == 1, F.col("_s_id"))).alias("x"),
    ).orderBy("_s_part").collect()

    begins, before, held = [], None, None
    for r in found:
        local = None if None in r.state else np.array(r.state)
        started = None if r.x is None else scan.start(r.x)
        goes_on = before is not None and r.first == before and held is not None
        if goes_on:
            shift = held - (started if started is not None else 0.0)
            begins.append((r["_s_part"], [float(v) for v in held], [float(v) for v in shift]))
        if r.steps[0] is None:  # the last key began in this partition
            held = local
        elif goes_on:
            held = held if started is None else local + scan.carry(r.steps[0], shift)
        else:
            held = local
        before = r.last
    spark = df.sparkSession
    starts = spark.createDataFrame(begins, "_s_begin int, _s_held array<double>, _s_shift array<double>")
    x = x.join(F.broadcast(starts), F.col("_s_part") == F.col("_s_begin"), "left")
    moved = scan.carried(F.col("_s_steps"), [F.get("_s_shift", F.lit(i)) for i in range(n_out)])
    on = F.col("_s_begin").isNotNull() & F.col("_s_steps").isNotNull()
    out = [F.when(on & (F.col("_s_steps") == 0), F.get("_s_held", F.lit(i))).when(on, F.col(f"_s_{i}") + moved[i]).otherwise(F.col(f"_s_{i}")).alias(name) for i, name in enumerate(names)]
    return x.select(*[c for c in own if c not in names], *out)


def exponential_means(bars: DataFrame, key: str = "ticker", time: str = "date", value: str = "close", parts: int | None = None) -> DataFrame:
    """W6, M7 for histories of any length: bars with ema_12, ema_26, macd and macd_signal; `time` is unique in a key.

    indicators.exponential_means takes a key's history as one Arrow group, which suits sessions; this suits ticks.
    """
    x = segmented_scan(bars, Means(), [key], [time], [F.col(value)], ["ema_12", "ema_26", "macd_signal"], parts)
    return x.withColumn("macd", F.col("ema_12") - F.col("ema_26"))


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, Column], parts: int | None = None) -> DataFrame:
    """W7 for sessions of any length: df with the sums of each key's rows up to its own, as doubles."""
    return segmented_scan(df, Sums(len(sums)), keys, order, list(sums.values()), list(sums), parts)
