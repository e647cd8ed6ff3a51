"""Tables whose partitions are replaced by one switch (IO22): delete and insert by key, readers follow a pointer.

A version is the list of folders that hold each month's rows. A write adds folders for the months it touches and
publishes the list by `switch_pointer`; a reader sees the version before or after, and a crash leaves the one before.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.storage import _path, read_pointer, switch_pointer


def _rows(spark: SparkSession, root: str, schema: T.StructType, folders: Sequence[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{root}/{f}" for f in folders))


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The newest version's rows."""
    _, version = read_pointer(spark, root)
    if version is None:
        raise ValueError(f"{root} has no version yet")
    return _rows(spark, root, T.StructType.fromJson(version["schema"]), list(version["months"].values()))


def replace_keys(new: DataFrame, root: str, keys: Sequence[str] = ("ticker", "date_id"), date: str = "trading_date") -> int:
    """IO22: rows of the keys in `new` are deleted and new's rows inserted; the number of the version that this makes.

    A key's rows all have one month, and the key decides it. Only months that new touches are read, by an anti join on
    the keys, and written; the rest of the table is carried over by name. The same rows again make an equal version,
    no rows none. Two writers at once: the one that publishes second fails and changes nothing.
    """
    spark = new.sparkSession
    number, version = read_pointer(spark, root)
    months = version["months"] if version else {}
    schema = T.StructType.fromJson(version["schema"]) if version else new.schema
    new = new.select(*schema.fieldNames()).withColumn("_month", F.date_format(date, "yyyy-MM"))
    touched = sorted(r[0] for r in new.select("_month").distinct().collect())
    if not touched:
        return number
    old = _rows(spark, root, schema, [months[m] for m in touched if m in months]).withColumn("_month", F.date_format(date, "yyyy-MM"))
    kept = old.join(new.select(*keys).distinct(), list(keys), "left_anti")
    made = f"data-{uuid.uuid4().hex}"
    kept.select(*new.columns).unionByName(new).hint("rebalance", "_month").sortWithinPartitions("_month", *keys).write.partitionBy("_month").parquet(f"{root}/{made}")
    switch_pointer(spark, root, number, {"schema": schema.jsonValue(), "months": months | {m: f"{made}/_month={m}" for m in touched}})
    return number + 1


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Removes folders that the newest version doesn't use; readers of older versions have to be done."""
    _, version = read_pointer(spark, root)
    used = {f.split("/")[0] for f in (version or {"months": {}})["months"].values()}
    p, fs = _path(spark, root)
    gone = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("data-") and s.getPath().getName() not in used]
    for path in gone:
        fs.delete(path, True)
    return [path.getName() for path in gone]
