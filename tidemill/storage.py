"""The folder that driver and executors share: intermediate tables, and pointers that name a table's valid version."""

from __future__ import annotations

import json
import tempfile
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the checkpoint folder set on the context.

    Where neither is set, only a session in one process may have a temporary folder: elsewhere executors could not read it.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemill-"))
        base = spark.sparkContext.getCheckpointDir()
    return base


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read back: cuts lineage and survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, root: str) -> list[int]:
    p, fs = _path(spark, f"{root}/_pointers")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit()) if fs.exists(p) else []


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def read_pointer(spark: SparkSession, root: str) -> tuple[int, Any]:
    """The number and contents of a table's newest pointer; (0, None) if it has none."""
    found = _versions(spark, root)
    if not found:
        return 0, None
    p, fs = _path(spark, f"{root}/_pointers/{found[-1]:012d}")
    stream = fs.open(p)
    try:
        return found[-1], json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def switch_pointer(spark: SparkSession, root: str, number: int, contents: Any) -> None:
    """Makes contents the valid pointer in one step, a rename; number is that of the pointer it was made from.

    Readers see the old pointer or the new one, never a part. If another writer has switched since, it fails and
    nothing changes. The rename has to be atomic in the table's file system.
    """
    final, fs = _path(spark, f"{root}/_pointers/{number + 1:012d}")
    beside, _ = _path(spark, f"{root}/_pointers/.{uuid.uuid4().hex}")
    if number != (_versions(spark, root) or [0])[-1]:
        raise RuntimeError(f"{root} has changed since pointer {number}")
    out = fs.create(beside, False)
    out.write(json.dumps(contents).encode())
    out.close()
    jvm = spark._jvm
    kinds = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    kinds[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE  # fails where the name is taken
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(beside, final, kinds)
