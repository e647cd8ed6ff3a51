"""Helpers shared by the operators of this subpackage: shared storage, word hashing, components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xC2B2AE3D27D4EB4F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the checkpoint folder set on the context.

    Where neither is set, only a session in one process may have a temporary folder: elsewhere executors could not read it.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemill-"))
        base = spark.sparkContext.getCheckpointDir()
    return base


def materialize(df: DataFrame, hint: str, scratch: list[str] | None = None) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage and survives lost executors.

    The files stay until the folder is cleared, as checkpoint files do by default, or until `discard` removes those
    whose paths were added to scratch.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{hint}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if scratch is not None:
        scratch.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, scratch: list[str], clean: bool = True) -> None:
    """Remove tables that no plan reads any more, and let Spark's cleaner remove shuffle files that nothing refers to."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while scratch:
        path = jvm.org.apache.hadoop.fs.Path(scratch.pop())
        path.getFileSystem(conf).delete(path, True)
    if clean:
        gc.collect()
        jvm.System.gc()


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << int(n - 1).bit_length()
            with np.errstate(over="ignore"):
                both = []
                for b in (self.base, self.inverse):
                    x = np.full(size, b, np.uint64)
                    x[0] = 1
                    both.append(np.multiply.accumulate(x))
            self.up, self.down = both
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where words start and end."""
    blank = np.ones(len(text) + 2, bool)
    blank[1:-1] = _BLANK[np.frombuffer(text, np.uint8)]
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    return edge[::2], edge[1::2]


def span_hashes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp hashes of byte spans of one text, from one prefix sum."""
    n = len(text)
    up, down = _BYTES.upto(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """One 64-bit hash per word."""
    starts, ends = word_spans(text)
    return span_hashes(text, starts, ends)


class Sequence:
    """Rabin-Karp hashes of any run of words of one text."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        up, self.down = _WORDS.upto(self.n + 1)
        self.total = np.zeros(self.n + 1, np.uint64)
        np.cumsum(words * up[: self.n], out=self.total[1:])

    def windows(self, k: int) -> np.ndarray:
        """Hash of every window of k words; none if the text is shorter."""
        m = self.n - k + 1
        if m < 1:
            return np.zeros(0, np.uint64)
        return mix((self.total[k:] - self.total[:m]) * self.down[:m])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each run of words [start, end)."""
        return mix((self.total[ends] - self.total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def pieces(batches, rows: int = 1000):
    """Batches cut into pieces, so that what a task holds in Python doesn't follow the session's batch size.

    At the end the worker gives back what the task freed: Spark keeps workers, and idle ones would hold on to it.
    """
    try:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)
    finally:
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)


def text_blocks(texts: list[bytes], most: int = 250_000) -> Iterator[list[bytes]]:
    """Texts in order, about `most` bytes at a time: what is done once a block need not be done once a text."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def extended(schema: T.StructType, more: str) -> T.StructType:
    """A schema with further fields, given as DDL."""
    return T.StructType([*schema.fields, *T._parse_datatype_string(more).fields])


def row_key(*cols: str):
    """Names a row by its contents: rows that repeat whole share a key, rows that only share an id do not."""
    return F.xxhash64(*cols)


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Connected components: (node, label), label the smallest node reachable; nodes without an edge don't appear.

    Large-star and small-star rounds: every node hands its smallest neighbour to its larger, then to its
    smaller ones, until each node points at the root alone. A round is two shuffles over the edges; what
    grows large is split by the join, and each round is written to the shared folder, the round before it removed.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    old: list[str] = []
    pairs, before = materialize(pairs, "edges", old), None
    for _ in range(rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")
        )
        made: list[str] = []
        pairs = materialize(small.select("e.u", "e.v").where("u <> v").distinct(), "edges", made)
        # A star forest has one edge for each node and no node both below and above; then a round changes nothing.
        after = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        discard(pairs.sparkSession, old, clean=False)
        old = made
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
