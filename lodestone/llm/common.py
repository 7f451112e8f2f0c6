"""Helpers shared by the operators: shared folder, Arrow batches, crc32, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``, or one of our own where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = getattr(spark, "_lodestone_dir", None) or tempfile.mkdtemp(prefix="spark-")
        spark._lodestone_dir = found
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there, so that lineage ends."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Like ``cut``, as compressed columns: less disk for wide or repetitive rows, but no order or partitioning is kept."""
    path = new_path(df.sparkSession, "part")
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def release(df: DataFrame) -> None:
    """Deletes what ``stored`` wrote, once nothing reads it again."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(df.stored_path)
    path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def binary_array(data: np.ndarray | bytes, offsets: np.ndarray) -> pa.Array:
    """Arrow binary column: value i is data[offsets[i]:offsets[i + 1]]."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, "i4")), pa.py_buffer(data)])


def fixed_binary(rows: np.ndarray) -> pa.Array:
    """Arrow binary column with each row of a two-dimensional array as one value."""
    rows = np.ascontiguousarray(rows)
    width = rows.dtype.itemsize * rows.shape[1]
    return binary_array(rows.tobytes(), np.arange(len(rows) + 1, dtype="i8") * width)


def from_fixed(column: pa.Array, dtype: str) -> np.ndarray:
    """The reverse of fixed_binary."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1) if len(column) else np.empty((0, 1), dtype)


def key_runs(batches: Iterable[pa.RecordBatch], keys: list[str], most: int = 20_000) -> Iterator[pa.Table]:
    """Tables that hold whole runs of equal keys from batches sorted by those keys.

    Many short runs come in one table; a run is never divided.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows < most:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        last = [t.column(k)[-1].as_py() for k in keys]
        same = np.ones(t.num_rows, bool)
        for k, v in zip(keys, last):
            same &= t.column(k).to_numpy() == v
        end = int(np.argmax(same))  # the last key's run starts here, for rows are sorted
        if end:
            yield t.slice(0, end)
            t = t.slice(end)
        held = t.to_batches()
        rows = t.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def mix64(x: np.ndarray) -> np.ndarray:
    """A finalising 64-bit mixer (the constants are those of a published one)."""
    x = x.astype("u8", copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def starts_of(*columns: np.ndarray) -> np.ndarray:
    """Where a new run of equal values begins, in sorted columns."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def root_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 with links a-b: the smallest node of each one's component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before, label)
        label = label[label]
        if (label == before).all():
            break
    return label


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows ``(node, component)``, component the smallest node.

    Alternates links to the smallest neighbour among the larger ones and among the smaller ones, as
    published for map-reduce, until no edge changes; the number of rounds grows with the logarithm of
    the longest chain.  No vertex's neighbours are gathered: only minima are, which Spark combines
    before each shuffle.  Nodes without an edge get no row.
    """
    spark = edges.sparkSession
    e = cut(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(rounds):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
        e = cut(small.where("a <> b").distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("the components did not settle")
    return spark.createDataFrame([], "node long, component long") if not seen[0] else e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
