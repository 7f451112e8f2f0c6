"""The folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or a folder of our own where it is unset and all tasks run on this machine."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = getattr(spark, "_shared_dir", None) or tempfile.mkdtemp(prefix="spark-")
        spark._shared_dir = found
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "part", count: Column | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: nothing of its plan is left, and ``release`` frees the disk.

    With ``count``, the rows for which it holds are counted while they are written: ``.counted``.
    """
    path, schema = new_path(df.sparkSession, name), df.schema
    seen = None
    if count is not None:
        seen = Observation()
        df = df.observe(seen, F.count_if(count).alias("n"))
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(schema).parquet(path)
    out.written_path = path
    out.counted = seen.get["n"] if seen else None
    return out


def release(*tables: DataFrame) -> None:
    """Deletes what ``written`` wrote, once nothing reads it again."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.written_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
