"""Table sinks and guards.

Tables are parquet folders (or catalog tables when a name without a slash
is given). A table being read is never overwritten in place: ``write_new``
writes a fresh version folder and returns its path.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _is_path(name: str) -> bool:
    return "/" in name or ":" in name


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S7."""
    return spark.read.parquet(name) if _is_path(name) else spark.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    """S13."""
    if not _is_path(name):
        return spark.catalog.tableExists(name)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(name)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def write_table(df: DataFrame, name: str, mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """S8 (overwrite) / S12 (append)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if _is_path(name):
        w.parquet(name)
    else:
        w.saveAsTable(name)


def write_new(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """Write to a fresh version folder under ``root`` and return its path."""
    path = f"{root.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"
    write_table(df, path, "overwrite", partition_by)
    return path


def append_once(df: DataFrame, name: str, keys: Sequence[str]) -> int:
    """Append only rows whose keys are not in the table yet (idempotent).

    Returns the number of rows appended.
    """
    spark = df.sparkSession
    if table_exists(spark, name):
        existing = read_table(spark, name).select(*keys)
        new = df.join(existing, list(keys), "left_anti")
        # Materialise before appending (the anti join reads the target) into
        # the shared checkpoint folder, so the lineage survives lost executors.
        from tidemark.session import scratch_root
        scratch_root(spark)
        new = new.checkpoint(eager=True)
    else:
        new = df
    n = new.count()
    if n:
        write_table(new, name, "append")
    return n


def register_views(frames: dict[str, DataFrame]) -> None:
    """Expose DataFrames to SQL users under names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """S15."""
    return spark.createDataFrame([], schema)
