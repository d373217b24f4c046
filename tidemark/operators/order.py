"""A total order as data (O1, O3): each row's global rank, without one big sort.

Rows are dealt by ranges of the order, so partition i holds only rows before
those of partition i+1, and numbered within it; a row's rank is its number plus
the rows of all earlier partitions. These counts, one a partition, are all that
meets in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_dir


def ranked(df: DataFrame, order_by: Sequence[Column], name: str = "rank", partitions: int | None = None) -> DataFrame:
    """``df`` with its rank (from 1) by ``order_by``; make the order total for
    ranks that do not depend on the run. A partition holds its share of the rows
    if the order tells them apart; equal rows are never split."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{scratch_dir(spark, 'ranked')}/rows"
    dealt = df.repartitionByRange(n, *order_by).withColumn("_part", F.spark_partition_id())
    # written, so that counts and ranks see the same ranges
    dealt.write.parquet(path)
    rows = spark.read.schema(dealt.schema).parquet(path)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    number = F.row_number().over(Window.partitionBy("_part").orderBy(*order_by))
    out = rows.withColumn("_number", number).join(F.broadcast(before), "_part")
    return out.select(*df.columns, (F.col("_before") + F.col("_number")).alias(name))
