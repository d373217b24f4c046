"""Exact distinct counts that merge (G3, V1): bitmaps of whole-number keys.

``count(DISTINCT)`` over a year has to see every row of the year. A bitmap of the
keys of each period is small, is written once with the period, and any set of
periods is answered by OR-ing theirs. Spark cuts keys into buckets of 32,768, so
a key set is as many rows as it has buckets, no row grows with the input, and a
hot period or key costs no more than its bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_bitmaps(df: DataFrame, key: str, by: Sequence[str], active: Column | None = None) -> DataFrame:
    """``by``, bucket and bitmap of the keys (non-negative whole numbers) of each
    group; rows without a key, or not ``active``, are left out."""
    rows = df.where(F.col(key).isNotNull())
    rows = rows if active is None else rows.where(active)
    return rows.groupBy(*by, F.bitmap_bucket_number(F.col(key)).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key))).alias("bitmap"))


def merged_counts(bitmaps: DataFrame, by: Sequence[str], alias: str = "n_distinct") -> DataFrame:
    """Distinct keys of coarser groups ``by``, from the bitmaps of finer ones."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias(alias))
