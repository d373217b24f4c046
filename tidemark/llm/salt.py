"""Joins in which one key may hold much of the larger side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dealt_join(many: DataFrame, few: DataFrame, on: list[str], by: str, parts: int) -> DataFrame:
    """Inner join on ``on``. Rows of ``many`` are dealt to ``parts`` parts of
    their key by a hash of ``by``; each row of ``few`` goes to every part, so
    ``few`` should have few rows a key and few columns."""
    dealt = many.withColumn("_part", F.pmod(F.xxhash64(by), F.lit(parts)).cast("int"))
    copied = few.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return dealt.join(copied, [*on, "_part"]).drop("_part")
