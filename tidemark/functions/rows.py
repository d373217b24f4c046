"""Emit zero or more output rows per input row, inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def emit(df: DataFrame, keep: Sequence[str | Column], options: Sequence[Column]) -> DataFrame:
    """For each row, one output row per non-null struct in ``options``.

    ``options`` are ``when(cond, struct(...))`` columns with the same struct
    type. ``explode`` + a null filter stays in generated code, unlike a
    ``filter`` with a lambda, which is evaluated row by row.
    """
    keep = [F.col(c) if isinstance(c, str) else c for c in keep]
    names = [k._jc.toString() for k in keep]
    out = df.select(*keep, F.explode(F.array(*options)).alias("_emit"))
    return out.where(F.col("_emit").isNotNull()).select(*[F.col(f"`{n}`") for n in names], "_emit.*")
