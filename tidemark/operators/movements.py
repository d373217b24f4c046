"""Hire / transfer / termination events from consecutive snapshots (M1-M4).

Per key, ``lag``/``lead`` over its periods; the global next period comes from
the broadcast period sequence, a distinct over the raw period column. Each row
yields zero to two events (an ``explode`` of optional events, kept in generated
code), so the three event kinds come out of one scan of the snapshots, one
shuffle by key and one scan of the period column.

What stands above the events runs in the tasks of that shuffle too (joins, the
map side of a count, which may hold nearly as many groups as there are events).
So its partitions are many by number: left to AQE they are merged to as many as
there are cores, and a task's memory grows with the input.

Semantics (defaults follow the reference):

* HIRE — the key's first period.
* TRANSFER — a tracked attribute differs from the key's previous *seen*
  period, compared with ``!=`` (a change to or from null is not a transfer
  unless ``null_safe=True``).
* TERMINATION — present in a period, absent in the next existing period;
  dated that next period, "to" attributes null; nothing after the last period.
* ``rehire=True``: a return after a gap is a HIRE rather than a comparison
  with the last period seen before the gap.

Input must have one row per key and period (deduplicate with
``latest_per_key`` first); otherwise lag/lead compare duplicates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.compare import any_changed
from tidemark.functions.rows import emit
from tidemark.operators.periods import period_sequence

HIRE, TRANSFER, TERMINATION = "HIRE", "TRANSFER", "TERMINATION"

# Fixed value: the shuffle by key has at least so many tasks for each core.
WAVES = 4


def _by_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` dealt by key to a number of partitions that AQE keeps."""
    spark = rows.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), WAVES * spark.sparkContext.defaultParallelism)
    return rows.repartition(n, *keys)


def movements(snapshots: DataFrame, keys: Sequence[str], period_col: str,
              tracked: Sequence[str], rehire: bool = False, null_safe: bool = False,
              event_col: str = "event_type", from_prefix: str = "from_",
              periods: DataFrame | None = None) -> DataFrame:
    """``periods``: the raw period column; without it the snapshots are read twice."""
    keys, tracked = list(keys), list(tracked)
    seq = period_sequence(snapshots if periods is None else periods, period_col).select(
        period_col, "_prev", "_next")
    s = _by_key(snapshots.select(*keys, period_col, *tracked).join(seq, period_col), keys)
    w = Window.partitionBy(*keys).orderBy(period_col)
    prev_seen = F.lag(period_col).over(w)
    next_seen = F.lead(period_col).over(w)
    prev_vals = [F.lag(t).over(w) for t in tracked]
    s = s.select(
        *keys, period_col, *tracked, "_next",
        prev_seen.alias("_prev_seen"), next_seen.alias("_next_seen"),
        *[v.alias(f"_p_{t}") for v, t in zip(prev_vals, tracked)],
        F.col("_prev").alias("_prev_global"),
    )
    first_seen = F.col("_prev_seen").isNull()
    if rehire:
        first_seen = first_seen | (F.col("_prev_seen") != F.col("_prev_global"))
    changed = any_changed([F.col(t) for t in tracked], [F.col(f"_p_{t}") for t in tracked],
                          null_safe=null_safe)
    is_transfer = ~first_seen & changed
    gone = F.col("_next").isNotNull() & (
        F.col("_next_seen").isNull() | (F.col("_next_seen") != F.col("_next")))

    def event(period, kind, before, after):
        fields = [period.alias(period_col), F.lit(kind).alias(event_col)]
        for t, b, a in zip(tracked, before, after):
            fields += [b.alias(f"{from_prefix}{t}"), a.alias(t)]
        return F.struct(*fields)

    types = {f.name: f.dataType for f in snapshots.schema.fields}
    nulls = [F.lit(None).cast(types[t]) for t in tracked]
    now = [F.col(t) for t in tracked]
    before = [F.col(f"_p_{t}") for t in tracked]
    return emit(s, keys, [
        F.when(first_seen, event(F.col(period_col), HIRE, nulls, now)),
        F.when(is_transfer, event(F.col(period_col), TRANSFER, before, now)),
        F.when(gone, event(F.col("_next"), TERMINATION, now, nulls)),
    ])


def hires(mv: DataFrame, event_col: str = "event_type") -> DataFrame:
    return mv.where(F.col(event_col) == HIRE)


def transfers(mv: DataFrame, event_col: str = "event_type") -> DataFrame:
    return mv.where(F.col(event_col) == TRANSFER)


def terminations(mv: DataFrame, event_col: str = "event_type") -> DataFrame:
    return mv.where(F.col(event_col) == TERMINATION)


def movements_from_history(dim: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                           rehire: bool = False, null_safe: bool = False,
                           start_col: str = "__START_AT", end_col: str = "__END_AT",
                           period_col: str = "period", event_col: str = "event_type",
                           from_prefix: str = "from_") -> DataFrame:
    """The same events, derived from type-2 history instead of every snapshot.

    Within a version the tracked values do not change, so events can only
    happen where versions start or end: the first version of a key starts
    with a HIRE; a later one with a TRANSFER when a tracked value differs
    from the previous version (or a HIRE after a gap with ``rehire``); a
    version ending at a period where no version of the key starts ends with
    a TERMINATION. The dimension may track more columns than ``tracked``.
    Work is proportional to the number of versions, not of snapshot rows,
    so it suits a dimension kept up to date incrementally.
    """
    keys, tracked = list(keys), list(tracked)
    w = Window.partitionBy(*keys).orderBy(start_col)
    prev_end = F.lag(end_col).over(w)
    s = dim.select(*keys, *tracked, start_col, end_col, prev_end.alias("_prev_end"),
                   F.lead(start_col).over(w).alias("_next_start"),
                   *[F.lag(t).over(w).alias(f"_p_{t}") for t in tracked])
    first = F.col("_prev_end").isNull()
    hire = first | (F.col("_prev_end") != F.col(start_col)) if rehire else first
    changed = any_changed([F.col(t) for t in tracked], [F.col(f"_p_{t}") for t in tracked],
                          null_safe=null_safe)
    gone = F.col(end_col).isNotNull() & (
        F.col("_next_start").isNull() | (F.col("_next_start") != F.col(end_col)))

    def event(period, kind, before, after):
        fields = [period.alias(period_col), F.lit(kind).alias(event_col)]
        for t, b, a in zip(tracked, before, after):
            fields += [b.alias(f"{from_prefix}{t}"), a.alias(t)]
        return F.struct(*fields)

    types = {f.name: f.dataType for f in dim.schema.fields}
    nulls = [F.lit(None).cast(types[t]) for t in tracked]
    now = [F.col(t) for t in tracked]
    before = [F.col(f"_p_{t}") for t in tracked]
    return emit(s, keys, [
        F.when(hire, event(F.col(start_col), HIRE, nulls, now)),
        F.when(~hire & changed, event(F.col(start_col), TRANSFER, before, now)),
        F.when(gone, event(F.col(end_col), TERMINATION, now, nulls)),
    ])
