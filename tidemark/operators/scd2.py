"""Type-2 history from periodic full snapshots.

A dimension is the tracked columns plus two validity columns: ``__START_AT``
(the period the version was first seen) and ``__END_AT`` (the period of the
first snapshot that no longer shows it; null while current). A key missing
from a snapshot is closed at that snapshot.

* ``apply_snapshot`` folds one snapshot into a dimension: one full outer
  join with the snapshot on the keys, in which only open versions match.
* ``replay_from`` replays a stored dimension from one period on.
* ``replay_snapshots`` builds the same result for all snapshots in one pass:
  versions are islands of consecutive periods with equal values
  (gaps-and-islands with ``lag``/``lead`` over each key's periods), so there
  is no loop over periods. Both expect one row per key and period (see
  ``latest_per_key``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.compare import same_values
from tidemark.functions.rows import emit
from tidemark.operators.periods import period_sequence

START = "__START_AT"
END = "__END_AT"


def current(dim: DataFrame, end_col: str = END) -> DataFrame:
    """Rows still valid."""
    return dim.where(F.col(end_col).isNull())


def as_of(dim: DataFrame, period, start_col: str = START, end_col: str = END) -> DataFrame:
    """Versions valid at ``period``."""
    p = period if isinstance(period, Column) else F.lit(period)
    return dim.where((F.col(start_col) <= p) & (F.col(end_col).isNull() | (F.col(end_col) > p)))


def apply_snapshot(dim: DataFrame, snapshot: DataFrame, keys: Sequence[str],
                   tracked: Sequence[str], as_of_period, start_col: str = START,
                   end_col: str = END) -> DataFrame:
    """Fold one full snapshot into a type-2 dimension.

    One full outer join in which only open versions can match; closed ones come
    through it unmatched and unchanged. ``dim`` stands in the plan once, so a
    chain of folds grows by one join per snapshot.
    """
    keys, tracked = list(keys), list(tracked)
    p = as_of_period if isinstance(as_of_period, Column) else F.lit(as_of_period)
    old = dim.select(*[F.col(c).alias(f"_c_{c}") for c in keys + tracked],
                     F.col(start_col).alias("_c_start"), F.col(end_col).alias("_c_end"),
                     F.lit(True).alias("_in_c"))
    snap = snapshot.select(*[F.col(c).alias(f"_s_{c}") for c in keys + tracked],
                           F.lit(True).alias("_in_s"))
    match = F.col("_c_end").isNull()
    for k in keys:
        match = match & (F.col(f"_c_{k}") == F.col(f"_s_{k}"))
    # The as-of value is materialised as a column first (it may be a scalar
    # subquery) so it is evaluated once per row.
    j = old.join(snap, match, "full_outer").withColumn("_as_of", p)
    p = F.col("_as_of")
    in_c = F.col("_in_c").isNotNull()
    in_s = F.col("_in_s").isNotNull()
    same = in_c & in_s & same_values([F.col(f"_c_{t}") for t in tracked],
                                     [F.col(f"_s_{t}") for t in tracked])
    start_type = dim.schema[start_col].dataType
    end = F.when(F.col("_c_end").isNotNull(), F.col("_c_end")).when(~same, p.cast(start_type))
    kept = F.struct(*[F.col(f"_c_{c}").alias(c) for c in keys + tracked],
                    F.col("_c_start").alias(start_col), end.cast(start_type).alias(end_col))
    opened = F.struct(*[F.col(f"_s_{c}").alias(c) for c in keys + tracked],
                      p.cast(start_type).alias(start_col),
                      F.lit(None).cast(start_type).alias(end_col))
    return emit(j, [], [F.when(in_c, kept), F.when(in_s & ~same, opened)])


def empty_dimension(snapshot: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                    period_type: str = "string", start_col: str = START,
                    end_col: str = END) -> DataFrame:
    """A dimension with no rows and the right schema, to start a fold."""
    return snapshot.select(*keys, *tracked,
                           F.lit(None).cast(period_type).alias(start_col),
                           F.lit(None).cast(period_type).alias(end_col)).where(F.lit(False))


def replay_snapshots(snapshots: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                     period_col: str, start_col: str = START, end_col: str = END,
                     periods: DataFrame | None = None, carried: Sequence[str] = ()) -> DataFrame:
    """Type-2 history of every snapshot at once (D3); equals folding D2.

    ``periods`` holds the raw period column (``period_col``) from which the
    sequence of periods is taken; without it the snapshots are read twice.
    ``carried`` columns are not compared; a version has its first row's values.

    One shuffle by key and one sort; everything after runs on rows already in
    (key, period) order: a row opens a version when the key was absent in the
    previous existing period or a tracked value changed; it closes one when
    the next row opens one. Only first and last rows of each version are
    kept, and a version ends at the period after its last row (null if that
    row is in the latest period).
    """
    keys, tracked = list(keys), list(tracked)
    seq = period_sequence(snapshots if periods is None else periods, period_col).select(
        period_col, "_idx", "_next")
    s = snapshots.select(*keys, *tracked, *carried, period_col).join(seq, period_col)
    w = Window.partitionBy(*keys).orderBy("_idx")
    prev_idx = F.lag("_idx").over(w)
    unchanged = same_values([F.col(t) for t in tracked], [F.lag(t).over(w) for t in tracked])
    opens = prev_idx.isNull() | (prev_idx != F.col("_idx") - 1) | ~unchanged
    s = s.withColumn("_open", opens)
    s = s.withColumn("_last", F.lead("_open", 1, True).over(w))
    edges = s.where(F.col("_open") | F.col("_last"))
    edges = edges.withColumn(
        "_end", F.when(F.col("_last"), F.col("_next")).otherwise(F.lead("_next").over(w)))
    return edges.where(F.col("_open")).select(
        *keys, *tracked, *carried, F.col(period_col).alias(start_col),
        F.col("_end").alias(end_col))


def replay_from(dim: DataFrame, snapshots: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                period_col: str, since: str, before: str | None, start_col: str = START,
                end_col: str = END, periods: DataFrame | None = None) -> DataFrame:
    """``dim`` with every period from ``since`` on replayed (D3 from a period on).

    ``before`` is the last existing period under ``since`` (None: there is
    none, and all history is replayed). Versions that ended by ``before`` stay
    as they are; those open then stand in for the snapshot of ``before``, so
    work is in proportion to the open rows and the snapshots from ``since`` on,
    whatever was late, split or corrected among them. Equals a full replay.
    """
    keys, tracked = list(keys), list(tracked)
    new = snapshots.where(F.col(period_col) >= since).select(*keys, *tracked, period_col)
    later = (snapshots if periods is None else periods).select(period_col).where(
        F.col(period_col) >= since)
    if before is None:
        return replay_snapshots(new, keys, tracked, period_col, start_col, end_col, later)
    known = dim.where(F.col(start_col) <= before)
    closed = known.where(F.col(end_col) <= before)
    open_ = known.where(F.col(end_col).isNull() | (F.col(end_col) > before))
    base = open_.select(*keys, *tracked, F.lit(before).alias(period_col),
                        F.col(start_col).alias("_first"))
    rows = base.unionByName(new.withColumn("_first", F.lit(None).cast(dim.schema[start_col].dataType)))
    seq = later.unionByName(dim.sparkSession.range(1).select(F.lit(before).alias(period_col)))
    out = replay_snapshots(rows, keys, tracked, period_col, start_col, end_col, seq, ["_first"])
    out = out.withColumn(start_col, F.coalesce("_first", start_col)).drop("_first")
    return closed.select(*out.columns).unionByName(out)
