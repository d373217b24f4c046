"""Type-2 dimensions brought up to date by a batch run.

Replaying every snapshot (D3) is the simple way to build history, but it
re-reads all history on every run. Here a run finds the periods that newly
landed files touch and replays the stored dimension from the earliest of them
(``replay_from``): work in proportion to the open rows and the snapshots from
there on. Files may arrive late, in parts, in any order, or corrected; the
result equals the replay of everything. It is written to a new folder; the one
being read is never overwritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.scd2 import END, START, replay_from, replay_snapshots
from tidemark.sources.tables import write_table


def periods_of(rows: DataFrame, period_col: str = "period") -> list[str]:
    """The distinct periods of some rows, in order: one per month or day."""
    return sorted(r[0] for r in rows.select(period_col).distinct().collect() if r[0] is not None)


def update_dimension(spark: SparkSession, stored: str | None, new: str, snapshots: DataFrame, keys: Sequence[str],
                     tracked: Sequence[str], touched: Sequence[str], existing: Sequence[str],
                     period_col: str = "period", periods: DataFrame | None = None) -> str:
    """Write the dimension to ``new``, replayed over the ``stored`` one from the
    earliest of the ``touched`` periods; returns its path, which is the stored one
    if none is touched.

    ``snapshots``: one row per key and period; ``existing``: all periods there
    are now.
    """
    keys, tracked = list(keys), list(tracked)
    if stored is None:
        dim = replay_snapshots(snapshots, keys, tracked, period_col, periods=periods)
    elif not touched:
        return stored
    else:
        since = min(touched)
        before = max((p for p in existing if p < since), default=None)
        dim = replay_from(spark.read.parquet(stored), snapshots, keys, tracked, period_col, since,
                          before, periods=periods)
    write_table(dim.select(*keys, *tracked, START, END), new)
    return new
