"""Row comparison predicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def same_values(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """True when every pair is equal, nulls equal to nulls (never null)."""
    pairs = [a.eqNullSafe(b) for a, b in zip(left, right)]
    return reduce(lambda x, y: x & y, pairs, F.lit(True))


def any_changed(now: Sequence[Column], before: Sequence[Column], null_safe: bool = False) -> Column:
    """True when some attribute differs.

    ``null_safe=False`` keeps SQL's ``!=``: a change to or from null does not
    count (it evaluates to null, which is not true).
    """
    if null_safe:
        return ~same_values(now, before)
    diffs = [F.coalesce(a != b, F.lit(False)) for a, b in zip(now, before)]
    return reduce(lambda x, y: x | y, diffs, F.lit(False))
