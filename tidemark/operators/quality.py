"""Rule-checked quality log, steward review and resolution.

``quality_log`` evaluates every rule of an entity in one scan: each rule is
compiled with ``F.expr`` and a row yields one log entry per failed rule
(an ``explode`` of optional entries, kept in generated code). A rule fails when its predicate is
not true (``NOT coalesce(rule, false)``), so an unknown result counts as a
failure. A row that fails a CRITICAL rule gets only its CRITICAL entries.
Referential rules are one left join against the distinct referenced keys
(a partial aggregate, so skewed keys are reduced before the shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.rows import emit
from tidemark.operators.dedup import latest_per_key
from tidemark.sources.rules import SEVERITIES, Rule

# Fixed value: severity order, worst first.
SEVERITY_RANK = {"CRITICAL": 3, "ERROR": 2, "WARNING": 1}


def log_schema(key_name: str = "record_key") -> T.StructType:
    """The 14 columns of a quality log; the same for empty and non-empty logs."""
    s, ts, b = T.StringType(), T.TimestampType(), T.BooleanType()
    cols = [("_ingested_at", ts), ("_source_file_name", s), ("entity", s), (key_name, s),
            ("period", s), ("field", s), ("rule", s), ("severity", s), ("actual_value", s),
            ("requires_review", b), ("resolved", b), ("resolved_by", s), ("resolved_at", ts),
            ("resolution_type", s)]
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


def empty_log(spark: SparkSession, key_name: str = "record_key") -> DataFrame:
    return spark.createDataFrame([], log_schema(key_name))


def _opt(df: DataFrame, c, typ: str) -> Column:
    if c is None:
        return F.lit(None).cast(typ)
    if isinstance(c, Column):
        return c.cast(typ)
    return F.col(c).cast(typ) if c in df.columns else F.lit(None).cast(typ)


def quality_log(df: DataFrame, entity: str, rules: Sequence[Rule], key=None, period=None,
                ingested=None, source=None, refs: dict[str, DataFrame] | None = None,
                key_name: str = "record_key") -> DataFrame:
    """Log rows for every rule a row of ``df`` fails (Q2).

    ``key``/``period``/``ingested``/``source`` name (or give) the columns that
    identify the row in the log; missing ones are null. ``refs`` maps a
    referential rule's ``ref`` name to the DataFrame holding its keys.
    """
    refs = refs or {}
    rules = list(rules)
    base = df
    failed: list[Column] = []
    for i, r in enumerate(rules):
        if r.kind == "referential":
            if r.ref not in refs:
                raise KeyError(f"rule on {entity}.{r.field} needs ref '{r.ref}'")
            keys = (refs[r.ref].select(F.col(r.ref_key).alias(f"_rk{i}"))
                    .where(F.col(f"_rk{i}").isNotNull()).distinct()
                    .withColumn(f"_hit{i}", F.lit(True)))
            base = base.join(keys, base[r.field] == keys[f"_rk{i}"], "left").drop(f"_rk{i}")
            failed.append(F.col(r.field).isNotNull() & F.col(f"_hit{i}").isNull())
        else:
            failed.append(~F.coalesce(F.expr(r.rule), F.lit(False)))
    crit = [f for f, r in zip(failed, rules) if r.severity == "CRITICAL"]
    any_crit = F.lit(False)
    for c in crit:
        any_crit = any_crit | c
    entries = []
    for f, r in zip(failed, rules):
        cond = f if r.severity == "CRITICAL" else (f & ~any_crit)
        actual = F.col(r.field).cast("string") if r.field in df.columns else F.lit(None).cast("string")
        entries.append(F.when(cond, F.struct(
            F.lit(r.field).alias("field"), F.lit(r.rule).alias("rule"),
            F.lit(r.severity).alias("severity"), actual.alias("actual_value"))))
    if not entries:
        return empty_log(df.sparkSession, key_name)
    ids = base.select(
        *[F.col(c) for c in base.columns],
        _opt(base, ingested, "timestamp").alias("_q_ingested"),
        _opt(base, source, "string").alias("_q_source"),
        _opt(base, key, "string").alias("_q_key"),
        _opt(base, period, "string").alias("_q_period"))
    out = emit(ids, ["_q_ingested", "_q_source", "_q_key", "_q_period"], entries)
    return out.select(
        F.col("_q_ingested").alias("_ingested_at"), F.col("_q_source").alias("_source_file_name"),
        F.lit(entity).alias("entity"), F.col("_q_key").alias(key_name),
        F.col("_q_period").alias("period"),
        "field", "rule", "severity", "actual_value",
        F.lit(True).alias("requires_review"), F.lit(False).alias("resolved"),
        F.lit(None).cast("string").alias("resolved_by"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
        F.lit(None).cast("string").alias("resolution_type"))


def union_logs(logs: Sequence[DataFrame]) -> DataFrame:
    out = logs[0]
    for lg in logs[1:]:
        out = out.unionByName(lg)
    return out


def unresolved(log: DataFrame, severities: Sequence[str] = SEVERITIES) -> DataFrame:
    """P8 + P9: open entries of the given severities (null resolved = open)."""
    return log.where(~F.coalesce(F.col("resolved"), F.lit(False))).where(
        F.col("severity").isin(list(severities)))


def severity_rank(col: str = "severity") -> Column:
    expr = F.lit(0)
    for name, rank in SEVERITY_RANK.items():
        expr = F.when(F.col(col) == name, F.lit(rank)).otherwise(expr)
    return expr


def review(log: DataFrame, severities: Sequence[str] = SEVERITIES) -> DataFrame:
    """Open entries, worst severity first, newest first."""
    return unresolved(log, severities).orderBy(severity_rank().desc(),
                                               F.col("_ingested_at").desc_nulls_last())


def summary(log: DataFrame) -> DataFrame:
    """V2: one row of open-issue counts (total and per severity), one pass."""
    open_ = unresolved(log)
    return open_.agg(
        F.count(F.lit(1)).alias("total_issues"),
        F.count_if(F.col("severity") == "CRITICAL").alias("critical"),
        F.count_if(F.col("severity") == "ERROR").alias("errors"),
        F.count_if(F.col("severity") == "WARNING").alias("warnings"))


def resolve(log: DataFrame, resolutions: DataFrame,
            on: Sequence[str] = ("_ingested_at", "entity", "field")) -> DataFrame:
    """V3: mark entries resolved; returns a new log (nothing is updated in place).

    ``resolutions`` holds the match columns plus ``resolved_by``,
    ``resolved_at`` and ``resolution_type``. Matching is null-safe; when
    several resolutions match one entry the latest ``resolved_at`` wins.
    """
    on = list(on)
    res = latest_per_key(resolutions, on, ["resolved_at", "resolved_by", "resolution_type"],
                         drop_nulls=False)
    r = res.select(*[F.col(c).alias(f"_r_{c}") for c in on],
                   F.col("resolved_by").alias("_r_by"), F.col("resolved_at").alias("_r_at"),
                   F.col("resolution_type").alias("_r_type"), F.lit(True).alias("_r_hit"))
    cond = None
    for c in on:
        e = log[c].eqNullSafe(r[f"_r_{c}"])
        cond = e if cond is None else cond & e
    j = log.join(r, cond, "left")
    hit = F.col("_r_hit").isNotNull()
    cols = []
    for c in log.columns:
        if c == "resolved":
            cols.append(F.when(hit, F.lit(True)).otherwise(F.col(c)).alias(c))
        elif c == "resolved_by":
            cols.append(F.when(hit, F.col("_r_by")).otherwise(F.col(c)).alias(c))
        elif c == "resolved_at":
            cols.append(F.when(hit, F.col("_r_at")).otherwise(F.col(c)).alias(c))
        elif c == "resolution_type":
            cols.append(F.when(hit, F.col("_r_type")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def steward_review(log: DataFrame, show: int = 50) -> tuple[dict, DataFrame]:
    """V2: open-issue counts (one small action) and the first ``show`` open
    entries, worst first, for display."""
    counts = summary(log).first().asDict()
    return counts, review(log).limit(show)
