"""JSON landing files -> bronze rows.

Landing layout: one folder per period and entity, ``<base>/<period>/<entity>/``
(or a partitioned write, ``<base>/<entity>/period=<period>/``). Bronze keeps
every declared field as text (no inference, S3), moves any other field to a
``_rescued_data`` JSON object (S2), and adds ingest time, source file and run
id (S4). Schemas are always declared, never inferred: a field that is null
in every row is absent from the JSON and would vanish from an inferred schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"

# The fields of each landing entity, in file order.
ENTITY_FIELDS = {
    "departments": ["department_id", "name", "cost_centre", "parent_department_id"],
    "job_roles": ["role_id", "title", "band", "function", "job_family"],
    "employees": ["employee_id", "full_name", "email", "gender", "hire_date", "termination_date",
                  "department_id", "role_id", "manager_id", "nationality"],
    "contracts": ["contract_id", "employee_id", "contract_type", "start_date", "end_date"],
    "compensation": ["employee_id", "salary", "currency", "effective_date"],
    "payroll_events": ["employee_id", "period", "gross_pay", "deductions", "net_pay"],
}


def string_schema(fields: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType(), True) for f in fields])


def parse_with_rescue(text: Column, fields: Sequence[str], rescued: str = RESCUED) -> list[Column]:
    """Declared fields as text plus the rescued remainder, from a JSON text column.

    Unknown keys are kept as a JSON object of text values; a line that is not
    a JSON object is rescued whole (as the raw text).
    """
    fields = list(fields)
    # One parse per line: the whole object as a text->text map; declared
    # fields are looked up in it, the rest is rescued.
    every = F.from_json(text, T.MapType(T.StringType(), T.StringType()))
    declared = F.array(*[F.lit(f) for f in fields]) if fields else F.array().cast("array<string>")
    # The lambda filter is only evaluated for lines that do carry unknown
    # keys (the test is plain generated code), the rare case in practice.
    has_extra = F.size(F.array_except(F.map_keys(every), declared)) > 0
    extra = F.map_filter(every, lambda k, v: ~F.array_contains(declared, k))
    rescue = (F.when(every.isNull() & text.isNotNull(), text)
              .when(has_extra, F.to_json(extra)))
    return [F.try_element_at(every, F.lit(f)).alias(f) for f in fields] + [rescue.alias(rescued)]


# What makes a landed row the newer one: its file's time, then the ingest, then
# the file's name. Files ingested by one run keep the order they were written in.
NEWEST = ["_file_modified_at", "_ingested_at", "_source_file_name"]


def file_columns() -> list[Column]:
    """Path and time of the file a row is read from."""
    return [F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_modification_time").alias("_modified")]


def with_audit(df: DataFrame, run_id: str) -> DataFrame:
    """Ingest time, source file and its time, run id (one per run, not per
    row), for rows that carry ``file_columns``."""
    return (df.withColumn("_ingested_at", F.current_timestamp())
            .withColumn("_source_file_name", F.col("_path"))
            .withColumn("_file_modified_at", F.col("_modified"))
            .withColumn("_pipeline_run_id", F.lit(run_id)).drop("_path", "_modified"))


def bronze_schema(entity: str) -> T.StructType:
    """Columns of an entity's bronze table, which is partitioned by the period of
    the landing folder and the run. Declared, as a table without rows has no files."""
    fields = [*ENTITY_FIELDS[entity], RESCUED]
    times = [T.StructField("_ingested_at", T.TimestampType()), T.StructField("_source_file_name", T.StringType()),
             T.StructField("_file_modified_at", T.TimestampType())]
    return T.StructType([*string_schema(fields).fields, *times, *string_schema(PARTITIONS).fields])


PARTITIONS = ["_landed", "_pipeline_run_id"]


def read_bronze(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """The bronze table of an entity; filters on ``_landed`` (the period of the
    landing folder) and ``_pipeline_run_id`` open only the folders that match."""
    return spark.read.schema(bronze_schema(entity)).parquet(path)


def landing_glob(base: str, entity: str, layout: str = "{base}/*/{entity}/") -> str:
    return layout.format(base=base.rstrip("/"), entity=entity)


def read_landing(spark: SparkSession, base: str, entity: str, fields: Sequence[str] | None = None,
                 run_id: str = "batch", layout: str = "{base}/*/{entity}/") -> DataFrame:
    """Batch read of every landed file of an entity into bronze rows."""
    fields = ENTITY_FIELDS[entity] if fields is None else fields
    raw = spark.read.text(landing_glob(base, entity, layout))
    rows = raw.select(*parse_with_rescue(F.col("value"), fields), *file_columns())
    return with_audit(rows, run_id)


def export_snapshot(df: DataFrame, base: str, entity: str, period: str) -> str:
    """Write one period's snapshot of an entity as JSON lines (overwrite)."""
    path = f"{base.rstrip('/')}/{period}/{entity}"
    df.write.mode("overwrite").json(path)
    return path


def export_by_period(df: DataFrame, base: str, entity: str, period_col: str = "period") -> str:
    """S11, all periods in one distributed write: ``<base>/<entity>/period=<p>/``."""
    path = f"{base.rstrip('/')}/{entity}"
    df.write.mode("overwrite").partitionBy(period_col).json(path)
    return path
