"""Incremental landing -> bronze ingest with Structured Streaming.

The file source lists new files each trigger and the checkpoint remembers
which were read, so running the ingest again adds nothing; a corrected file
for an old period must arrive under a new file name and is picked up as new
rows (the newest ingest then wins downstream). ``availableNow`` processes
what has landed and stops, like a scheduled batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.periods import period_from_path
from tidemark.sources.landing import (
    ENTITY_FIELDS,
    file_columns,
    landing_glob,
    parse_with_rescue,
    with_audit,
)


def landing_stream(spark: SparkSession, base: str, entity: str,
                   fields: Sequence[str] | None = None, run_id: str | None = None,
                   layout: str = "{base}/*/{entity}/",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming bronze rows of one entity."""
    fields = ENTITY_FIELDS[entity] if fields is None else fields
    # The source drops files whose time is a week older than the newest it has
    # seen; a late file copied with its old time is data like any other.
    reader = spark.readStream.format("text").option("maxFileAge", "36500d")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.load(landing_glob(base, entity, layout))
    rows = raw.select(*parse_with_rescue(F.col("value"), fields), *file_columns())
    return with_audit(rows, run_id or uuid.uuid4().hex)


def ingest_to_bronze(spark: SparkSession, base: str, entity: str, bronze_path: str,
                     checkpoint: str, fields: Sequence[str] | None = None,
                     run_id: str | None = None, layout: str = "{base}/*/{entity}/",
                     timeout_s: float | None = None, partition_by: Sequence[str] = ()) -> str:
    """Append every newly landed file to the bronze parquet table and stop.

    ``partition_by`` may name ``_landed``, the period of the landing folder."""
    rows = landing_stream(spark, base, entity, fields, run_id, layout)
    if "_landed" in partition_by:
        rows = rows.withColumn("_landed", period_from_path("_source_file_name"))
    sink = rows.writeStream.format("parquet").option("path", bronze_path)
    if partition_by:
        sink = sink.partitionBy(*partition_by)
    q = (sink
         .option("checkpointLocation", checkpoint)
         .outputMode("append")
         .trigger(availableNow=True)
         .start())
    q.awaitTermination(timeout_s)
    if q.exception() is not None:
        raise q.exception()
    return bronze_path


def ingest_each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None],
                      checkpoint: str, timeout_s: float | None = None) -> None:
    """Drive a batch function (e.g. a snapshot fold) from a stream, once per
    micro-batch, with exactly-once progress kept in ``checkpoint``."""
    q = (stream.writeStream.foreachBatch(handle)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.exception() is not None:
        raise q.exception()
