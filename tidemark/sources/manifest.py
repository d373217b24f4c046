"""Which files make up each table: one small file, replaced as a whole.

A run writes new folders only. What readers see is the newest *manifest*, a JSON
file that names, for every table, its folder or, for a partitioned table,
the version of each partition. Publishing a run is one rename to the next
manifest's name, which fails if that name is taken. So a run that stops anywhere
before leaves all tables as they were, and a reader sees either the former run
or the next one, never a mixture. Folders that the last manifests do not name
are removed by ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import table_exists

_NAME = "manifest-"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _fs(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path(folder))] if fs.exists(path(folder)) else []


@dataclass
class Manifest:
    """``tables``: name -> {"path"} or {"root", "by", "schema", "parts"}; ``runs``:
    ingest runs and restatements whose rows are in the tables; ``notes``: what
    the tables were built with."""

    number: int = 0
    tables: dict = field(default_factory=dict)
    runs: list[str] = field(default_factory=list)
    notes: dict = field(default_factory=dict)


def load(spark: SparkSession, root: str, number: int | None = None) -> Manifest:
    """The newest manifest under ``root`` (or that numbered), empty if there is none."""
    numbers = [int(n.removeprefix(_NAME).removesuffix(".json")) for n in _names(spark, root) if n.startswith(_NAME)]
    number = max(numbers, default=0) if number is None else number
    if not number:
        return Manifest()
    text = spark.read.text(f"{root}/{_NAME}{number}.json", wholetext=True).first()[0]
    return Manifest(number, **json.loads(text))


def publish(spark: SparkSession, root: str, manifest: Manifest) -> Manifest:
    """Make ``manifest`` the next one after its number, in one rename."""
    fs, path = _fs(spark, root)
    fs.mkdirs(path(root))
    text = json.dumps({"tables": manifest.tables, "runs": manifest.runs, "notes": manifest.notes})
    draft = path(f"{root}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(text.encode())
    out.close()
    number = manifest.number + 1
    target = path(f"{root}/{_NAME}{number}.json")
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise RuntimeError(f"manifest {number} was published by another run")
    return Manifest(number, manifest.tables, manifest.runs, manifest.notes)


# Partitioned tables ----------------------------------------------------------


def part_name(spark: SparkSession, by: Sequence[str], values: Sequence[str | None]) -> str:
    """The folder of one partition, as Spark names it."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(utils.getPartitionPathString(c, v) for c, v in zip(by, values, strict=True))


def _leaves(spark: SparkSession, folder: str, depth: int) -> list[str]:
    names = [n for n in _names(spark, folder) if "=" in n]
    if depth == 1:
        return names
    return [f"{n}/{m}" for n in names for m in _leaves(spark, f"{folder}/{n}", depth - 1)]


def replace_parts(df: DataFrame, entry: dict | None, root: str, version: str, by: Sequence[str],
                  replaced: Iterable[Sequence[str | None]] | None) -> dict:
    """Write ``df`` as ``version`` of its partitions; the entry of a table in which
    they stand for the ``replaced`` ones (None: for all), whether or not these
    have rows now. Nothing stored is touched."""
    spark = df.sparkSession
    folder = f"{root}/version={version}"
    df.write.mode("overwrite").partitionBy(*by).parquet(folder)
    kept = {}
    if entry is not None and replaced is not None:
        gone = {part_name(spark, by, v) for v in replaced}
        kept = {p: v for p, v in entry["parts"].items() if p not in gone}
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema if f.name not in by]
                          + [T.StructField(c, T.StringType()) for c in by])
    return {"root": root, "by": list(by), "schema": schema.json(),
            "parts": kept | dict.fromkeys(_leaves(spark, folder, len(by)), version)}


def read_entry(spark: SparkSession, entry: dict) -> DataFrame:
    """A table of a manifest."""
    if "path" in entry:
        return spark.read.parquet(entry["path"])
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    if not entry["parts"]:
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    paths = [f"{entry['root']}/version={v}/{p}" for p, v in sorted(entry["parts"].items())]
    return spark.read.schema(whole).option("basePath", entry["root"]).parquet(*paths).select(schema.fieldNames())


def read_parts(spark: SparkSession, entry: dict, only: Iterable[Sequence[str | None]]) -> DataFrame:
    """Some partitions of a table."""
    names = {part_name(spark, entry["by"], v) for v in only}
    return read_entry(spark, entry | {"parts": {p: v for p, v in entry["parts"].items() if p in names}})


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the folders beside those that the last ``keep`` manifests name, and
    older manifests. Returns what was deleted. Run it when no run is under way."""
    numbers = sorted(int(n.removeprefix(_NAME).removesuffix(".json")) for n in _names(spark, root) if n.startswith(_NAME))
    live: set[str] = set()
    roots: set[str] = set()
    for i, number in enumerate(numbers):
        for entry in load(spark, root, number).tables.values():
            folders = [entry["path"]] if "path" in entry else [f"{entry['root']}/version={v}" for v in set(entry["parts"].values())]
            roots |= {f.rsplit("/", 1)[0] for f in folders}
            if i >= len(numbers) - keep:
                live |= set(folders)
    dead = [f"{r}/{n}" for r in sorted(roots) for n in _names(spark, r)
            if n.startswith(("v-", "version=")) and f"{r}/{n}" not in live]
    dead += [f"{root}/{_NAME}{n}.json" for n in numbers[:-keep]]
    for d in dead:
        fs, path = _fs(spark, d)
        fs.delete(path(d), True)
    return dead


# The ledger -------------------------------------------------------------------


def record_files(spark: SparkSession, ledger: str, entity: str, run_id: str, rows: DataFrame, keys: Sequence[str]) -> None:
    """Append what a run landed, file by file: rows, and rows that have ``keys``.
    A run without files gets one row without a file, so it counts as recorded."""
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    files = rows.groupBy(F.col("_source_file_name").alias("file"), F.col("_landed").alias("period")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(keyed).alias("n_keyed"))
    mark = spark.range(1).select(F.lit(None).cast("string").alias("file"), F.lit(None).cast("string").alias("period"),
                                 F.lit(0).cast("long").alias("n_rows"), F.lit(0).cast("long").alias("n_keyed"))
    files.unionByName(mark).select(F.lit(run_id).alias("run_id"), F.lit(entity).alias("entity"), "*").coalesce(1) \
        .write.mode("append").parquet(ledger)


def recorded(spark: SparkSession, ledger: str) -> DataFrame:
    """run_id, entity, file, period, n_rows, n_keyed of all landed files."""
    schema = "run_id string, entity string, file string, period string, n_rows long, n_keyed long"
    if not table_exists(spark, ledger):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(ledger)
