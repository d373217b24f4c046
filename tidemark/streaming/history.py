"""Type-2 history kept in the state of a stream.

A query over new landing files keeps, in Spark's state store, what it needs to
tell which versions a file opens and closes; no landed file is read twice, and
no history is replayed unless a file is late.

Keys are dealt to ``buckets``. A bucket's state maps each period to the rows
that its keys have there (Arrow, compressed) and when each row's version began.
A batch brings the bucket the rows of its keys, and the name of every period
that has rows anywhere, as a key missing from a snapshot is closed by it. Then

* *in order*: the state of the period before is read and compared with the new
  rows: equal ones carry their version on, others open, change or close one;
* *late, split or corrected*: the periods from the earliest touched one on are
  compared again, and the versions that differ are withdrawn and replaced.

Both are the same fold from the period before the earliest touched one. It emits
changes: a version with sign +1, or -1 where one that was emitted is void (a
version that ends is void as an open one). ``foreachBatch`` writes them to a folder
of the batch, so a batch that is run again after a failure replaces its own
output. The dimension is the sum of all changes; ``compact`` writes that sum,
and later reads start from it.

Bytes read follow the new files and the state of one period; bytes written
follow the new rows (state) and the changed versions (output).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.periods import period_from_path
from tidemark.operators.dedup import drop_null_keys
from tidemark.operators.scd2 import END, START
from tidemark.session import prepare_python
from tidemark.sources.landing import ENTITY_FIELDS, NEWEST
from tidemark.sources.tables import table_exists, write_table
from tidemark.streaming.ingest import ingest_each_batch, landing_stream

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SIGN = "_sign"
BEGAN, ENDED, SIGN = "began", "ended", "sign"  # the same columns inside the processor


def _numbered(letter: str, n: int) -> list[str]:
    return [f"{letter}{i}" for i in range(n)]


def _with_marks(buckets: int, schema: pa.Schema):
    """Rows, and once a task and period a mark for every bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set = set()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, schema, strict=True)], schema=schema)
            new = set(batch.column("period").unique().to_pylist()) - told
            told |= new
            for period in new:
                marks = {"bucket": pa.array(range(buckets), pa.int32()), "period": pa.array([period] * buckets),
                         "mark": pa.array([True] * buckets)}
                yield pa.RecordBatch.from_arrays(
                    [marks.get(f.name, pa.nulls(buckets, f.type)) for f in schema], schema=schema)

    return run


def _pack(rows: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(rows, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(blob: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(blob).read_all().to_pandas().astype(object)


class HistoryProcessor(StatefulProcessor):
    """Versions of a bucket's keys, from its rows period by period.

    Columns are numbered: keys k0 and on, tracked t0, order o0."""

    def __init__(self, n_keys: int, n_tracked: int, n_order: int):
        self.keys, self.tracked, self.order = _numbered("k", n_keys), _numbered("t", n_tracked), _numbered("o", n_order)
        self.values = self.keys + self.tracked

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.periods = handle.getMapState("periods", "period string", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        got = pd.concat(list(rows), ignore_index=True).astype(object)
        got = got.where(got.notna(), None)
        touched = sorted(set(got["period"]))
        known = sorted(k[0] for k in self.periods.keys())
        first = touched[0]
        before = max((p for p in known if p < first), default=None)
        old = {p: _unpack(self.periods.getValue((p,))[0]) for p in known if p >= first}
        base = None if before is None else _unpack(self.periods.getValue((before,))[0])
        new = dict(old)
        given = got[got["mark"].isna()]
        for period, part in given.groupby("period", sort=True) if len(given) else []:
            columns = self.values + self.order
            both = [new[period][columns]] if period in new else []
            new[period] = self._newest(pd.concat([*both, part[columns]], ignore_index=True))
        for period in touched:
            if period not in new:
                new[period] = got.iloc[:0][self.values + self.order]
        after, states = self._versions(base, new)
        for period, state in states.items():
            self.periods.updateValue((period,), (_pack(state),))
        changed = self._changes(self._versions(base, old)[0], after)
        if len(changed):
            yield changed

    def _newest(self, rows: pd.DataFrame) -> pd.DataFrame:
        """One row a key: the newest by the order columns, then the greatest."""
        ranked = rows.sort_values(self.order + self.tracked, na_position="first", kind="stable")
        return ranked.drop_duplicates(self.keys, keep="last")

    def _versions(self, base: pd.DataFrame | None, chain: dict[str, pd.DataFrame]) -> tuple[pd.DataFrame, dict]:
        """Versions that are open before the chain or begin in it, and its states."""
        columns = [*self.values, BEGAN, ENDED]
        open_ = base[[*self.values, BEGAN]] if base is not None else pd.DataFrame(columns=[*self.values, BEGAN], dtype=object)
        closed, states = [], {}
        for period in sorted(chain):
            now = chain[period][self.values + self.order]
            met = now.merge(open_.rename(columns={BEGAN: "was"}), on=self.values, how="left")
            met[BEGAN] = met["was"].where(met["was"].notna(), period)
            gone = open_.merge(now[self.values].assign(still=True), on=self.values, how="left")
            gone = gone[gone["still"].isna()].drop(columns="still")
            if len(gone):
                closed.append(gone.assign(**{ENDED: period}))
            states[period] = met.drop(columns="was").astype(object)
            open_ = states[period][[*self.values, BEGAN]]
        parts = [*closed, open_.assign(**{ENDED: None})]
        return pd.concat([p[columns].astype(object) for p in parts], ignore_index=True), states

    def _changes(self, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        columns = [*self.values, BEGAN, ENDED]
        both = pd.concat([old.assign(**{SIGN: -1}), new.assign(**{SIGN: 1})], ignore_index=True)
        net = both.groupby(columns, dropna=False, sort=False, as_index=False)[SIGN].sum()
        net = net[net[SIGN] != 0].astype({c: object for c in columns})
        return net.where(net.notna(), None)


def history_stream(rows: DataFrame, keys: Sequence[str], tracked: Sequence[str], buckets: int = 64,
                   order: Sequence[str] = tuple(NEWEST)) -> DataFrame:
    """Changes of the versions of streamed ``rows`` (keys, tracked, ``period`` and
    the order columns): the version's columns and ``_sign``.

    Rows without a key or period are left out, as in the batch form. ``buckets``
    is fixed for the life of the checkpoint; a bucket's rows of one period must
    fit a task.
    """
    keys, tracked, order = list(keys), list(tracked), list(order)
    # An order column is compared as text: times in one format sort as they do.
    shown = [F.col(c).cast("string") for c in order]
    kept = drop_null_keys(rows, [*keys, "period"]).select(
        F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"), "period", F.lit(None).cast("boolean").alias("mark"),
        *(c.alias(n) for letter, given in (("k", map(F.col, keys)), ("t", map(F.col, tracked)), ("o", shown))
          for n, c in ((f"{letter}{i}", c) for i, c in enumerate(given))))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in kept.schema])  # a mark has nulls
    marked = kept.mapInArrow(_with_marks(buckets, to_arrow_schema(schema)), schema)
    names = dict(zip(_numbered("k", len(keys)) + _numbered("t", len(tracked)), keys + tracked, strict=True)) | {BEGAN: START, ENDED: END, SIGN: _SIGN}
    types = {n: schema[n].dataType for n in names if n in kept.columns} | {BEGAN: T.StringType(), ENDED: T.StringType(), SIGN: T.LongType()}
    changes = marked.groupBy("bucket").transformWithStateInPandas(
        HistoryProcessor(len(keys), len(tracked), len(order)), outputStructType=T.StructType([T.StructField(n, t) for n, t in types.items()]),
        outputMode="append", timeMode="none")
    return changes.select(*(F.col(n).alias(shown) for n, shown in names.items()))


def maintain_dimension(spark: SparkSession, landing: str, entity: str, dim_root: str, checkpoint: str,
                       keys: Sequence[str], tracked: Sequence[str] | None = None, layout: str = "{base}/*/{entity}/",
                       timeout_s: float | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None,
                       buckets: int = 64, fields: Sequence[str] | None = None) -> str:
    """Take up the new landing files of ``entity`` and append what they change to
    the changes under ``dim_root``, which ``stored_dimension`` reads.

    ``prepare`` is applied to the rows first (e.g. a field repair); ``fields``
    are the landed ones, by default those of the entity. Files may come late, in
    parts, in any order, or corrected."""
    tracked = [c for c in ENTITY_FIELDS[entity] if c not in keys] if tracked is None else list(tracked)
    prepare_python(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = landing_stream(spark, landing, entity, fields, layout=layout).withColumn("period", period_from_path("_source_file_name"))
    if prepare is not None:
        rows = prepare(rows)

    def keep(batch: DataFrame, batch_id: int) -> None:
        write_table(batch, f"{dim_root}/changes/batch={batch_id}")

    ingest_each_batch(history_stream(rows, keys, tracked, buckets), keep, checkpoint, timeout_s)
    return dim_root


def _sums(changes: DataFrame) -> DataFrame:
    columns = [c for c in changes.columns if c != _SIGN]
    return changes.groupBy(*columns).agg(F.sum(_SIGN).alias(_SIGN)).where(F.col(_SIGN) > 0)


def _changes(spark: SparkSession, dim_root: str) -> tuple[DataFrame, int]:
    """All changes from the newest compacted sum on, and the last batch in them."""
    done = spark.read.parquet(f"{dim_root}/changes")
    last = done.agg(F.max(F.col("batch").cast("long"))).first()[0]
    last = -1 if last is None else last
    sums = f"{dim_root}/compacted"
    if not table_exists(spark, sums):
        return done.drop("batch"), last
    upto = spark.read.parquet(sums).agg(F.max(F.col("upto").cast("long"))).first()[0]
    whole = spark.read.parquet(f"{sums}/upto={upto}")
    return whole.unionByName(done.where(F.col("batch").cast("long") > upto).drop("batch")), last


def stored_dimension(spark: SparkSession, dim_root: str) -> DataFrame:
    """The type-2 dimension that the changes under ``dim_root`` add up to."""
    return _sums(_changes(spark, dim_root)[0]).drop(_SIGN)


def compact(spark: SparkSession, dim_root: str) -> None:
    """Write the sum of all changes so far; reads start from it. Changes and
    former sums stay, so a reader is never cut off and a failed write is no loss."""
    changes, last = _changes(spark, dim_root)
    _sums(changes).write.mode("overwrite").parquet(f"{dim_root}/compacted/upto={last}")
