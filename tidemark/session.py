"""Session settings and the shared scratch folder.

Nothing here is an engine: it only sets the handful of Spark options every
job in the package relies on (UTC session time, ANSI, AQE with skew-join
splitting) and resolves the folder used to cut lineage.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Options every job assumes. AQE re-plans joins from runtime sizes and splits
# skewed shuffle partitions; UTC keeps period strings stable across clusters.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # A JSON object with a repeated key keeps the last value instead of
    # failing the whole ingest job.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Partition values are text, as periods are: "0125" is no number.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench; clusters build their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Set the runtime SQL options on an existing session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def prepare_python(spark: SparkSession) -> None:
    """What tasks that run Python need of the session: workers import the package
    from where the driver does (on a cluster it is installed or shipped), and a
    batch holds at most 1,000 rows, as rows are whole texts."""
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [here, env.get("PYTHONPATH", "")]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of parquet.

    Shuffle partitions start high enough that no task holds more than about
    ``target_partition_bytes`` of input-sized shuffle data (at least three
    waves of tasks), and AQE coalesces them down to the advisory size at run
    time; skewed partitions over 1 GB and 5x the median are split. Scans read
    512 MB splits. Broadcasts stay the explicit, size-checked ones plus
    AQE's own runtime conversions under 64 MB.
    """
    parts = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 ** 3),
        "spark.sql.files.maxPartitionBytes": str(512 * 1024 ** 2),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    }


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set, as no folder of one machine can stand in for
    it; without it this raises. Only a local session, which has one machine,
    gets a folder of its own under the system's temp folder.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = getattr(sc, "_tidemark_scratch", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = sc._tidemark_scratch = tempfile.mkdtemp(prefix="tidemark-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
