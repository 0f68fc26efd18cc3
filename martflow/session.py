"""Session construction and shared-folder helpers.

On a cluster the session already exists.  Tests and the bench build a local
session through :func:`build_session`.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every job relies on.  Values are defaults; a cluster may override.
DEFAULTS = {
    # All date helpers take an explicit zone, but pin the session zone so
    # that casts between TIMESTAMP and TIMESTAMP_NTZ are reproducible.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, and turn sort-merge joins into broadcast joins only
    # when the *measured* build side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # Static planning must not broadcast on estimates alone; AQE does it on
    # measured sizes, and explicit hints come from checked helpers.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    # A join takes both sides as they are where they are partitioned by some of its keys alone.
    CO_PARTITION: "false",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    STATE_STORE: ROCKSDB,
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files of collected DataFrames are removed by the cleaner.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "martflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session with the warehouse defaults.

    A local session that names no ``spark.checkpoint.dir`` gets a scratch
    folder when one is first needed; a cluster names its shared folder.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    conf["spark.driver.memory"] = os.environ.get("MARTFLOW_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def join_in_place(spark: SparkSession) -> None:
    """From now on the session's joins take sides that are partitioned by some of their keys as they are.

    Spark's default shuffles such sides anew.  Plans are made when a result is asked for, so the setting stays.
    """
    spark.conf.set(CO_PARTITION, "false")


#: Bytes of input files for each task of a shuffle whose rows are sorted (compressed texts, which take some ten times that there).
TASK_BYTES = 16 << 20
UNKNOWN_BYTES = 1 << 50  # Spark's guess for rows that are in no file is beyond this


def tasks_of(df: DataFrame) -> list[int]:
    """How many tasks a shuffle of rows from the files of ``df`` should have, for ``repartition``; none where the session names enough.

    A session's number holds for tables of any size, so large ones would be sorted through the disk.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    wanted = -(-sum(s for s in sizes if s < UNKNOWN_BYTES) // TASK_BYTES)
    return [wanted] if wanted > df.sparkSession._jsparkSession.sessionState().conf().numShufflePartitions() else []


@contextmanager
def column_family_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB where the session names Spark's default store.

    That one has no column families, without which ``transformWithState`` does not run.  A stream takes the
    settings that hold when it is started, so the session has its own again afterwards.
    """
    was = spark.conf.get(STATE_STORE)
    if not was.endswith(".HDFSBackedStateStoreProvider"):
        yield
        return
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, was)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised intermediate tables.

    Read from the session (``spark.checkpoint.dir``).  Only a local-mode
    session without one (tests, single-machine checks) gets a scratch
    folder; on a cluster the setting is required, never a machine-local
    default.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder")
        d = tempfile.mkdtemp(prefix="martflow-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return (sc.getCheckpointDir() or d).rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _own(spark: SparkSession, kind: str) -> str:
    return f"{checkpoint_root(spark)}/{kind}-{spark.sparkContext.applicationId}"


#: Folders that a task writes at once; a task that meets more of them sorts its rows by folder.
OPEN_FOLDERS = 64


@contextmanager
def open_folders(spark: SparkSession):
    """Partitioned writes inside go to all folders at once, up to :data:`OPEN_FOLDERS` for a task, without a sort."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    was = spark.conf.get(key)
    spark.conf.set(key, str(max(int(was), OPEN_FOLDERS)))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def land(df, name: str, partition_by: tuple[str, ...] = ()):
    """Write ``df`` once as a parquet table in the shared folder and return the
    table read back: for results that several views read.  A lost executor then costs a
    re-read of files, not the lineage that led to them.  With ``partition_by``, columns of few values, each task writes
    its rows to all of their folders as they come, without a shuffle or sort.  :func:`drop_landed` removes these tables."""
    spark, schema = df.sparkSession, df.schema
    path = f"{_own(spark, 'tables')}/{name}-{uuid.uuid4().hex}"
    with open_folders(spark):
        df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    back = spark.read.schema(schema).parquet(path)
    return back.select(*[c for c in df.columns])


def drop_landed(spark: SparkSession) -> None:
    """Delete the tables that this application has landed or staged; call it when the results that read them are written."""
    for kind in ("tables", "llm"):
        _delete(spark, _own(spark, kind))


_TOPICS: dict[tuple[str, str], str] = {}


def topic_once(spark: SparkSession, name: str, build):
    """The records that ``build()`` renders, as a topic: written to the shared folder at an application's first call, and read from there by all.

    The jobs take their records from a topic; rendering them from test tables is no part of a job.  Hardly two records are
    alike, so they are written without a dictionary.
    """
    at = (spark.sparkContext.applicationId, name)
    if at not in _TOPICS:
        path = f"{_own(spark, 'rendered')}/{uuid.uuid4().hex}"
        build().write.option("compression", "zstd").option("parquet.enable.dictionary", "false").parquet(path)
        _TOPICS[at] = path
    return spark.read.parquet(_TOPICS[at])
