"""Staged tables: one parquet folder per cut, under the session's shared folder.

A staged table cuts lineage: it is computed once, and a lost executor makes
Spark re-read files instead of recomputing what led to them.  The folder is
``<spark.checkpoint.dir>/.../llm-<application id>``; :func:`drop_staged`
removes it once the results that read it are written.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from martflow.session import checkpoint_root

#: A side is broadcast only when its rows times their width stay under this many bytes.
BROADCAST_BYTES = 64 << 20


def staging_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/llm-{spark.sparkContext.applicationId}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back."""
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete every staged table of this application."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(staging_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fits_broadcast(df: DataFrame, row_bytes: int) -> bool:
    """Whether ``df`` is small enough to broadcast: counts its rows, at most one past the bound."""
    most = BROADCAST_BYTES // row_bytes
    return df.limit(most + 1).count() <= most


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_martflow_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    into = Path(tempfile.mkdtemp(prefix="martflow-ship-"))
    copy = shutil.copytree(package, into / "src" / package.name, ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(str(into / package.name), "zip", copy.parent))
    sc._martflow_shipped = True
