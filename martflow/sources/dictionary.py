"""Dictionary (code table) scans.

A dictionary is read as a plain DataFrame from any source Spark can read:
``jdbc`` (the connector jar and driver on the cluster), parquet, or a
catalog table.  Lookup joins re-read it per micro-batch
(:func:`martflow.streaming.jobs.lookup_stream`) and broadcast it only after
proving its size (:func:`martflow.operators.joins.lookup_join`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DICT_COLUMNS = ["dic_code", "dic_name", "parent_code", "create_time", "operate_time"]


def read_dictionary(spark: SparkSession, source: str, *, fmt: str = "parquet",
                    options: dict | None = None, columns: list[str] | None = None) -> DataFrame:
    """Read a dictionary table.

    ``fmt='jdbc'``: ``source`` is the table name (``dbtable``), ``options``
    carry ``url``, ``user``, ``password``, ``driver``.  ``fmt='table'``:
    ``source`` is a catalog table.  Otherwise ``source`` is a path.
    """
    opts = dict(options or {})
    if fmt == "jdbc":
        df = spark.read.format("jdbc").option("dbtable", source).options(**opts).load()
    elif fmt == "table":
        df = spark.read.table(source)
    else:
        df = spark.read.format(fmt).options(**opts).load(source)
    cols = columns or [c for c in DICT_COLUMNS if c in df.columns]
    return df.select(*cols)
