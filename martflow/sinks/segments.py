"""Topics with partitions and offsets, as parquet segments (S1, S2, K1, K2 without a broker).

A topic has ``partitions`` partitions; a record goes to that of its key's hash (without a key, of its value's), and gets the next
offset there, as a broker would give it.  Segments have a broker's columns ``key, value, partition, offset, timestamp``, so
readers see one order of arrival, in batch and as a stream, and a stream goes on where its checkpoint ended.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SCHEMA = "key string, value string, partition int, offset bigint, timestamp bigint"
_ENDS = "partition int, ends bigint, batch bigint"


def _there(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _ends(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_ENDS).parquet(f"{path}/ends") if _there(spark, f"{path}/ends") else spark.createDataFrame([], _ENDS)


def end_offsets(spark: SparkSession, path: str) -> dict[int, int]:
    """The next offset of each partition that has records."""
    return {r["partition"]: r["ends"] for r in _ends(spark, path).groupBy("partition").agg(F.max("ends").alias("ends")).collect() if r["partition"] >= 0}


def append(df: DataFrame, path: str, batch_id: int, *, partitions: int = 8, value: str = "value", key: str | None = None,
           order: Sequence[str] = (), timestamp: Column | None = None) -> None:
    """K1/K2: append records; ``order`` puts the records of this batch in order inside their partition.

    A batch that was appended whole is skipped, one that was not is written anew: a retry neither loses nor doubles a record.
    """
    spark = df.sparkSession
    if not _ends(spark, path).filter(F.col("batch") == batch_id).isEmpty():
        return
    if not _there(spark, f"{path}/segments/batch={batch_id}/_SUCCESS"):
        _write(df, path, batch_id, partitions, value, key, order, timestamp)
    new = spark.read.schema(SCHEMA).parquet(f"{path}/segments/batch={batch_id}").groupBy("partition").agg((F.max("offset") + 1).alias("ends"))
    new = new.unionByName(spark.createDataFrame([(-1, 0)], "partition int, ends bigint"))  # marks a batch without records, too
    new.withColumn("batch", F.lit(batch_id).cast("bigint")).coalesce(1).write.mode("append").parquet(f"{path}/ends")


def _write(df: DataFrame, path: str, batch_id: int, partitions: int, value: str, key: str | None, order: Sequence[str], timestamp: Column | None) -> None:
    ends = end_offsets(df.sparkSession, path)  # one row for each partition
    start = F.create_map(*[F.lit(x) for p, e in ends.items() for x in (p, e)]) if ends else F.lit(None).cast("map<int,bigint>")
    rows = df.select(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], (F.col(key) if key else F.lit(None)).cast("string").alias("key"),
                     F.col(value).cast("string").alias("value"), (timestamp if timestamp is not None else F.unix_millis(F.current_timestamp())).alias("timestamp"))
    dealt = rows.repartition(partitions, F.coalesce("key", "value")).sortWithinPartitions(*[f"o{i}" for i in range(len(order))] or ["value"])
    placed = dealt.withColumns({"partition": F.spark_partition_id(), "nth": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    placed.select("key", "value", "partition", (F.col("nth") + F.coalesce(F.element_at(start, F.col("partition")), F.lit(0))).alias("offset"), "timestamp") \
        .write.mode("overwrite").parquet(f"{path}/segments/batch={batch_id}")


def read(spark: SparkSession, path: str, *, stream: bool = False, starting: dict[int, int] | None = None, max_files: int | None = None) -> DataFrame:
    """The records from the ``starting`` offsets on (by partition; all if not named)."""
    reader = (spark.readStream if stream else spark.read).schema(SCHEMA)
    if stream and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.parquet(f"{path}/segments/*")
    if starting:
        first = F.create_map(*[F.lit(x) for p, o in starting.items() for x in (p, o)])
        df = df.filter(F.col("offset") >= F.coalesce(F.element_at(first, F.col("partition")), F.lit(0)))
    return df
