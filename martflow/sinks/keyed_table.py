"""Keyed tables in buckets: the compacted form of a keyed topic (K3, K7) and dimension tables.

A key belongs to one of ``buckets`` buckets by its hash.  A write adds a *delta* to the buckets that it touches, and a bucket's *base* is
rewritten from base and deltas by :meth:`KeyedTable.compact`, once its deltas outweigh a share of it.  Readers merge the base and the
deltas of each bucket, so the current state never needs the whole history.

``data/version=<v>/bucket=<b>`` holds the files, ``commits`` a small table with a row for each (version, bucket): a version
counts once its rows are there, in one file, so a write that dies leaves nothing that is read.  The commits name query and
micro-batch: a retried batch finds itself done.  Files of a bucket that a base has replaced stay for one more version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martflow.session import open_folders

COMMITS = "version bigint, bucket int, base boolean, rows bigint, query_id string, batch_id bigint"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class KeyedTable:
    """A table of (``key``, payload) at ``path``.

    With ``columns=None`` the payload is one text ``value``: the latest counts, and null deletes the key (K7).  With
    ``columns`` it is a map ``data``: a key has, for each of these columns, the value of the latest change that names it (O7).
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int, columns: Sequence[str] | None = None):
        self.spark, self.path, self.buckets, self.columns = spark, path.rstrip("/"), buckets, columns
        self.payload = "value" if columns is None else "data"
        kind = "string" if columns is None else "map<string,string>"
        self.schema = f"key string, {self.payload} {kind}, place bigint"

    # ------------------------------------------------------------- commits
    def commits(self) -> DataFrame:
        p, fs = _fs(self.spark, f"{self.path}/commits")
        return self.spark.read.schema(COMMITS).parquet(f"{self.path}/commits") if fs.exists(p) else self.spark.createDataFrame([], COMMITS)

    def live(self) -> list:
        """A row for each live set of files: (bucket, version, base, rows): the newest base of each bucket and the deltas after it."""
        c = self.commits().filter("bucket >= 0")
        base = c.filter("base").groupBy("bucket").agg(F.max("version").alias("from"))
        at = c.join(base, "bucket", "left").filter(F.col("from").isNull() | (F.col("version") >= F.col("from")))
        return at.select("bucket", "version", "base", "rows").orderBy("bucket", "version").collect()

    def _version(self) -> int:
        return (self.commits().agg(F.max("version")).first()[0] or 0) + 1

    def done(self, query_id: str, batch_id: int) -> bool:
        return not self.commits().filter((F.col("query_id") == query_id) & (F.col("batch_id") == batch_id)).isEmpty()

    # --------------------------------------------------------------- write
    def _folded(self, rows: DataFrame, order: list[Column], keep_deletes: bool = True) -> DataFrame:
        """One row for each key: (key, payload, place)."""
        at = F.struct(*order)
        if self.columns is None:
            out = rows.groupBy("key").agg(F.max_by(F.struct("value"), at).alias("v"), F.max("place").alias("place"))
            out = out.select("key", "v.value", "place")
            return out if keep_deletes else out.filter("value IS NOT NULL")
        one = lambda c: F.max_by(F.struct(F.lit(c).alias("k"), F.col("data")[c].alias("v")), F.when(F.map_contains_key("data", F.lit(c)), at))
        out = rows.groupBy("key").agg(F.array(*[one(c) for c in self.columns]).alias("e"), F.max("place").alias("place"))
        return out.select("key", F.map_from_entries(F.filter("e", lambda x: x.isNotNull())).alias("data"), "place")

    def _write(self, rows: DataFrame, base: bool, query_id: str, batch_id: int) -> int:
        version = self._version()
        self._files(rows, version)
        self._commit(version, base, query_id, batch_id, [])
        return version

    def _files(self, rows: DataFrame, version: int) -> None:
        """The version's files: each task of the fold before writes its keys to their buckets, so the rows are shuffled once."""
        dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int"))
        with open_folders(self.spark):
            dealt.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{self.path}/data/version={version}")

    def _commit(self, version: int, base: bool, query_id: str, batch_id: int, emptied: Sequence[int]) -> None:
        p, fs = _fs(self.spark, f"{self.path}/data/version={version}")
        counts = self.spark.createDataFrame([], "bucket int, rows bigint")
        if fs.exists(p) and any(s.getPath().getName().startswith("bucket=") for s in fs.listStatus(p)):
            got = self.spark.read.schema(self.schema + ", bucket int").parquet(f"{self.path}/data/version={version}")
            counts = got.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))  # from the files' footers
        # bucket -1 marks the batch, also one that has no row
        marks = [(-1, 0)] + [(b, 0) for b in emptied]
        rows = counts.unionByName(self.spark.createDataFrame(marks, "bucket int, rows bigint")) if emptied or not base else counts
        rows = rows.groupBy("bucket").agg(F.max("rows").alias("rows"))
        rows.select(F.lit(version).cast("bigint").alias("version"), "bucket", F.lit(base).alias("base"), "rows", F.lit(query_id).alias("query_id"),
                    F.lit(batch_id).cast("bigint").alias("batch_id")).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def append(self, changes: DataFrame, order: Sequence[str], batch_id: int, query_id: str = "batch") -> None:
        """Add changes (``key``, payload, and the columns that ``order`` names) as a delta; of a key one row.

        ``order`` orders a batch's changes of a key, and a later batch is later.  Rows of null key are dropped.  A batch that is done is skipped.
        """
        if self.done(query_id, batch_id):
            return
        rows = changes.filter("key IS NOT NULL").select("key", self.payload, F.lit(self._version()).cast("bigint").alias("place"), *order)
        self._write(self._folded(rows, [F.col(c) for c in order]), False, query_id, batch_id)

    def compact(self, share: float = 0.25) -> list[int]:
        """Rewrite the base of each bucket whose deltas have over ``share`` of its base's rows; returns these buckets."""
        sets: dict[int, list] = {}
        for s in self.live():
            sets.setdefault(s["bucket"], []).append(s)
        heavy = [b for b, x in sets.items() if sum(s["rows"] for s in x if not s["base"]) > share * sum(s["rows"] for s in x if s["base"])]
        if not heavy:
            return []
        merged = self._folded(self._rows([s for b in heavy for s in sets[b]]), [F.col("place")], keep_deletes=False)
        version = self._version()
        self._files(merged, version)
        self._commit(version, True, "compact", version, heavy)
        self._forget(version, {(s["version"], s["bucket"]) for x in sets.values() for s in x})
        return heavy

    def _forget(self, version: int, before: set) -> None:
        """Delete the files that were replaced before the last version; readers of that one may still be at work."""
        now = {(s["version"], s["bucket"]) for s in self.live()}
        for r in self.commits().filter((F.col("bucket") >= 0) & (F.col("version") < version)).select("version", "bucket").distinct().collect():
            if (r[0], r[1]) not in now | before:
                p, fs = _fs(self.spark, f"{self.path}/data/version={r[0]}/bucket={r[1]}")
                fs.delete(p, True)

    # ---------------------------------------------------------------- read
    def files(self) -> list[str]:
        """The folders that a reader reads now."""
        return [f"{self.path}/data/version={s['version']}/bucket={s['bucket']}" for s in self.live() if s["rows"]]

    def _rows(self, sets: list) -> DataFrame:
        paths = [f"{self.path}/data/version={s['version']}/bucket={s['bucket']}" for s in sets if s["rows"]]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        """The current state: (key, payload)."""
        return self._folded(self._rows(self.live()), [F.col("place")], keep_deletes=False).select("key", self.payload)
