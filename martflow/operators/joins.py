"""Joins: J1-J7.

* J1/J2/J3 equi inner / left outer joins are plain DataFrame joins; the
  planner shuffles both sides on the key and AQE splits skewed partitions.
* J4/J5 dictionary (lookup) joins broadcast the dictionary only after its rows
  and bytes are *proven* under a bound; beyond it the join stays a shuffle join.
* J4 as of a time (:func:`lookup_as_of`): the dictionary as the row's own time saw it, from its versions.
* J7 interval join: an equi-join on (key, time bucket) plus the exact range
  predicate, so a hot key is spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from martflow.operators.sequence import running
from martflow.sources.envelope import of_table

# Largest dictionary we broadcast without a shuffle (rows, and bytes of their text).
DICT_BROADCAST_MAX_ROWS = 200_000
DICT_BROADCAST_MAX_BYTES = 32 << 20


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int = DICT_BROADCAST_MAX_BYTES) -> bool:
    """Size proof at the time of the call: reads at most ``max_rows + 1`` rows, counts them and the bytes of their values."""
    width = F.lit(0)
    for c in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0))
    got = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return got["n"] <= max_rows and (got["b"] or 0) <= max_bytes


def lookup_join(facts: DataFrame, dictionary: DataFrame, fact_key: str, dict_key: str,
                how: str = "inner", max_rows: int = DICT_BROADCAST_MAX_ROWS,
                dict_small: bool | None = None, dict_cols: list[str] | None = None) -> DataFrame:
    """Join facts with a dictionary table; ``inner`` drops misses.

    ``dict_cols`` narrows the dictionary; it is broadcast if it is small now.  ``dict_small`` lets a
    caller that has just proved the size skip the check; a stream's plan outlives its proof, so it passes False.
    """
    if dict_cols:
        dictionary = dictionary.select(*dict_cols)
    small = has_at_most(dictionary, max_rows) if dict_small is None else dict_small
    d = F.broadcast(dictionary) if small else dictionary
    return facts.join(d, facts[fact_key] == d[dict_key], how)


def dictionary_versions(changes: DataFrame, table: str, key: str, cols: Sequence[str], at: str = "ts") -> DataFrame:
    """The versions of a dictionary from its change rows (envelope): ``key``, ``valid_from``, ``cols`` and ``gone`` for deletes."""
    rows = of_table(changes, table).filter(F.col("type").isin("insert", "update", "delete", "bootstrap-insert"))
    return rows.select(F.col("data")[key].alias(key), F.col(at).alias("valid_from"),
                       *[F.col("data")[c].alias(c) for c in cols if c != key], (F.col("type") == "delete").alias("gone"))


def lookup_as_of(facts: DataFrame, versions: DataFrame, fact_key: str, dict_key: str, at: str, cols: Sequence[str],
                 how: str = "inner", valid_from: str = "valid_from", gone: str | None = None, bucket: int = 3_600_000,
                 small: bool | None = None) -> DataFrame:
    """J4 as of a time: each fact with ``cols`` of its key's newest version that is valid from its ``at`` or before.

    ``inner`` drops facts without a version, or whose newest one is ``gone``; ``left`` gives them nulls.  Of
    versions from the same time the greatest by ``cols`` counts.  Facts without a key or time have no version.

    A dictionary that is small now (``small=None`` has it checked) is broadcast, its versions as one list for each key, and the
    facts stay where they are.  Otherwise facts and versions of a key are put in order together, in buckets
    of ``bucket`` time units, and the last version is carried on (:func:`running`): no range join, and no key's facts in one task.
    """
    if how not in ("inner", "left"):
        raise ValueError("an as-of join is inner or left")
    away = F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)
    version = F.struct(*[F.col(f"`{c}`") for c in cols], away.alias("__gone"))
    own = versions.filter(F.col(dict_key).isNotNull() & F.col(valid_from).isNotNull()) \
        .select(F.col(dict_key).alias("__key"), F.col(valid_from).cast("bigint").alias("__at"), version.alias("__v"))
    if has_at_most(own.select("__key", "__at", F.to_json("__v").alias("v")), DICT_BROADCAST_MAX_ROWS) if small is None else small:
        lists = own.groupBy("__key").agg(F.array_sort(F.collect_list(F.struct("__at", "__v"))).alias("__all"))
        j = facts.join(F.broadcast(lists), facts[fact_key] == lists["__key"], "left")
        seen = F.filter("__all", lambda v: v["__at"] <= facts[at])
        j = j.withColumn("__got", F.when(F.size(seen) > 0, F.element_at(seen, -1)["__v"])).drop("__key", "__all")
    else:
        rows = facts.select(facts[fact_key].alias("__key"), facts[at].cast("bigint").alias("__at"), F.lit(1).alias("__kind"),
                            F.lit(None).cast(own.schema["__v"].dataType).alias("__v"),
                            F.struct(*[facts[f"`{c}`"] for c in facts.columns]).alias("__row"))
        both = rows.unionByName(own.withColumn("__kind", F.lit(0)), allowMissingColumns=True)
        got = running(both, ["__key"], ["__at", "__kind", "__v"], F.floor(F.col("__at") / bucket).cast("bigint"), "__v", "__got")
        # without a key or time nothing was before
        got = got.filter("__kind = 1").withColumn("__got", F.when(F.col("__key").isNotNull() & F.col("__at").isNotNull(), F.col("__got")))
        j = got.select("__row.*", "__got")
    there = F.col("__got").isNotNull() & ~F.col("__got.__gone")
    if how == "inner":
        j = j.filter(there)
    return j.select(*[F.col(f"`{c}`") for c in facts.columns], *[F.when(there, F.col("__got").getField(c)).alias(c) for c in cols])


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_ts: str, right_ts: str, lower_ms: int, upper_ms: int,
                  how: str = "inner") -> DataFrame:
    """``right.ts`` in ``[left.ts + lower_ms, left.ts + upper_ms]`` (inclusive),
    same key.  ``how`` is ``inner`` or ``left`` (left rows kept once).

    Columns of the two sides must not clash.  Time columns are epoch ms.
    Each left row falls in exactly one bucket ``floor(ts / w)``
    (``w = upper - lower``); each right row is copied to the (at most two)
    buckets whose left rows it can match, so no pair is produced twice.
    """
    if upper_ms < lower_ms:
        raise ValueError("upper bound below lower bound")
    if how not in ("inner", "left"):
        raise ValueError("interval join supports inner and left")
    w = max(upper_ms - lower_ms, 1)
    lb = left.withColumn("__jb", F.floor(F.col(left_ts) / F.lit(w)).cast("bigint"))
    lo = F.floor((F.col(right_ts) - F.lit(upper_ms)) / F.lit(w)).cast("bigint")
    hi = F.floor((F.col(right_ts) - F.lit(lower_ms)) / F.lit(w)).cast("bigint")
    rb = right.withColumn("__rb", F.explode(F.sequence(lo, hi)))
    cond = ((lb[left_key] == rb[right_key]) & (lb["__jb"] == rb["__rb"])
            & rb[right_ts].between(lb[left_ts] + F.lit(lower_ms), lb[left_ts] + F.lit(upper_ms)))
    return lb.join(rb, cond, how).drop("__jb", "__rb")


def stream_interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                         left_time: str, right_time: str, lower_ms: int, upper_ms: int,
                         how: str = "inner") -> DataFrame:
    """J7/J2 on streams: both sides carry watermarks on TIMESTAMP columns; the
    range predicate lets Spark evict join state (inner and left outer)."""
    cond = ((left[left_key] == right[right_key])
            & (right[right_time] >= left[left_time] + F.expr(f"INTERVAL {lower_ms / 1000} SECONDS"))
            & (right[right_time] <= left[left_time] + F.expr(f"INTERVAL {upper_ms / 1000} SECONDS")))
    return left.join(right, cond, how)
