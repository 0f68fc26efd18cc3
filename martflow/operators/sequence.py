"""Order-dependent per-key values without a window over a key's whole history.

``running`` gives each row the last value, the maximum or the sum of all rows up to it.
``bucketed_lag`` gives each row the previous row's value within its key in a
given order, and whether such a row exists.  The order must be led by a
column whose bucket (``bucket``) never decreases along the order (a time or
arrival position).  Rows are windowed per (key, bucket); a one-row-per-bucket
summary, windowed per key over its buckets, carries the last value of the
previous non-empty bucket to each bucket's first row.  A key holding a third
of all rows is spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def bucketed_lag(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column,
                 value: str, out: str, has_prev: str | None = None) -> DataFrame:
    """Add ``out`` = previous row's ``value`` per key in ``order`` (null for the
    first row) and, if named, ``has_prev`` = whether a previous row exists."""
    keys, order = list(keys), list(order)
    base = df.withColumn("__bl_b", bucket)
    w = Window.partitionBy(*keys, "__bl_b").orderBy(*[F.col(c) for c in order])
    d = base.withColumn("__bl_prev", F.lag(value).over(w)) \
        .withColumn("__bl_first", F.row_number().over(w) == 1)
    # The summary reads the raw rows (map-side partial aggregation), not the
    # windowed ones, so the window runs once.
    last = base.groupBy(*keys, "__bl_b").agg(
        F.max_by(F.col(value), F.struct(*[F.col(c) for c in order])).alias("__bl_last"))
    wb = Window.partitionBy(*keys).orderBy("__bl_b")
    carry = last.withColumn("__bl_carry", F.lag("__bl_last").over(wb)) \
        .withColumn("__bl_carry_ok", F.lag("__bl_b").over(wb).isNotNull()).drop("__bl_last")
    j = d.join(carry, keys + ["__bl_b"], "left")
    j = j.withColumn(out, F.when(F.col("__bl_first"), F.col("__bl_carry")).otherwise(F.col("__bl_prev")))
    if has_prev:
        j = j.withColumn(has_prev, ~F.col("__bl_first") | F.col("__bl_carry_ok"))
    return j.drop("__bl_b", "__bl_prev", "__bl_first", "__bl_carry", "__bl_carry_ok")


def _within(value: Column, how: str, w) -> Column:
    return {"last": lambda: F.last(value, ignorenulls=True), "max": lambda: F.max(value), "sum": lambda: F.sum(value)}[how]().over(w)


def _total(value: Column, how: str, order: Sequence[str]) -> Column:
    if how == "last":
        return F.max_by(value, F.when(value.isNotNull(), F.struct(*[F.col(c) for c in order])))
    return {"max": F.max, "sum": F.sum}[how](value)


def _combined(before: Column, own: Column, how: str) -> Column:
    """What the buckets before gave, and then the own bucket; nulls give nothing."""
    if how == "last":
        return F.coalesce(own, before)
    return F.greatest(before, own) if how == "max" else F.coalesce(before + own, before, own)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, value: str, out: str, how: str = "last",
            inclusive: bool = True, levels: Sequence[int] = (4096,)) -> DataFrame:
    """Add ``out``: the ``last`` non-null, the ``max`` or the ``sum`` of ``value`` over the key's rows up to each row.

    ``order`` has to be total within a key, and ``bucket`` (a whole number) must not fall along it.  Rows are windowed per
    (key, bucket); what the buckets before give is worked out in the same way from one row for each bucket, with
    ``levels`` buckets of buckets at a time, so that neither a hot key nor a table without keys is in one task.
    With ``inclusive=False`` a row's own value does not count.  Rows of a null key get what their bucket gives, no more.
    """
    keys, order, n = list(keys), list(order), len(levels)
    b, own, carry = f"__run_b{n}", f"__run_own{n}", f"__run_carry{n}"
    base = df.withColumn(b, bucket)
    rows = Window.partitionBy(*keys, b).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    inside = base.withColumn(own, _within(F.col(value), how, rows))
    sums = base.groupBy(*keys, b).agg(_total(F.col(value), how, order).alias(f"__run_sum{n}"))
    if levels:
        before = running(sums, keys, [b], F.floor(F.col(b) / levels[0]).cast("bigint"), f"__run_sum{n}", carry, how, False, levels[1:])
    else:
        w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
        before = sums.withColumn(carry, _within(F.col(f"__run_sum{n}"), how, w))
    joined = inside.join(before.drop(f"__run_sum{n}"), [*keys, b], "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], _combined(F.col(carry), F.col(own), how).alias(out))
