"""Joins of change streams with the log that they emit: J1, J2, K3 (retractions) and O6 (idle retention).

A stream join answers each arriving row at once.  A left row without a partner comes out with nulls; when
its first partner arrives that row is taken back (a tombstone in a keyed topic) and the joined row follows.  On a replay, where every row
has its place in the order of arrival, all of this has a closed form: each result row lives from one place to another.

* :func:`appended` gives rows of an append-only source their lives, :func:`inner` and :func:`left_outer` join them, and :func:`log`
  turns lives into the emitted log.  Everything is an equi-join on the key; no key's state is held in one task.
* :func:`idle_pairs` are the pairs that meet although state is dropped after ``idle`` without access.  A row's time counts from its
  arrival (``create``), or for the left side of a left join also from each partner's arrival that reads it (``read_write``).

The stream form is :class:`martflow.streaming.retracting.RetractingJoinProcessor`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from martflow.operators.joins import interval_join, lookup_as_of
from martflow.operators.sequence import bucketed_lag, running

FROM, TO = "row_from", "row_to"


def appended(df: DataFrame, place: Column) -> DataFrame:
    """Rows that arrive at ``place`` (a whole number) and are never taken back."""
    return df.withColumns({FROM: place.cast("bigint"), TO: F.lit(None).cast("bigint")})


def _alive() -> Column:
    return F.col(TO).isNull() | (F.col(FROM) < F.col(TO))


def inner(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """A pair lives from the later arrival to the earlier end.  Other columns must not clash."""
    r = right.withColumnsRenamed({FROM: "__from", TO: "__to"})
    j = left.join(r, left[left_key] == r[right_key])
    return j.withColumns({FROM: F.greatest(FROM, "__from"), TO: F.least(TO, "__to")}).drop("__from", "__to").filter(_alive())


def left_outer(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """As :func:`inner`, and each left row with nulls from its arrival to that of its key's first right row.

    ``right`` is append-only.  The first arrival of each key is one more row, found and made where the key's rows are joined, so
    both sides are shuffled and joined once.
    """
    rest = [c for c in right.columns if c not in (right_key, FROM, TO)]
    nth = F.row_number().over(Window.partitionBy(right_key).orderBy(F.col(FROM).asc_nulls_last()))
    rows = right.filter(F.col(right_key).isNotNull()).withColumn("__nth", nth)
    alone = F.when(F.col("__nth") == 1, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    both = rows.select(right_key, *rest, F.col(FROM).alias("__at"), F.explode(alone).alias("__alone"))
    j = left.join(both, left[left_key] == both[right_key], "left")
    single = F.coalesce("__alone", F.lit(True))  # the row with nulls
    j = j.filter(~F.coalesce("__alone", F.lit(False)) | (F.col("__at") > F.col(FROM)))
    start = F.when(single, F.col(FROM)).otherwise(F.greatest(FROM, "__at"))
    end = F.when(single, F.least(TO, "__at")).otherwise(F.col(TO))
    j = j.withColumns({FROM: start, TO: end, **{c: F.when(~single, F.col(c)) for c in (right_key, *rest)}})
    return j.drop("__at", "__alone").filter(_alive())


def log(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K3: the log of ``rows``: ``place``, ``tombstone`` and the columns, null in tombstones but for ``keys``.

    At one place, tombstones stand before rows.
    """
    columns = [c for c in rows.columns if c not in (FROM, TO)]
    each = F.explode(F.array(F.struct(F.col(FROM).alias("place"), F.lit(False).alias("tombstone")),
                             F.struct(F.col(TO).alias("place"), F.lit(True).alias("tombstone"))))
    out = rows.withColumn("__e", each).filter(F.col("__e.place").isNotNull())
    gone = F.col("__e.tombstone")
    return out.select("__e.place", "__e.tombstone", *[F.col(c) if c in keys else F.when(~gone, F.col(c)).alias(c) for c in columns])


# ---------------------------------------------------------------------- O6
def idle_pairs(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_at: str, right_at: str, idle: int,
               rule: str = "create") -> DataFrame:
    """The pairs of ``left`` and ``right`` that meet, if state is dropped ``idle`` time units after its last access.

    A right row is there for left rows that arrive less than ``idle`` after it.  A left row is there for
    right rows less than ``idle`` after it (``create``), or after the last right row of its key that read it (``read_write``).
    A right row of the same time arrives after the left row.  The columns of both sides must not clash.

    Under ``read_write`` a left row meets the rest of the session, of right rows with gaps under ``idle``, in which it
    falls or which begins less than ``idle`` after it.  Sessions are cut by bucketed windows, and found by an as-of join.
    """
    before = interval_join(left, right, left_key, right_key, left_at, right_at, 1 - idle, -1)
    if rule == "create":
        return before.unionByName(interval_join(left, right, left_key, right_key, left_at, right_at, 0, idle - 1))
    if rule != "read_write":
        raise ValueError("the rule is create or read_write")
    order = [right_at, *[c for c in right.columns if c not in (right_key, right_at)]]
    place = F.floor(F.col(right_at) / idle).cast("bigint")
    rows = bucketed_lag(right.filter(F.col(right_key).isNotNull()), [right_key], order, place, right_at, "__prev")
    rows = rows.withColumn("__begins", F.when(F.col("__prev").isNull() | (F.col(right_at) - F.col("__prev") >= idle), F.col(right_at)))
    rows = running(rows, [right_key], order, place, "__begins", "__session").drop("__prev", "__begins")
    sessions = rows.groupBy(F.col(right_key).alias("__sk"), F.col("__session").alias("__start")).agg(F.max(right_at).alias("__end"))
    sessions = sessions.withColumn("valid_from", F.col("__start") - idle + 1)
    found = lookup_as_of(left, sessions, left_key, "__sk", left_at, ["__start", "__end"], bucket=idle, small=False)
    found = found.filter(F.col(left_at) <= F.col("__end")).drop("__end")
    after = found.join(rows, (found[left_key] == rows[right_key]) & (found["__start"] == rows["__session"]) & (rows[right_at] >= found[left_at]))
    return before.unionByName(after.drop("__start", "__session"))


def idle_left_outer(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_at: str, right_at: str, idle: int,
                    rule: str = "read_write", left_id: str = "id") -> DataFrame:
    """J2 with O6: the lives of the rows of a left join whose state goes after ``idle``; ``left_id`` names a left row.

    A left row that meets no right row at its arrival lives alone until the first one that it meets, or for ever.
    """
    pairs = idle_pairs(left, right, left_key, right_key, left_at, right_at, idle, rule)
    rest = [c for c in right.columns]
    lived = appended(pairs, F.greatest(left_at, right_at))
    met = pairs.groupBy(F.col(left_id).alias("__id")).agg(F.min(F.greatest(left_at, right_at)).alias("__first"), F.min(right_at).alias("__least"))
    alone = left.join(met, left[left_id] == met["__id"], "left")
    alone = alone.filter(F.col("__least").isNull() | (F.col("__least") >= F.col(left_at)))  # none that was there before it
    alone = alone.withColumns({FROM: F.col(left_at).cast("bigint"), TO: F.col("__first").cast("bigint")}).drop("__id", "__first", "__least")
    # a right row of the same time comes next, so the row with nulls was emitted and taken back at that time
    return lived.unionByName(alone.withColumns({c: F.lit(None).cast(right.schema[c].dataType) for c in rest}))
