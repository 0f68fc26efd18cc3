"""Traffic operators over behaviour logs: O2, O3, O4, X1-X5, U1.

Batch forms are closed forms of the per-key state machines (SURVEY 2.12),
written so that no key's whole history has to sit in one task:

* O2 repairs ``is_new`` from an aggregate per (key, day), joined on (key, day)
  with the flagged rows alone.
* O3 keeps the first row of each (key, date): one partial+final aggregate.
* O4 judges each entry by its true successor using windows over
  (key, time bucket) instead of (key): buckets are as wide as the pattern
  limit, and each row is also a look-ahead row of the bucket before.

Streaming forms live in :mod:`martflow.streaming.processors`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from martflow.functions.timefmt import previous_day_str, to_date_str
from martflow.operators.sequence import running
from martflow.sources.envelope import once

BOUNCE_WITHIN_MS = 15_000  # fixed value: pattern time limit of the bounce rule
OUT_OF_ORDER_MS = 2_000  # fixed value: how far the bounce job's watermark stays behind the newest event time


def _order(order: Sequence[str] | None, ts: str) -> list[str]:
    return list(order) if order else [ts]


# --------------------------------------------------------------------- O2
def repair_new_visitor(df: DataFrame, key: str = "mid", ts: str = "ts",
                       is_new: str = "is_new", order: Sequence[str] | None = None,
                       tz: str = "UTC") -> DataFrame:
    """O2: new-visitor flag repair.  Row count and columns are preserved.

    Per key, the first record in ``order`` fixes the first-visit date:
    ``date(ts)`` if it says ``is_new='1'``, else ``date(ts - 1 day)``.  Every
    later ``is_new='1'`` record on a *different* date becomes ``'0'``.
    Rows with a null key pass unchanged (they share no state).

    Plan: one aggregate to a row per (key, day) with map-side partial aggregation; a
    window over a key's days finds its first date.  Only rows with
    ``is_new='1'`` can change: they alone are joined, on (key, day), with the days to
    be zeroed, so a hot key is spread over its days and the exchange lies
    right under the join, where AQE can split what is left.
    """
    order = _order(order, ts)
    visit = to_date_str(F.col(ts), tz)
    flag = F.coalesce((F.col(is_new) == "1") & F.col(key).isNotNull(), F.lit(False))
    seed = F.when(F.col(is_new) == "1", visit).otherwise(previous_day_str(F.col(ts), tz))
    days = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__k"), visit.alias("__d")).agg(
        F.min(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], seed.alias("seed"))).alias("__first"),
        F.max(flag).alias("__flag"))
    first = F.min("__first").over(Window.partitionBy("__k"))["seed"]
    zero = days.withColumn("__dt", first).filter(F.col("__flag") & (F.col("__d") != F.col("__dt"))) \
        .select("__k", "__d", F.lit(True).alias("__zero"))
    flagged = df.filter(flag).withColumn("__day", visit)
    j = flagged.join(zero, (flagged[key] == zero["__k"]) & (flagged["__day"] == zero["__d"]), "left")
    fixed = F.when(F.col("__zero"), F.lit("0")).otherwise(F.col(is_new))
    j = j.select(*[fixed.alias(c) if c == is_new else F.col(c) for c in df.columns])
    return df.filter(~flag).unionByName(j)


# --------------------------------------------------------------------- O3
def unique_visitor(df: DataFrame, key: str = "mid", ts: str = "ts",
                   order: Sequence[str] | None = None, tz: str = "UTC",
                   date_col: str = "visit_dt") -> DataFrame:
    """O3: daily unique visitor -- emit a row when the key's previous row
    (in arrival order) has no date or another date.

    With arrival order = ``order`` (time first) the date never decreases along
    a key, so the emitted rows are exactly the first row of each
    (key, date).  One hash-partitioned aggregate with map-side partial
    aggregation; a hot key is spread over its dates and pre-reduced per task.
    Output: the input columns plus ``date_col``.
    """
    order = _order(order, ts)
    if order[0] != ts:
        raise ValueError("batch O3 needs arrival order led by the event time; "
                         "use unique_visitor_by_arrival for another order")
    d = df.withColumn(date_col, to_date_str(F.col(ts), tz))
    rest = [c for c in d.columns if c not in (key, date_col)]
    first = d.groupBy(key, date_col).agg(
        F.min_by(F.struct(*[F.col(c) for c in rest]),
                 F.struct(*[F.col(c) for c in order])).alias("__r"))
    return first.select(*[F.col(key) if c == key else F.col(date_col) if c == date_col
                          else F.col("__r." + c).alias(c) for c in d.columns])


def unique_visitor_by_arrival(df: DataFrame, key: str, ts: str, arrival: str,
                              tz: str = "UTC", date_col: str = "visit_dt",
                              bucket: int = 1 << 16) -> DataFrame:
    """O3 when arrival order is not time order (out-of-order replay).

    ``arrival`` is a numeric arrival position (offset, sequence).  Emits a
    row when the key's previous row *in arrival order* has no date or
    another date.  Two levels, so no window holds a key's whole history:

    1. rows are windowed per (key, ``floor(arrival / bucket)``): the
       previous row inside the bucket;
    2. a per-(key, bucket) summary (last date by arrival) is windowed per key
       over buckets -- one small row per bucket -- and gives the first row
       of each bucket its predecessor: the last row of the key's previous
       non-empty bucket.
    """
    d = df.withColumn(date_col, to_date_str(F.col(ts), tz)) \
        .withColumn("__b", F.floor(F.col(arrival) / F.lit(bucket)).cast("bigint"))
    w = Window.partitionBy(key, "__b").orderBy(F.col(arrival))
    d = d.withColumn("__prev", F.lag(date_col).over(w)) \
        .withColumn("__first", F.lag(arrival).over(w).isNull())
    last = d.groupBy(key, "__b").agg(F.max_by(F.col(date_col), F.col(arrival)).alias("__last"))
    wb = Window.partitionBy(key).orderBy("__b")
    carry = last.withColumn("__carry", F.lag("__last").over(wb)).select(key, "__b", "__carry")
    j = d.join(carry, [key, "__b"], "left")
    prev = F.when(F.col("__first"), F.col("__carry")).otherwise(F.col("__prev"))
    return j.filter(prev.isNull() | (prev != F.col(date_col))) \
        .select(*df.columns, date_col)


# --------------------------------------------------------------------- O4
def user_jump(df: DataFrame, is_entry: Column, key: str = "mid", ts: str = "ts",
              order: Sequence[str] | None = None,
              within_ms: int = BOUNCE_WITHIN_MS, with_kind: bool = False) -> DataFrame:
    """O4 + U1: bounce detection.

    An entry row is emitted (match or timeout, both emit the entry) unless
    the key's very next row in ``order`` is a non-entry less than
    ``within_ms`` later.  Equality counts as timeout.

    Plan: rows are bucketed by ``floor(ts / within_ms)``; a successor that
    can stop a bounce lies in the same or the next bucket.  Each row goes to
    its own bucket and, stripped to the order columns and the entry flag, to
    the one before: one scan, one exchange, and no window holds a key's whole history.
    """
    order = _order(order, ts)
    if order[0] != ts:
        raise ValueError("order must be led by the event time column")
    ordk = [F.col(c) for c in order]
    b = F.floor(F.col(ts) / F.lit(within_ms)).cast("bigint")
    own, needed = F.col("__at.own"), {key, *order}
    both = df.withColumn("__entry", F.coalesce(is_entry.cast("boolean"), F.lit(False))) \
        .withColumn("__at", F.explode(F.array(F.struct(b.alias("b"), F.lit(True).alias("own")),
                                              F.struct((b - 1).alias("b"), F.lit(False).alias("own"))))) \
        .select(*[F.col(c) if c in needed else F.when(own, F.col(c)).alias(c) for c in df.columns],
                "__entry", F.col("__at.b").alias("__b"), own.alias("__own"))
    w = Window.partitionBy(key, "__b").orderBy(*ordk)
    nxt_ts = F.lead(ts).over(w)
    nxt_entry = F.lead("__entry").over(w)
    judged = both.withColumn("__nts", nxt_ts).withColumn("__nentry", nxt_entry)
    bounce = F.col("__own") & F.col("__entry") & (
        F.col("__nts").isNull() | ((F.col("__nts") - F.col(ts)) >= F.lit(within_ms))
        | F.col("__nentry"))
    out = judged.filter(bounce)
    if with_kind:
        kind = F.when(F.col("__nts").isNotNull() & ((F.col("__nts") - F.col(ts)) < F.lit(within_ms)),
                      F.lit("match")).otherwise(F.lit("timeout"))
        return out.select(*df.columns, kind.alias("jump_kind"))
    return out.select(*df.columns)


# ----------------------------------------------------------------- W1, W5
def with_watermark(df: DataFrame, arrival: Sequence[str], bucket: Column, ts: str = "ts", delay_ms: int = OUT_OF_ORDER_MS,
                   out: str = "watermark") -> DataFrame:
    """W1 on a replay: the watermark that each row meets as it arrives, null for the first.

    It is the newest event time of all rows before (of any key), less the delay and one millisecond.  ``arrival`` is a total order
    and ``bucket`` does not fall along it; the maximum is carried over buckets (:func:`running`), so no task orders all rows.
    """
    newest = running(df, [], list(arrival), bucket, ts, "__newest", "max", inclusive=False)
    return newest.withColumn(out, F.col("__newest") - F.lit(delay_ms + 1)).drop("__newest")


def split_late(df: DataFrame, arrival: Sequence[str], bucket: Column, ts: str = "ts", delay_ms: int = OUT_OF_ORDER_MS) -> tuple[DataFrame, DataFrame]:
    """``(on_time, late)``: a row at or before the watermark that it meets is late, and the pattern ignores it."""
    marked = with_watermark(df, arrival, bucket, ts, delay_ms, "__wm")
    late = F.coalesce(F.col(ts) <= F.col("__wm"), F.lit(False))
    return marked.filter(~late).drop("__wm"), marked.filter(late).drop("__wm")


def user_jump_matches_and_timeouts(df: DataFrame, is_entry: Column, key: str = "mid",
                                   ts: str = "ts", order: Sequence[str] | None = None,
                                   within_ms: int = BOUNCE_WITHIN_MS):
    """O4 before U1: ``(matches, timeouts)``.

    A *match* is an entry followed directly by an entry within the limit; a
    *timeout* is an entry with no successor within the limit.  Their union
    (U1) is :func:`user_jump`.
    """
    judged = user_jump(df, is_entry, key, ts, order, within_ms, with_kind=True)
    cols = [c for c in judged.columns if c != "jump_kind"]
    return (judged.filter(F.col("jump_kind") == "match").select(*cols),
            judged.filter(F.col("jump_kind") == "timeout").select(*cols))


# ------------------------------------------------------------------ X1-X5
# Open records: fields are read and replaced by name, all others pass on as they came.
def keyed_log(raw: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """P1 for job 2: ``(clean, dirty)``; clean has ``keep``, the text, and the
    fields the jobs read: ``mid``, ``is_new``, ``ts``, ``is_entry`` (F7).

    Dirty: text that is no JSON object, and records without ``common.mid`` or ``ts``.
    """
    tagged = raw.select(*keep, F.col(value), once(F.try_parse_json(F.col(value))).alias("__v"))
    get = lambda path, kind: F.try_variant_get("__v", path, kind)
    rows = tagged.select(*keep, F.col(value).alias("value"), once(F.struct(
        get("$.common.mid", "string").alias("mid"), get("$.common.is_new", "string").alias("is_new"),
        get("$.ts", "bigint").alias("ts"), get("$.page.last_page_id", "string").isNull().alias("is_entry"))).alias("__f"))
    rows = rows.select(*keep, "value", "__f.*")
    ok = F.col("mid").isNotNull() & F.col("ts").isNotNull()
    return rows.filter(ok), rows.filter(~ok).select(*keep, "value")


def _put(record: Column, **fields: Column) -> Column:
    """The map with fields set; a null removes the field, as the serialiser of the source system does."""
    names = [F.lit(k) for k in fields]
    rest = F.map_filter(record, lambda k, v: ~k.isin(*names))
    put = F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v)])
    return F.map_filter(F.map_concat(rest, put), lambda k, v: v.isNotNull() & ~F.is_variant_null(v))


def _text(record: Column) -> Column:
    """JSON text of a map of variants, keys in order."""
    return F.to_json(F.to_variant_object(record))


def split_open_log(log: DataFrame, fixed: str = "is_new", keep: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The records of the five outputs as text (``value``), each with ``keep``.

    * ``error``:   the ``err`` object alone, of every record that has one (X1)
    * ``start``:   the record without ``err`` if it has ``start`` (X2)
    * ``action``:  each element of a page record's ``actions``, with the
      record's ``common``, ``ts`` and ``page`` put into it (X3)
    * ``display``: likewise for ``displays`` (X4)
    * ``page``:    the record without ``err``, ``actions``, ``displays`` (X5)

    ``fixed`` names the repaired ``common.is_new`` (null: leave it).
    """
    void = F.lit(None).cast("variant")
    as_map = lambda v: F.try_variant_get(v, "$", "map<string,variant>")
    elements = lambda name: F.try_variant_get(F.col("__m")[name], "$", "array<map<string,variant>>")
    rec = log.select(*log.columns, once(as_map(F.try_parse_json("value"))).alias("__m"))
    common = as_map(F.col("__m")["common"])
    common = F.when(F.col(fixed).isNotNull(), F.to_variant_object(_put(common, is_new=F.col(fixed).cast("variant")))) \
        .otherwise(F.col("__m")["common"])
    err = F.col("__m")["err"]
    present = lambda c: c.isNotNull() & ~F.is_variant_null(c)
    error = rec.filter(present(err)).select(*keep, F.to_json(err).alias("value"))
    rec = rec.select(*keep, once(_put(F.col("__m"), common=common, err=void)).alias("__m"))
    is_start = F.coalesce(present(F.col("__m")["start"]), F.lit(False))
    start = rec.filter(is_start).select(*keep, _text(F.col("__m")).alias("value"))
    pages = rec.filter(~is_start)

    def each(name: str) -> DataFrame:
        m = F.col("__m")
        rows = pages.select(*keep, "__m", F.explode(elements(name)).alias("__e"))
        return rows.select(*keep, _text(_put(F.col("__e"), common=m["common"], ts=m["ts"], page=m["page"])).alias("value"))

    page = pages.select(*keep, _text(_put(F.col("__m"), actions=void, displays=void)).alias("value"))
    return {"page": page, "start": start, "action": each("actions"), "display": each("displays"), "error": error}
