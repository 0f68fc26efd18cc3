"""The nine warehouse jobs as batch plans over parsed inputs.

Each function builds a lazy plan; nothing runs until a sink or action.  The
streaming forms are in :mod:`martflow.streaming.jobs`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from martflow.operators import traffic, upsert


# ------------------------------------------------------------------ job 2
def base_log(raw: DataFrame, tz: str = "UTC", arrival: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Job 2: clean (P1) -> repair ``is_new`` per ``common.mid`` (O2) -> split
    into page / start / action / display / error texts (X1-X5); plus ``dirty``.

    ``arrival`` names the columns of ``raw`` that give the order of arrival; they break ties of the event time and pass
    to the outputs, as do ``mid``, ``ts`` and ``is_entry``.  Without them records of one
    visitor in the same millisecond have no order, and the repair may differ between runs.
    Records without ``common.mid`` or ``ts`` cannot be keyed: they go to ``dirty`` as they came.
    The plan is lazy; where several outputs are written, land the clean records first.
    """
    clean, dirty = traffic.keyed_log(raw, keep=arrival)
    return {**split_log(clean, tz, arrival), "dirty": dirty}


def split_log(clean: DataFrame, tz: str = "UTC", arrival: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The five outputs of job 2 from its clean records (:func:`traffic.keyed_log`)."""
    keep = ["mid", "ts", "is_entry", *arrival]
    out = traffic.split_open_log(traffic.repair_new_visitor(clean, order=["ts", *arrival], tz=tz), keep=keep)
    out["error"] = traffic.split_open_log(clean, keep=keep)["error"]  # the repair doesn't touch it
    return out


# ------------------------------------------------------------------ job 3
def unique_visitor_detail(page: DataFrame, tz: str = "UTC", arrival: Sequence[str] = ()) -> DataFrame:
    """Job 3: session entries (F7: no ``last_page_id``) -> first per (mid, day) (O3)."""
    return traffic.unique_visitor(page.filter("is_entry"), key="mid", ts="ts", order=["ts", *arrival], tz=tz).drop("visit_dt")


# ------------------------------------------------------------------ job 4
def user_jump_detail(page: DataFrame, within_ms: int = traffic.BOUNCE_WITHIN_MS, arrival: Sequence[str] = ()) -> DataFrame:
    """Job 4: entry followed by an entry, or by nothing, within the limit."""
    return traffic.user_jump(page, F.col("is_entry"), key="mid", ts="ts", order=["ts", *arrival], within_ms=within_ms)


# ------------------------------------------------------------------ job 1
def dim_sync(env: DataFrame, config_changes: DataFrame, *, order_cols: Sequence[str], as_of: str | None = None,
             config_seq: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Job 1: route dimension changes by the config and merge them per key.

    Returns ``({sink_table: merged rows}, rejected config rows)``.  With
    ``as_of`` (a data time column in the config's time unit) each change is
    routed by the config valid at its time; otherwise by the final config.
    ``order_cols`` order the changes of a key, arrival last; ``config_seq`` orders config changes of one millisecond.
    The config has a row for each source table: it is folded by Spark, its column
    lists are read on the driver to shape each dimension table (K5), at most ``upsert.MOST_DIMENSIONS``.
    """
    cfg, rejected = upsert.fold_config(config_changes, seq_col=config_seq)
    if as_of:
        routed = upsert.route_dimensions(env, upsert.config_intervals(config_changes, seq_col=config_seq),
                                         time_col=as_of)
    else:
        routed = upsert.route_dimensions(env, cfg)
    tables = {}
    for row in upsert.config_rows(cfg):
        cols = row["sink_columns"].split(",")
        part = routed.filter(F.col("sink_table") == row["sink_table"])
        merged = upsert.merge_columns(part, ["pk"], "data",
                                      [c for c in cols if c != row["sink_pk"]], list(order_cols))
        tables[row["sink_table"]] = merged.select(
            *[(F.col("pk") if c == row["sink_pk"] else F.col(c)).alias(c) for c in cols])
    return tables, rejected


def dim_sync_wide(env: DataFrame, config_changes: DataFrame, columns: list[str],
                  order_cols: Sequence[str]) -> DataFrame:
    """Job 1 as one table: every dimension row with ``sink_table``, ``id`` and
    the union of configured columns (nulls where a table lacks a column).

    One shuffle for all dimensions: the merge groups by (sink_table, key).
    """
    cfg, _ = upsert.fold_config(config_changes)
    routed = upsert.route_dimensions(env, cfg)
    merged = upsert.merge_columns(routed, ["sink_table", "pk"], "data", columns, list(order_cols))
    return merged.withColumnRenamed("pk", "id")
