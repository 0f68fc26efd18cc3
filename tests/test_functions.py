"""Column helpers: dates (D1-D6), JSON tests (P1, P2, P6), casts (F5, F6, F8, F12), P5."""

import json

from pyspark.sql import functions as F

from martflow.functions import (as_bigint, decimal_product_text, delta_text, is_json_object,
                                map_json, previous_day_str, to_date_str, to_datetime_str, to_ts,
                                whitelist)
from martflow.sources.delimited import parse_delimited
from martflow.sources.envelope import ENVELOPE_SCHEMA, split_clean_dirty


def test_dates_gmt8(spark):
    df = spark.createDataFrame([(1645513497000,)], "ms bigint")
    r = df.select(to_datetime_str("ms", "GMT+8").alias("a"), to_date_str("ms", "GMT+8").alias("b"),
                  previous_day_str("ms", "GMT+8").alias("c"), to_date_str("ms").alias("d"),
                  to_ts(F.lit("2022-02-22 15:04:57")).alias("e"),
                  to_ts(F.lit("2022-02-22"), False).alias("f")).first()
    assert r.a == "2022-02-22 15:04:57"
    assert r.b == "2022-02-22" and r.c == "2022-02-21" and r.d == "2022-02-22"
    assert r.e == 1645513497000
    assert r.f == 1645459200000  # 2022-02-22 00:00 at GMT+8


def test_dates_do_not_depend_on_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = spark.range(1).select(to_datetime_str(F.lit(1645513497000), "GMT+8").alias("a")).first()
        assert r.a == "2022-02-22 15:04:57"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_decimal_text_and_casts(spark):
    df = spark.createDataFrame([("12.5", "3", "5", "2", "x")], "p string, n string, a string, b string, bad string")
    r = df.select(decimal_product_text("p", "n").alias("m"), delta_text("a", "b").alias("d"),
                  as_bigint("bad").alias("x")).first()
    assert r.m == "37.5000" and r.d == "3" and r.x is None


def test_json_object_test(spark):
    rows = [('{"a":1}',), ("{}",), ("[1]",), ("null",), ("",), ("bad",), (None,), ('"s"',)]
    df = spark.createDataFrame(rows, "value string")
    got = [r.ok for r in df.select(is_json_object("value").alias("ok")).collect()]
    assert got == [True, True, False, False, False, False, False, False]


def test_clean_dirty_and_control_records(spark):
    rows = [('{"type":"bootstrap-start"}',), ('{"type":"bootstrap-complete"}',),
            ('{"type":"bootstrap-insert","data":{"id":1}}',), ('{"data":{"id":2}}',), ("[1]",), ("x",)]
    raw = spark.createDataFrame(rows, "value string")
    clean, dirty = split_clean_dirty(raw, ENVELOPE_SCHEMA, route_control=True)
    assert sorted(r.type or "-" for r in clean.collect()) == ["-", "bootstrap-insert"]
    assert clean.filter(F.col("type").isNull()).first().data == {"id": "2"}  # numbers become text
    assert dirty.count() == 4


def test_whitelist_and_map_json(spark):
    df = spark.createDataFrame([({"id": "1", "name": "n", "x": "y", "z": None},)],
                               "m map<string,string>")
    r = df.select(whitelist("m", F.lit("id,name")).alias("w"), map_json("m").alias("j")).first()
    assert r.w == {"id": "1", "name": "n"}
    assert json.loads(r.j) == {"id": "1", "name": "n", "x": "y"}


def test_delimited(spark):
    lines = spark.createDataFrame([("1,a,10",), ("2,b",), ("3,c,zz",), ("4,d,40,extra",)], "value string")
    got = sorted(tuple(r) for r in parse_delimited(lines, ["id", "name", "ts"], {"ts": "bigint"}).collect())
    assert got == [("1", "a", 10), ("4", "d", 40)]


def test_parse_strict_fails_on_bad_text(spark):
    import pytest
    from martflow.sources.envelope import parse_strict
    good = spark.createDataFrame([('{"table":"t","ts":1}',)], "value string")
    assert parse_strict(good, ENVELOPE_SCHEMA).first().table == "t"
    bad = spark.createDataFrame([("{oops",)], "value string")
    with pytest.raises(Exception):
        parse_strict(bad, ENVELOPE_SCHEMA).collect()


def test_lists(spark):
    from martflow.functions.timefmt import join_list, split_list
    r = spark.createDataFrame([("id, name,x",)], "s string") \
        .select(split_list("s").alias("a"), join_list(split_list("s"), "|").alias("j")).first()
    assert r.a == ["id", " name", "x"] and r.j == "id| name|x"  # no trimming


def test_read_dictionary(spark, scratch):
    from martflow.sources.dictionary import read_dictionary
    from martflow.sources.tables import base_dic
    base_dic(spark).write.parquet(f"{scratch}/dic")
    d = read_dictionary(spark, f"{scratch}/dic")
    assert d.columns == ["dic_code", "dic_name", "parent_code", "create_time", "operate_time"]
    assert d.count() == 5
