"""Job 5 parses a record once, into the fields it reads, and its topic is the same text as before."""

import json

from pyspark.sql import functions as F

from martflow.functions.jsonfn import is_json_object
from martflow.operators import trade
from martflow.sources import tables as T
from martflow.sources.envelope import CONTROL_TYPES, ENVELOPE_SCHEMA, parse_envelope, read_changes

ODD = ['{"table":"t","type":"insert","ts":1,"data":{"id":"1","n":2,"o":{"a":[1]},"z":null}}', ' {"table":"t","ts":1}', '{"table":"t"} tail', "{'table':'t'}",
       '{"table":"t","ts":"no","data":{"id":"1"}}', '{"table":"t","x":NaN}', '{"table":"t","ts":-Infinity}', '{"table":"t","data":{"id":"a\tb"},"ts":1}', '{"table":"t","data":[1]}',
       '{"table":"t","data":{"id":"1"', '[{"table":"t"}]', "[1]", "1", '"t"', "null", "", "{}", "{", '{"type":"bootstrap-start"}', '{"type":"bootstrap-insert"}',
       '{"__unparsed":"x","table":"t"}', '{"table":"t","ts":99999999999999999999}', None]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_records_parsed_at_once_are_those_tested_before(spark, tmp_path):
    spark.createDataFrame([(v,) for v in ODD], "value string").write.parquet(str(tmp_path / "in"))
    raw = spark.read.parquet(str(tmp_path / "in"))
    tested = raw.filter(is_json_object("value")).select(F.from_json("value", ENVELOPE_SCHEMA).alias("r")).select("r.*")
    tested = tested.filter(~F.coalesce(F.col("type").isin(*CONTROL_TYPES), F.lit(False)))
    clean, dirty = parse_envelope(raw)
    assert sorted(map(str, clean.collect())) == sorted(map(str, tested.collect()))
    bad = raw.filter(~is_json_object("value") | F.coalesce(F.get_json_object("value", "$.type").isin(*CONTROL_TYPES), F.lit(False)))
    assert sorted(map(str, dirty.collect())) == sorted(map(str, bad.collect()))
    # the text is no longer tested for an object before it is parsed
    plan = _plan(clean)
    assert plan.count("from_json(") == 1 and plan.index("jsonObjectKeys(") < plan.index("from_json(")


def test_cart_add_parses_only_its_fields(spark, tmp_path):
    rows = [("insert", "2", None, "A"), ("update", "5", {"sku_num": "2"}, "A"), ("update", "3", {"sku_num": "5"}, "A"), ("update", "9", {"x": "1"}, "A"),
            ("insert", None, None, "A"), ("insert", "1", None, None), ("insert", "x", None, "Z"), ("delete", "1", None, "A"), ("update", "4", None, "A")]
    lines = [json.dumps({"table": "cart_info", "type": t, "ts": i, "data": {"id": str(i), "sku_num": n, "source_type": s, "more": {"a": 1}}} | ({"old": o} if o else {}))
             for i, (t, n, o, s) in enumerate(rows)]
    spark.createDataFrame([(v,) for v in [*lines, '{"table":"cart_info","type":"insert","ts":1,"data":"no"}', '{"table":"cart_info"']], "value string") \
        .write.parquet(str(tmp_path / "in"))
    raw = spark.read.parquet(str(tmp_path / "in"))
    dic = spark.createDataFrame([("A", "source A"), ("Z", "source Z")], "dic_code string, dic_name string")
    narrow = trade.cart_add(read_changes(raw, data=trade.CART_KEYS, old=trade.CART_OLD_KEYS)[0], dic).drop("pt")
    wide = trade.cart_add(parse_envelope(raw)[0], dic).drop("pt")
    assert "map<string,string>" not in read_changes(raw, data=trade.CART_KEYS, old=trade.CART_OLD_KEYS)[0].schema.simpleString()
    assert narrow.columns == wide.columns
    got = sorted(map(str, narrow.collect()))
    assert got == sorted(map(str, wide.collect())) and len(got) == 4


def test_cart_lines_are_the_rendered_changes(spark):
    li = spark.sql("""SELECT * FROM VALUES (1L, 10L, 100L, 1, 3D, 1.5D, 0D, 0D, 'A', TIMESTAMP_NTZ '1996-01-02 00:00:00'),
        (1L, 11L, 100L, 1, 5D, 2D, 0D, 0D, 'q"\\\\', TIMESTAMP_NTZ '1996-01-03 10:11:12'), (1L, 11L, 101L, 1, NULL, NULL, 0D, 0D, NULL, TIMESTAMP_NTZ '1996-01-04 00:00:00'),
        (1L, 11L, 101L, 1, 7D, 2D, 0D, 0D, 'N', TIMESTAMP_NTZ '1996-01-05 00:00:00'), (NULL, NULL, NULL, NULL, 7D, 1e9D, 0D, 0D, 'é', NULL)
        AS (l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_shipdate)""")
    record = F.to_json(F.struct("database", "table", "type", "ts", "data", "old")).alias("value")
    want = sorted(r.value for r in T.cart_changes(li).select(record).collect())
    assert sorted(r.value for r in T.cart_lines(li).collect()) == want and len(want) == 5
