"""Order versions beyond the retention of job 6's stream come out as late rows."""

import json

from pyspark.sql import functions as F

from martflow.sources.envelope import parse_envelope
from martflow.sources.topics import read_topic
from martflow.streaming import jobs as S
from test_streaming import _run


def test_order_versions_beyond_the_default_bound_are_late_rows(spark, scratch):
    t0 = 1_700_000_000

    def change(table, kind, ts, old=None, **data):
        return json.dumps({"database": "d", "table": table, "type": kind, "ts": ts, "data": data, **({"old": old} if old else {})})

    def flush(i):
        tables = ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon")
        return [change(t, "insert", t0 + i * 100_000, id=f"flush{i}", order_id="none", order_detail_id="none") for t in tables]

    batches = [[change("order_detail", "insert", t0, id="d1", order_id="o1", source_type="2401"),
                change("order_detail_activity", "insert", t0, order_detail_id="d1", activity_id="a1"),
                change("order_info", "insert", t0 + 1, id="o1", order_status="1001"),
                change("order_info", "update", t0 + 900, {"order_status": "1001"}, id="o1", order_status="1002")],
               [change("order_info", "update", t0 + 2000, {"order_status": "1002"}, id="o1", order_status="1003")],
               flush(1), flush(2), flush(3), flush(4)]
    for i, lines in enumerate(batches):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{scratch}/db/batch={i}")
    stream, _ = parse_envelope(read_topic(spark, f"{scratch}/db", stream=True, options={"maxFilesPerTrigger": "1"}))
    out = S.order_pre_process_stream(stream)
    # filtered after the stream: before its watermarks the filter would hold them back
    _run(out.select("oi_id", "oi_order_status", "id", "act_activity_id", "late"), f"{scratch}/out", f"{scratch}/ck")
    got = sorted((r.oi_order_status, r.id, r.act_activity_id, r.late) for r in spark.read.parquet(f"{scratch}/out").filter(F.col("oi_id") == "o1").collect())
    assert got == [("1001", "d1", "a1", False), ("1002", "d1", "a1", False), ("1003", None, None, True)]
