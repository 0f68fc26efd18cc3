"""Streams of jobs 2, 3 and 4 in a session that names Spark's default state store."""

import json

import pytest

from martflow.session import ROCKSDB, STATE_STORE, column_family_state
from martflow.streaming import jobs as S

DEFAULT_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


@pytest.fixture()
def plain(spark):
    was = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, DEFAULT_STORE)
    yield spark
    spark.conf.set(STATE_STORE, was)


def _topic(spark, path, n=4):
    page = lambda mid, ts, last: json.dumps({"common": {"mid": mid, "is_new": "1"}, "page": {"page_id": "p"} | ({"last_page_id": last} if last else {}), "ts": ts})
    rows = [page(f"m{i}", 1_700_000_000_000 + i, None) for i in range(n)] + [page("m0", 1_700_000_001_000, "home"), page("-", 4_102_444_800_000, "-")]
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(path)
    return path


def _mids(spark, path):
    return sorted(json.loads(r.value)["common"]["mid"] for r in spark.read.text(path).collect())


def test_job_2_runs_on_the_default_store(plain, scratch):
    for q in S.base_log_stream(plain, _topic(plain, f"{scratch}/log"), f"{scratch}/out", checkpoint=f"{scratch}/ck"):
        q.awaitTermination()
    assert _mids(plain, f"{scratch}/out/page") == ["-", "m0", "m0", "m1", "m2", "m3"]
    assert plain.conf.get(STATE_STORE) == DEFAULT_STORE


def test_jobs_3_and_4_run_on_the_default_store(plain, scratch):
    topic = _topic(plain, f"{scratch}/page")
    S.unique_visitor_job_stream(plain, topic, f"{scratch}/uv", checkpoint=f"{scratch}/ck3", trigger={"availableNow": True}, ttl_ms=None).awaitTermination()
    S.user_jump_job_stream(plain, topic, f"{scratch}/uj", checkpoint=f"{scratch}/ck4").awaitTermination()
    assert _mids(plain, f"{scratch}/uv") == ["m0", "m1", "m2", "m3"]
    assert _mids(plain, f"{scratch}/uj") == ["m1", "m2", "m3"]


def test_a_store_that_was_chosen_stays(spark):
    was = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, "com.example.OwnProvider")
    try:
        with column_family_state(spark):
            assert spark.conf.get(STATE_STORE) == "com.example.OwnProvider"
    finally:
        spark.conf.set(STATE_STORE, was)
    assert was == ROCKSDB
