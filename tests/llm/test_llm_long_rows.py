"""Hostile rows: many spans, long hosts, long lists, one id or row many times."""

import time
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from martflow.llm import ann, mixing, secrets, url_filter


def test_many_spans_in_one_text(spark):
    n = 20_000
    secret = lambda i: f"password={'é' if i % 7 == 0 else 'x'}secret{i}"
    text = "start " + " mid ".join(secret(i) for i in range(n)) + " end"
    found = secrets.find_secrets(spark.createDataFrame([(1, text), (2, "clean"), (3, None)], "doc_id long, text string"))
    got = {r.doc_id: r for r in found.select("row.doc_id", "spans", secrets.redacted(found).alias("out")).collect()}
    want, at = [], 0
    for i in range(n):  # the expression ends at a letter that it does not take
        if i % 7:
            start = text.index(secret(i), at)
            want.append((start, start + len(secret(i))))
            at = want[-1][1]
    assert [(s.start, s.end) for s in got[1].spans] == want
    parts, at = [], 0
    for a, b in want:
        parts += [text[at:a], "[assign]"]
        at = b
    assert got[1].out == "".join(parts) + text[at:] and got[2].out == "clean" and got[3].out == ""


def test_a_long_host_asks_for_few_entries(tmp_path):
    d = url_filter.DigestList(url_filter.digest_files(url_filter.RULES, str(tmp_path)))
    host = "a." * 500_000 + "example.net"
    tracemalloc.start()
    began = time.perf_counter()
    assert d.longest([(host, "/en/x"), ("example.net", "/x"), ("net.", "/"), ("xexample.com", "/de/")]) == \
        [("example.net/en/", "allow"), ("net/", "block"), None, None]
    assert time.perf_counter() - began < 5 and tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()


def test_a_list_of_several_files(tmp_path):
    entries = {f"h{i}.example/p{i % 3}/": "block" if i % 2 else "allow" for i in range(100)} | {"example/": "block"}
    paths = url_filter.digest_files(entries, str(tmp_path), 600)
    assert len(paths) > 5
    several, one = url_filter.DigestList(paths), url_filter.DigestList(url_filter.digest_files(entries, str(tmp_path)))
    asked = [(f"www.h{i}.example", f"/p{i % 4}/x") for i in range(120)] + [("", ""), ("other", "/")]
    assert several.longest(asked) == one.longest(asked) and several.longest(asked)[3] is not None


def test_one_id_many_times_is_dealt_over_cells(spark):
    rows = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("a b c t"), F.col("id").cast("string")).alias("text"), F.lit("s").alias("source"))
    assert mixing.with_cells(rows, "doc_id", "text", "source").select("skey", "octave", "lead", "digit").distinct().count() > 100
    same = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    for carry in (True, False):
        got = mixing.sampled(same, carry=carry)
        assert got.count() == 3000 and got.agg(F.sum(F.col("copies") * F.col("size"))).first()[0] in range(13_497, 13_504)
    assert mixing.emitted(mixing.sampled(same)).count() in range(4499, 4502)


def test_rows_that_differ_in_another_column_stay_apart(spark):
    rows = [(1, "a b", "s", lang) for lang in ("en", "de", None)] * 2
    got = mixing.sampled(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"))
    assert sorted(str(r.row.lang) for r in got.collect()) == sorted(str(r[3]) for r in rows)


def test_a_query_visits_few_leaves(spark, monkeypatch):
    """Verified at a depth of five: the rounds shrink the radius, and recall stays."""
    draw = np.random.default_rng(2)
    centre = draw.normal(size=(60, 32))
    v = centre[draw.integers(0, 60, 6000)] + 0.3 * draw.normal(size=(6000, 32))
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "LEAF_ROWS", 200)
    monkeypatch.setattr(ann, "ROUNDS", (3, 9, 17))
    visits = []
    real = ann._visit
    monkeypatch.setattr(ann, "_visit", lambda q, *a: (visits.append((staged := ann.staged(q, "asked")).count()), real(staged, *a))[1])
    got = {}
    for r in ann.nearest(df, df.filter("vec_id % 100 = 0")).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    hits = 0
    for q in range(0, 6000, 100):
        d = ((v - v[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len(set(np.argsort(d)[:10].tolist()) & set(got[q]))
    assert len(visits) == 5 and visits[0] == 60 and sum(visits) < 0.6 * 60 * 32 and hits >= 0.9 * 600
