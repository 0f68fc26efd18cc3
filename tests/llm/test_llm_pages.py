"""Page and vector operators against brute force and on odd inputs."""

import html
import math
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from martflow.llm import ann, html_text, queries, url_filter


# --------------------------------------------------------------------- text
def test_main_text_is_the_whole_article(spark):
    pages = dict(duckdb.connect().sql(f"SELECT page_id, html FROM '{SF001}/pages.parquet'").fetchall())
    rows = queries.op3_html_text(spark, SF001).collect()
    assert len(rows) == len(pages)
    for r in rows:
        page = pages[r.page_id]
        article = page[page.index("<article>") + 9:page.index("</article>")].replace("<br>", " ")
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", "", x))).strip() for x in re.split(r"</?(?:p|h1)[^>]*>", article)]
        assert r.text == "\n\n".join(x for x in parts if x) and r.n_chars == len(r.text)


PAGE = """<html><head><title>T</title></head><body><header><h1>Site</h1></header><div class="topMenu"><a>m</a></div>
<div id="content"><h2>Head &amp; line</h2><p>A first paragraph, with words; and more, as articles have.<p>Second
 paragraph, <a href="x">linked</a>, goes on.</p><ul><li>point one.</li><li>point two.</li></ul><table><tr><td>cell a<td>cell b</table>
<div class="comments"><p>I disagree, wholly; and at length, so much that this comment is the longest text on the page, by far.</p></div>
<div style="display: none">hidden</div></div><aside>side</aside><form><label>mail</label></form><div class="cookie-notice">cookies</div>
<div class="ad">Buy, buy.</div><script>var x = "<p>no</p>";</script><footer>foot</footer></body></html>"""


def test_page_without_article_element():
    assert html_text.content(PAGE).split("\n\n") == [
        "Head & line", "A first paragraph, with words; and more, as articles have.", "Second paragraph, linked, goes on.",
        "point one.", "point two.", "cell a", "cell b"]


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("bare &lt;text&gt;", "bare <text>"), ("<article><p>cut off he", "cut off he"),
    ("<article><p>a<b>b</p>c</article>", "ab\n\nc"), ("<article>x<!-- no --> y<![CDATA[<z>]]></article>", "x y<z>"),
    ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"), ("<article><h1>T</h1><nav>n</nav><p>t\u00a0u\x0b</p></article>", "T\n\nt u"),
    ('<p>x</p><a href="un', "x"), ("</div></p><p>stray</p>", "stray")])
def test_odd_pages(page, text):
    assert html_text.content(page) == text


def test_pages_odd_inputs(spark):
    long = "<article>" + "<p>word, word.</p>" * 20_000 + "</article>"
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", long)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit("clash"))
    got = html_text.main_text(df).collect()
    assert len(got) == 4 and {r.n_chars for r in got if r.page_id == 2} == {len("\n\n".join(["word, word."] * 20_000))}
    assert [(r.text, r.n_chars) for r in got if r.page_id is None] == [("", 0)]
    assert html_text.main_text(df.limit(0)).count() == 0


# ---------------------------------------------------------------------- url
def judge(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")

    def fits(entry):
        h, _, rest = entry.partition("/")
        return (host == h or host.endswith("." + h)) and ("/" + rest, path)

    found = [e for e in url_filter.RULES if (f := fits(e)) and f[1].startswith(f[0])]
    rule = max(found, key=len, default=None)
    listed = any((f := fits(e)) and (f[1] or "/").startswith(f[0]) for e in url_filter.BLOCKED)
    return host, path, rule, url_filter.RULES[rule] if rule else "block" if listed else "allow"


URLS = [None, "", "no scheme", "http://", "http://a.net", "http://a.net/", "HTTPS://WWW.Example.NET/en/x?q#f", "http://example.net/EN/", "http://notexample.net/en/",
        "http://m.example.com/de/1", "http://example.com/de", "http://x.org/fr/", "http://org/fr/", "http://net/?", "ftp://free-bets.example.com",
        "http://www.spam-farm.example.org/fr/1", "http://É.example.com/de/", "x://y://z.net/", "http://a.b.c.d.e.net/" + "p" * 50_000]


def test_urls_equal_brute_force(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet").select("page_id", "url")
    odd = spark.createDataFrame([(None if i == 3 else -i, u) for i, u in enumerate(URLS + URLS[:3])], "page_id long, url string")
    df = pages.unionByName(odd).withColumn("host", F.lit("clash"))
    want = sorted(((r.page_id, *judge(r.url)) for r in df.collect()), key=str)
    assert sorted(map(tuple, url_filter.judge(df).collect()), key=str) == want
    assert url_filter.judge(df.limit(0)).count() == 0


def test_colliding_digests_are_told_apart(tmp_path, monkeypatch):
    class Same:
        @staticmethod
        def xxh64_intdigest(text):
            return 7

    monkeypatch.setattr(url_filter, "xxhash", Same)
    found = url_filter.Digests(url_filter.digest_file({"a/": "block", "b/": "allow"}, str(tmp_path)))
    assert found.find(["b/", "a/", "c/"]) == ["allow", "block", None]


# ---------------------------------------------------------------------- ann
def brute(rows, queries_, k=10):
    out = {}
    for q, v in queries_:
        d = sorted((math.sqrt(float(((np.asarray(v, float) - np.asarray(w, float)) ** 2).sum())), i) for i, w in rows if i != q)
        out[q] = d[:k]
    return out


def test_neighbours_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF_ROWS", 64)  # a deep tree, so that leaves and the stop take part
    monkeypatch.setattr(ann, "BLOCK_ROWS", 32)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 4)
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in e.collect()]
    near = brute(rows, [(i, v) for i, v in rows if i % 100 == 0])
    got = {}
    for r in ann.nearest(e, e.filter("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert set(got) == set(near) and all(len(x) == 10 and x == sorted(x) for x in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in near[q]}) for q in near)
    assert hits >= 0.9 * 10 * len(near)
    exact = {i: v for i, v in rows}
    for q, found in got.items():
        for s, i in found:
            assert s == pytest.approx(math.dist(exact[q], exact[i]), rel=1e-12)


def test_neighbours_odd_inputs(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [1.0, None]),
            (7, [float("inf"), 1.0]), (8, [0.0, 1.0]), (None, [1.0, 1.0]), (9, [1.0, 2.0, 3.0]), (100, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash")).withColumn("rank", F.lit("clash"))
    got = [(r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in ann.nearest(df, df.filter("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()]
    root5 = round(math.sqrt(5), 6)
    assert got == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 8, round(math.sqrt(2), 6)), (0, 4, 100, root5),
                   (100, 1, 8, 1.0), (100, 2, 0, root5), (100, 3, 1, root5), (100, 4, 2, root5)]
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_copies_of_one_vector_go_to_the_smaller_ids(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 50)
    df = spark.range(1000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, F.array(F.lit(1.0), F.lit(2.0)))
                                  .otherwise(F.array(F.col("id").cast("double") + 5, F.lit(-1.0))).alias("embedding"))
    got = ann.nearest(df, df.filter("vec_id = 300")).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(3 * i, 0.0) for i in range(10)]


def test_chi_square_quantile():
    assert ann.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert ann.chi_square_quantile(0.99, 4) == pytest.approx(13.277, abs=1e-3)
