"""Whole results where an earlier round's code fell short."""

import base64
import random

import math

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from conftest import SF001
from martflow.llm import ann, html_text, lang_crf, near_dup, toxicity
from test_llm_documents import DOCS


# ------------------------------------------------------------------ secrets
def test_private_keys_are_redacted_whole(spark):
    key = base64.b64encode(random.Random(1).randbytes(1190)).decode()
    lines = [key[i:i + 64] for i in range(0, len(key), 64)]
    assert lines[-1].endswith("=") and len(lines[-1]) < 64
    pem = lambda sep, kind="RSA ": f"-----BEGIN {kind}PRIVATE KEY-----{sep}{sep.join(lines)}{sep}-----END {kind}PRIVATE KEY-----"
    fields = "\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00FF00FF\n\n"
    begin = "-----BEGIN PRIVATE KEY-----"
    texts = {1: (f"a é😀 {pem(chr(10))} z", "a é😀 [private_key] z"),
             2: (f"a {pem(chr(92) + 'n', '')} z", "a [private_key] z"),
             3: (f"a {begin}\r\n" + "\r\n".join(lines) + "\r\nSome words follow.", "a [private_key]\r\nSome words follow."),
             4: (f"a {begin}{fields}" + "\n".join(lines[:-1] + ["abcDEF"]) + "\nSome words follow.", "a [private_key]\nSome words follow."),
             5: (f"a {begin} is the first line, and so on.", "a [private_key] is the first line, and so on."),
             6: (f"a {begin}\n{lines[0]}", "a [private_key]"),
             7: (f"{pem(chr(10))} and {pem(' ')}", "[private_key] and [private_key]")}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, (t, _) in texts.items()], DOCS)
    for r in P.secret_scan(spark, docs, SF001).collect():
        assert r.text == texts[r.doc_id][1] and r.n_chars == len(r.text), r.doc_id


# ----------------------------------------------------------------- language
def test_symbols_above_the_first_plane_are_no_letters(spark):
    rows = [(3 * i, f"the cat and the dog number {w}", "en", "s", 1) for i, w in enumerate("one two three four five six seven eight".split())]
    rows += [(100 + 3 * i, f"der Hund und die Katze Nummer {w}", "de", "s", 1) for i, w in enumerate("eins zwei drei vier acht".split())]
    plain, mixed = "the dog and the cat", "😀😀 the dog 🎉🎉🎉 and 🚀 the cat 😀"
    rows += [(900, "😀🎉 🚀", "en", "s", 4), (901, plain, "en", "s", 1), (902, mixed, "en", "s", 1), (903, "𝒳 𠀀𠀁", "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in lang_crf.identify(docs).collect()}
    assert (got[900].lang_pred, got[900].score) == ("und", 0.0)
    assert (got[901].lang_pred, got[901].score) == (got[902].lang_pred, got[902].score)
    assert got[903].lang_pred != "und"  # letters above U+FFFF stay letters
    assert 900 not in {r.doc_id for r in P.language(spark, docs, SF001).collect()}


def test_clean_documents_of_three_languages_are_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    text = {r.lang: r.text for r in docs.groupBy("lang").agg(F.max_by("text", F.length("text")).alias("text")).collect()}
    pieces = lambda langs: "\n".join(" ".join(text[x].split()[:60]) for x in langs)
    langs = sorted(text)
    assert len(langs) >= 3
    more = spark.createDataFrame([(10**9 + 1, pieces(langs[:3]), None, "s", 1), (10**9 + 2, pieces(langs), None, "s", 1)], DOCS)
    scores = lang_crf.predict(more, lang_crf.train(docs), "text", ["doc_id"]).collect()
    assert min(r.score for r in scores) < P.LEAST_LANGUAGE < min(r.sure for r in scores)
    kept = {r.doc_id for r in P.language(spark, docs.unionByName(more), SF001).select("doc_id").collect()}
    assert {10**9 + 1, 10**9 + 2} <= kept


# ---------------------------------------------------------------------- ann
def test_copies_of_a_real_vector_go_to_the_smaller_ids(spark):
    draw = np.random.default_rng(5)
    hot = [float(np.float32(x)) for x in draw.normal(size=64)]
    rows = [(int(i), hot if n < 1200 else [float(x) for x in draw.normal(size=64)]) for n, i in enumerate(draw.permutation(3000))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    copies = sorted(i for i, v in rows if v is hot)
    asked = copies[700]
    got = ann.nearest(df, df.filter(F.col("vec_id") == asked)).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(i, 0.0) for i in copies[:10]]


def test_first_copies():
    ids = np.array([5, 1, 1, 9, 2, 7, 3])
    v = np.array([[1.0, 2.0]] * 5 + [[0.0, 1.0]] * 2)
    assert ann._first_copies(ids, v, 2).tolist() == [1, 4, 5, 6]
    assert math.isinf(ann._limit(v[0], math.inf, ann.projection(2), 3.0))


# ----------------------------------------------------------------- training
def test_copies_of_an_id_are_one_training_row(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "ROWS", 100)
    monkeypatch.setattr(lang_crf, "DOCS_PER_LANG", 50)
    rows = [(i, f"{'vile awful' if i % 2 else 'kind lovely'} words number {i}", "de" if i % 4 == 0 else "en", "s", 1) for i in range(400)]
    seen = spark.createDataFrame(rows, DOCS)
    y = spark.createDataFrame([(i, 1, i % 2) for i in range(400)], "doc_id long, quality int, toxic int")
    # the id that leads the order by hash is repeated until it outnumbers all others
    first = [r.doc_id for r in seen.filter("crc32(cast(doc_id AS string)) % 3 <> 1").orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(2 ** 32))).limit(1).collect()]
    hot = seen.unionByName(seen.filter(F.col("doc_id").isin(first)).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(900)))).drop("n"))
    one, many = (toxicity.training_rows(d, y, "doc_id", "text", "toxic") for d in (seen, hot))
    assert all(np.array_equal(a, b) for a, b in zip(one, many)) and len(many[0]) == 100 and set(many[0]) == {0, 1}
    one, many = (lang_crf.training_sample(d, "doc_id", "text", "lang") for d in (seen, hot))
    assert one == many and len(set(many)) == len(many) == 100


def test_windows_are_bounded_in_characters(spark):
    docs = spark.createDataFrame([(i, "漢字" * 50_000, "zh", "s", 1) for i in range(9)], DOCS)
    got = lang_crf.training_sample(docs, "doc_id", "text", "lang")
    assert got and max(len(t) for _, t in got) == lang_crf.WINDOW_CHARS


# --------------------------------------------------------------------- pages
def test_chosen_blocks_outside_the_region_are_kept():
    intro = "An opening, with commas, stops; and all, that runs on for a while, as openings do."
    body = ["A long paragraph, number %d, with words; and more words, as long texts have them, again and again." % i for i in range(12)]
    whole = [intro, *body]
    apart = f"<body><section><div><p>{intro}</p></div></section><div><div><div>{''.join(f'<p>{x}</p>' for x in body)}</div></div></div></body>"
    assert html_text.content(apart).split("\n\n") == whole
    marked = f"<body><div><p>{intro}</p></div><article>{''.join(f'<p>{x}</p>' for x in body)}</article></body>"
    assert html_text.content(marked).split("\n\n") == whole
    teaser = f"<body><article>{''.join(f'<p>{x}</p>' for x in body)}</article><article><p>Short, teaser.</p></article></body>"
    assert html_text.content(teaser).split("\n\n") == body


# ----------------------------------------------------------- near duplicates
def test_shared_values_follow_from_the_similarity():
    for percent in (50, 80, 85, 95):
        p, least = percent / 100, near_dup.least_shared(percent, near_dup.SKETCH)
        under = lambda m: sum(math.comb(48, i) * p ** i * (1 - p) ** (48 - i) for i in range(m))
        assert under(least) <= 1e-9 < under(least + 1)
    assert near_dup.least_shared(100, 48) == 48
