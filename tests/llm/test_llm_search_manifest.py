"""Ranked search, Merkle manifest and SimHash links against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from martflow.llm import lexical, merkle, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long, term string, fp long, g int, rank int, `a.b` int"


def table(spark, rows):
    """Rows of (doc_id, text, lang) beside columns whose names the operators use too."""
    return spark.createDataFrame([(i, t, lang, "s", len(t) if t else None, "x", 1, 1, 1, 1) for i, t, lang in rows], DOCS)


ODD = [(None, "Lost id alpha beta", None), (7, None, "en"), (8, "", "en"), (9, " \t.,;!?\n", "de"), (10, "É é Ünï 日本 alpha-beta", None),
       (11, "alpha ALPHA alpha", "en"), (11, "alpha ALPHA alpha", "en"), (11, "Alpha alpha alpha", "en"), (12, "a\0b alpha\x7fbeta", "fr")]


# ------------------------------------------------------------- lexical search
def plain_search(docs, items, top):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    low = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in term.findall(t or "")]
    bags = [(i, Counter(low(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n, length = len(bags), sum(x[2] for x in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = set()
    for item in dict.fromkeys(i for i, _ in items):
        asked = {t for i, text in items if i == item for t in low(text)}
        scored = []
        for doc, b, size in bags:
            m = 50 + 50 * size * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 20 * m)) for t in asked if t in b)
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out |= {(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:top], 1)}
    return out


def words(draw, n, vocab):
    return " ".join(f"w{min(int(draw.expovariate(0.02)), vocab)}" for _ in range(n))


@pytest.mark.parametrize("segment, top", [(1 << 15, 50), (40, 3), (7, 10)])
def test_search_equals_scoring_everything(spark, monkeypatch, segment, top):
    draw = random.Random(segment)
    docs = [(i, words(draw, draw.choice([1, 5, 40, 200]), 300), "en") for i in range(400)]
    docs += [(1000 + i, docs[5][1], "en") for i in range(30)]  # ties
    docs += [(2000, words(draw, 60_000, 5000), "en")] + ODD
    items = [(k, words(draw, draw.choice([1, 4, 30]), 300)) for k in range(20)] + [(20, docs[5][1]), (21, None), (22, "?!"), (23, "zzz"), (24, "Alpha é"), (24, "beta"), (None, "w1")]
    monkeypatch.setattr(lexical, "SEGMENT_DOCS", segment)
    d, q = table(spark, docs).coalesce(2), spark.createDataFrame(items, "item_id long, text string")
    source = d.select("doc_id", "text")
    got = lexical.search(inline_index(spark, source, segment), lexical.asked_terms(q), top)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in got.collect()} == plain_search([(i, t) for i, t, _ in docs], items, top)
    few = lexical.search(inline_index(spark, source, segment), lexical.asked_terms(q), top, item_bytes=400)  # several passes
    assert {tuple(r) for r in few.collect()} == {tuple(r) for r in got.collect()}


def inline_index(spark, source, segment):
    """The index made here, where the segment size is patched; tasks have the shipped package."""
    import pyarrow as pa

    s, out, number = lexical.Segment(), [], 0
    for r in source.collect():
        s.add(r.doc_id, None if r.text is None else r.text.encode())
        if s.full():
            out += list(s.rows(number))
            s, number = lexical.Segment(), number + 1
    out += list(s.rows(number))
    return spark.createDataFrame(pa.Table.from_batches(out).to_pylist(), lexical.INDEX)


def test_search_over_the_index_of_the_tasks(spark):
    draw = random.Random(3)
    docs = [(i, words(draw, 30, 300), "en") for i in range(200)] + ODD
    items = [(k, words(draw, 10, 300)) for k in range(5)]
    got = lexical.ranked(table(spark, docs).repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert {tuple(r) for r in got.collect()} == plain_search([(i, t) for i, t, _ in docs], items, 50)
    assert lexical.ranked(table(spark, []), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert lexical.ranked(table(spark, docs), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_blocks_are_skipped_and_scores_stay(monkeypatch):
    """A common word behind rare ones: most blocks of its list stay compressed."""
    s = lexical.Segment()
    for i in range(20_000):
        s.add(i, b"common " * (1 + i % 3) + (b"rare seldom" if i % 4000 == 17 else b"filler"))
    rows = [r for b in s.rows(0) for r in b.to_pylist()]
    lists = {r["term"]: (*(np.array(r[c]) for c in ("last", "most", "ratio", "at")), np.frombuffer(r["postings"], np.uint8)) for r in rows if r["term"]}
    seen = []
    monkeypatch.setattr(lexical, "unpacked", lambda data, f=lexical.unpacked: (seen.append(len(data)), f(data))[1])
    search = lexical.Search([[(b"common", 20), (b"rare", 8000), (b"seldom", 8000)]], 20_000, int(sum(rows[0]["lengths"])), 5)
    search.segment(np.arange(20_000), np.zeros(20_000, bool), np.array(rows[0]["lengths"]), lists)
    assert sorted(search.heaps[0][1].tolist()) == [17 + 4000 * k for k in range(5)]
    assert sum(seen) < 0.1 * len(lists[b"common"][4])


def test_numbers_in_seven_bits():
    x = np.array([0, 1, 127, 128, 16_383, 16_384, 2**31, 2**40])
    data, size = lexical.packed(x)
    assert size.tolist() == [1, 1, 1, 2, 2, 3, 5, 6] and lexical.unpacked(data).tolist() == x.tolist()


# ------------------------------------------------------------- Merkle manifest
def plain_audit(rows):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    field = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    leaf = lambda i, t, lang: sha("".join(map(field, (i, "s", lang, len(t) if t else None, t))))
    low = lambda t: t and re.sub("[A-Z]", lambda m: m[0].lower(), t)

    def climb(nodes):
        """The last node, and each node's siblings by level."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            runs = [nodes[k:k + 8] for k in range(0, len(nodes), 8)]
            for path, p in zip(paths, at):
                run = runs[p // 8]
                path.append(("".join(run[:p % 8]), "".join(run[p % 8 + 1:])))
            at, nodes = [p // 8 for p in at], [sha("".join(r)) for r in runs]
        return nodes[0], paths

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[lang] = (mine, *climb([leaf(*r) for r in mine]))
    root, above = climb([trees[x][1] for x in langs])
    out = []
    for lang, up in zip(langs, above):
        mine, sub, paths = trees[lang]
        for r, path in zip(mine, paths):
            i, t, _ = r
            hit = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
            now = leaf(i, low(t) if hit else t, lang) if not hit else sha("".join(map(field, (i, "s", lang, len(t) if t else None, low(t)))))
            for left, right in path + up:
                now = sha(left + now + right)
            out.append((i, leaf(*r), sub, root, sha("".join(a + b for a, b in path + up)), now, now == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [
    [(i, f"Text {i % 50}", ["en", "de", None, "fr"][0 if i % 3 else i % 4]) for i in range(700)] + ODD,
    [(i, "One", f"l{i:02}") for i in range(75)],  # many groups of one row: the tree over them has two levels
    [(5, "Only", None)], [(i, "T", "en") for i in range(8)], [(i, "T", "en") for i in range(9)], [(3, "Same", "en")] * 70])
def test_audit_equals_the_plain_tree(spark, rows):
    docs = table(spark, random.Random(1).sample(rows, len(rows))).repartition(3)
    got = merkle.audit(docs, merkle.third_by_crc(F.col("doc_id")))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_audit(rows)


def test_audit_of_an_empty_table(spark):
    assert merkle.audit(table(spark, []), F.lit(True)).collect() == []


def test_records_are_stored_by_content_once(spark):
    rows = spark.createDataFrame([("x", k, 64, f"{k % 8}") for k in range(64)], "g string, rank long, n long, digest string")
    tree = merkle.grown(rows)
    assert [r.count() for r in tree.records] == [1, 1]  # eight equal runs of eight
    above = tree.tops.select("g", F.array().cast(merkle.PATH).alias("path"))
    got = merkle.descended(tree, above).collect()
    assert len(got) == 64 and {len(r.path) for r in got} == {2}


# ------------------------------------------------------------- SimHash
def plain_prints(docs):
    out = []
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        grams = [" ".join(w[k:k + 4]) for k in range(len(w) - 3)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        out.append((i, sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))))
    return out


def plain_components(prints):
    """The least id that each (id, fingerprint) reaches over links of at most 4 bits."""
    label = list(range(len(prints)))
    fp = np.array([p for _, p in prints], np.uint64)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4
    for k in range(len(prints)):
        group = {label[j] for j in np.flatnonzero(near[k])}
        label = [min(group) if x in group else x for x in label]
    least = {}
    for (i, _), x in zip(prints, label):
        if i is not None:
            least[x] = min(i, least.get(x, i))
    return sorted(((i, f"{p:016x}", least.get(x)) for (i, p), x in zip(prints, label)), key=str)


@pytest.mark.parametrize("most", [512, 3, 1])
def test_fingerprints_and_components(spark, most):
    draw = random.Random(4)
    base = [words(draw, 400, 3000).split() for _ in range(6)]
    docs = [(i, " ".join(base[i % 6]), "en") for i in range(20)]
    for i in range(20, 200):
        w = list(base[i % 6])
        for _ in range(draw.choice([1, 2, 3, 8])):
            w[draw.randrange(len(w))] = f"n{draw.randrange(10**6)}"
        docs.append((i, "  ".join(w).title() if i % 7 else "\n".join(w), "en"))
    docs += [(900 + i, words(draw, draw.randrange(1, 8), 40), "en") for i in range(40)] + ODD
    got = simhash.near_duplicates(table(spark, docs).repartition(3), most=most)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_components(plain_prints([(i, t) for i, t, _ in docs]))


@pytest.mark.parametrize("most", [512, 8])
def test_links_of_dense_and_spread_fingerprints(spark, most):
    """A ball of fingerprints around one value, chains of links, and the limit itself."""
    draw = random.Random(5)
    flip = lambda x, n: x ^ sum(1 << b for b in draw.sample(range(64), n))
    centre, x = draw.getrandbits(64), draw.getrandbits(64)
    prints = {0, (1 << 64) - 1, *(flip(centre, draw.randrange(1, 4)) for _ in range(400)), *(draw.getrandbits(64) for _ in range(200))}
    for _ in range(60):
        x = flip(x, 4)
        prints.add(x)
    for _ in range(60):
        y = draw.getrandbits(64)
        prints |= {y, flip(y, draw.choice([4, 5]))}
    rows = [(k, p) for k, p in enumerate(prints)]
    df = spark.createDataFrame([(simhash.signed(p),) for _, p in rows], "fp long")
    from martflow.llm.near_dup import components

    ids = {simhash.signed(p): k for k, p in rows}
    label = {ids[r.sig]: ids[r.label] for r in components(simhash.links(df, most)).collect()}
    groups = {}
    for k, _ in rows:
        groups.setdefault(label.get(k, k), []).append(k)
    got = sorted((k, f"{dict(rows)[k]:016x}", min(g)) for g in groups.values() for k in g)
    assert sorted(got, key=str) == plain_components(rows)


def test_the_ring_covers_all_pairs_within_the_limit():
    masks = simhash.list_masks()
    assert len(masks) == 64 and sum(simhash.ring()) == (1 << 64) - 1
    draw = random.Random(6)
    for _ in range(3000):
        apart = sum(1 << b for b in draw.sample(range(64), draw.randrange(1, 5)))
        starts = [i for i, chain in enumerate(simhash.chains()) if all((apart & bits).bit_count() <= most for bits, most in chain)]
        assert starts and any(i in starts and not apart & m for i, m in masks)


def test_long_and_empty_texts():
    assert simhash.fingerprint(None, 4) == simhash.fingerprint(b" \n", 4) == 0
    long = b"same four words here " * 300_000
    assert simhash.fingerprint(long, 4) == plain_prints([(1, (b"same four words here " * 300).decode())])[0][1]
    assert plain_prints([(1, "a b C")])[0][1] == simhash.fingerprint("a b c".encode(), 4)


def test_simhash_of_an_empty_table(spark):
    assert simhash.near_duplicates(table(spark, [])).collect() == []
