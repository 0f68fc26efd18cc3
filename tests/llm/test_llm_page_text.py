"""Page text: the tag-path scores decide, against a plain version of the method, on odd and on deep pages."""

import random
import time

import duckdb
import numpy as np
import pytest

from conftest import SF001
from martflow.llm import html_text
from test_llm_pages import PAGE


def ancestors(node):
    out = []
    while node:
        out.append(node)
        node = node.up
    return out[::-1]


def plain(page):
    """The method with whole paths and without sums over subtrees."""
    blocks = html_text.read_blocks(page or "")
    if not blocks:
        return ""
    path = ["/".join(n.name for n in ancestors(b[0])) for b in blocks]
    order = list(dict.fromkeys(path))
    mean = lambda values: [sum(v for q, v in zip(path, values) if q == p) / path.count(p) for p in order]
    own = [len(t) - k for _, t, k in blocks]
    smooth = lambda x: [0.1 * x[max(i - 1, 0)] + 0.8 * x[i] + 0.1 * x[min(i + 1, len(x) - 1)] for i in range(len(x))]
    marks = [len(html_text._PUNCTUATION.findall(t)) if n else 0 for (_, t, _), n in zip(blocks, own)]
    fused = [a * (1 + b) for a, b in zip(smooth(mean(own)), smooth(mean(marks)))]
    score = dict(zip(order, fused))
    share = {p: (sum(k for q, (_, _, k) in zip(path, blocks) if q == p), sum(len(t) for q, (_, t, _) in zip(path, blocks) if q == p)) for p in order}
    menu = {p for p, (k, n) in share.items() if k > 0.8 * n}
    outer = lambda b, name: next((n for n in ancestors(b[0]) if n.name == name), None)
    size = {}
    for b, n in zip(blocks, own):
        if outer(b, "article"):
            size[outer(b, "article")] = size.get(outer(b, "article"), 0) + n
    teaser = [bool(outer(b, "article")) and size[outer(b, "article")] < 0.1 * max(size.values()) for b in blocks]
    chosen = [score[p] >= 0.5 * np.std(fused) and p not in menu and not t for p, t in zip(path, teaser)]
    if not any(chosen):
        return ""
    best = max((i for i, c in enumerate(chosen) if c), key=lambda i: (score[path[i]], len(blocks[i][1])))
    all_of = lambda node: sum(n for b, n, c in zip(blocks, own, chosen) if c and node in ancestors(b[0]))
    line = ancestors(blocks[best][0])
    at = max(i for i in range(len(line)) if i == 0 or all_of(line[i]) >= 0.8 * all_of(line[0]))
    at = max(min(at, len(line) - 1) - (at == len(line) - 1 and at > 0), 0)
    top = next((n for name in ("article", "main") for n in line[:at + 1] if n.name == name), line[at])
    keep = [c or top in ancestors(b[0]) and p not in menu and not t for c, b, p, t in zip(chosen, blocks, path, teaser)]
    return "\n\n".join(t for (_, t, _), k in zip(blocks, keep) if k)


def some_page(draw):
    """A tree of elements with text, links and articles."""
    def part(depth):
        if depth > 5 or draw.random() < 0.25:
            words = " ".join(draw.choice(["word", "and", "more,", "end.", "x"]) for _ in range(draw.choice([1, 3, 40])))
            return f"<a href=x>{words}</a>" if draw.random() < 0.3 else words
        name = draw.choice(["div", "p", "section", "article", "main", "ul", "li", "b", "h2", "td", "span"])
        return f"<{name}>" + "".join(part(depth + 1) for _ in range(draw.randrange(1, 4))) + (f"</{name}>" if draw.random() < 0.9 else "")
    return "<body>" + "".join(part(0) for _ in range(4))


def test_content_equals_the_plain_version():
    pages = [h for h, in duckdb.connect().sql(f"SELECT html FROM '{SF001}/pages.parquet'").fetchall()] + [PAGE, "", None, "x"]
    draw = random.Random(1)
    pages += [some_page(draw) for _ in range(600)]
    for p in pages:
        assert html_text.content(p) == plain(p), p


def test_the_scores_decide(monkeypatch):
    pages = [h for h, in duckdb.connect().sql(f"SELECT html FROM '{SF001}/pages.parquet'").fetchall()]
    before = [html_text.content(p) for p in pages]
    assert [html_text.content(p.replace("<article", "<div").replace("</article", "</div")) for p in pages] == before
    real = html_text.path_scores
    monkeypatch.setattr(html_text, "path_scores", lambda b: dict.fromkeys(real(b), -1.0))
    assert not any(html_text.content(p) for p in pages) and all(before)


def test_names_inside_an_article():
    page = ('<div class="search-bar">Find, here.</div><article><p>Some words, and more.</p><div class="search">found, here.</div><section id="social-notices"><p>kept, too.</p></section>'
            '<p>let <math><mi>x</mi><mo>=</mo><mn>1</mn></math>, so.</p><div class="ad">Buy, buy.</div><div class="comments"><p>No, never.</p></div></article>')
    assert html_text.content(page).split("\n\n") == ["Some words, and more.", "found, here.", "kept, too.", "let x=1, so."]


@pytest.mark.parametrize("page", ["<div>word" * 100_000, "<div>" * 100_000 + "</foo>" * 100_000 + "end", "<b>" * 50_000 + "<hr>" * 50_000 + "end", "<article><p>" * 50_000 + "end"])
def test_deep_pages_take_linear_time(page):
    began = time.perf_counter()
    assert html_text.content(page).endswith(("word", "end"))
    assert time.perf_counter() - began < 10
