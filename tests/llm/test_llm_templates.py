"""Pages of one template: unlike enough not to link, they cost in proportion to their number."""

import random

import pytest

from martflow.llm import near_dup
from test_llm_documents import components


def pages(n, common, own, seed=1):
    draw = random.Random(seed)
    words = [f"t{i}" for i in range(common)]
    return [(i, " ".join(words + [f"o{i}x{k}" for k in range(own)] if draw.random() < 0.5 else [f"o{i}x{k}" for k in range(own)] + words)) for i in range(n)]


@pytest.mark.parametrize("common, own", [(180, 25), (180, 45), (60, 2)])
def test_templates_equal_all_pairs(spark, common, own):
    rows = pages(120, common, own) + [(500 + i, t) for i, (_, t) in enumerate(pages(20, common, own))] + [(600, pages(1, common, own)[0][1] + " end")]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components(rows, 3, 85)


def test_rows_grow_with_the_pages(spark, monkeypatch):
    """Rows of every staged table, for two numbers of pages."""
    made = []
    real = near_dup.staged

    def counted(df, name):
        out = real(df, name)
        made[-1] += out.count()
        return out

    shipped = []
    monkeypatch.setattr(near_dup, "staged", counted)
    monkeypatch.setattr(near_dup, "difference_links", lambda lists, *a, f=near_dup.difference_links: (shipped.append(lists.count()), f(lists, *a))[1])
    for n in (400, 1600):
        made.append(0)
        rows = spark.createDataFrame(pages(n, 180, 25), "doc_id long, text string")
        assert {r.component_id == r.doc_id for r in near_dup.near_duplicates(rows, words=3, percent=85).collect()} == {True}
    assert made[1] < 5 * made[0] and sum(shipped) == 0
