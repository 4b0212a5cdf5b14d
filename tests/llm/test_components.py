"""Components of links: labels against a plain union-find, and what one round costs."""

import random

import pytest

from somaloom.llm import similar


def plain(links):
    above = {}

    def root(x):
        above.setdefault(x, x)
        while above[x] != x:
            x = above[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        above[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(above)}


DRAW = random.Random(7)
SHUFFLED = DRAW.sample(range(-60, 60), 120)
LINKS = {
    "none": [], "itself": [(5, 5)], "twice and turned": [(2, 1), (1, 2), (2, 1)],
    "star": [(-9, k) for k in range(60)] + [(k, 90) for k in range(60)], "path out of order": list(zip(SHUFFLED, SHUFFLED[1:])),
    "scattered": [(DRAW.randrange(-300, 300), DRAW.randrange(-300, 300)) for _ in range(280)]}


@pytest.mark.parametrize("kind", list(LINKS))
def test_labels_equal_union_find(spark, kind):
    got = similar.components(spark.createDataFrame(LINKS[kind], "a long, b long")).collect()
    assert sorted((r.key, r.label) for r in got) == sorted(plain(LINKS[kind]).items())


def test_a_round_is_one_table_of_three_shuffles(spark, monkeypatch):
    plans, written = [], similar.cut_lineage
    monkeypatch.setattr(similar, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or written(df))
    similar.components(spark.createDataFrame([(1, k) for k in range(2, 30)], "a long, b long"))
    assert len(plans) <= 3  # one to tie, one to see that nothing moves
    assert all(plan.count("Exchange ") <= 4 for plan in plans)  # one more where rows are first made, or for a broadcast
