"""What the driver holds while it plans the n-gram join, finds components and trains the toxicity network."""

import random
import re
import tracemalloc

import pytest

from segmint.llm import common, ngram_join
from segmint.llm.toxicity import WINDOW, fit


@pytest.fixture
def joins(monkeypatch):
    """Number of joins in the plan of each stored table."""
    seen, store = [], common.store

    def counted(df):
        seen.append(len(re.findall(r"\bJoin ", df._jdf.queryExecution().optimizedPlan().toString())))
        return store(df)

    monkeypatch.setattr(common, "store", counted)
    monkeypatch.setattr(ngram_join, "store", counted)
    return seen


def lowest(pairs):
    """Smallest node that each node's edges lead to."""
    root = {}

    def find(v):
        while root.get(v, v) != v:
            v = root[v]
        return v

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {v: find(v) for p in pairs for v in p}


def test_rounds_of_components_are_small_plans(spark, joins):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2100 + i) for i in range(50)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame([*pairs, (None, 5), (7, 7)], "a long, b long")).collect()}
    want = lowest([p for p in pairs if p[0] != p[1]])
    assert got == want
    assert max(joins) <= 3


def test_remaining_links_are_found_in_small_plans(spark, joins):
    rng = random.Random(5)
    sets = {2 * k: sorted(rng.sample(range(40), 20)) for k in range(30)}
    for k in range(0, 30, 3):  # similar to the one before it, but for one n-gram
        sets[1000 + 2 * k] = sorted([*sets[2 * k][1:], 77])
    table = spark.createDataFrame([(k, len(s), [len(s), 0, 0, 0], 0, s) for k, s in sets.items()], "k long, n long, sizes array<int>, fragment int, grams array<long>")
    members = spark.createDataFrame([(1, k) for k in sets], "key long, k long")
    groups = spark.createDataFrame([(k, 0) for k in sets], "k long, group long")
    labels = spark.createDataFrame([(0, 0), (1000, 0)], "k long, component long")  # one link is known
    more = ngram_join.rest_links(members, labels, groups, table, (90, 100), block=4)
    joins.append(len(re.findall(r"\bJoin ", more._jdf.queryExecution().optimizedPlan().toString())))
    got = {frozenset((r.a, r.b)) for r in more.collect()}
    alike = {frozenset((a, b)) for a in sets for b in sets if a < b and 100 * len({*sets[a]} & {*sets[b]}) >= 90 * len({*sets[a]} | {*sets[b]})}
    assert got == alike - {frozenset((0, 1000))} and got
    assert max(joins) <= 4


def test_training_holds_one_number_for_each_word():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(500)]
    docs = [(0, [words[rng.randrange(500)] for _ in range(32 * WINDOW)]) for _ in range(800)]
    n = sum(len(ws) for _, ws in docs)
    tracemalloc.start()
    try:
        fit(docs)
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert peak < 16 * n
