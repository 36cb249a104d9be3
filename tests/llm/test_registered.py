"""Registered queries and the pipeline on the smallest tables."""

from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry
from oracle_compare import compare, duck
from segmint.llm.common import components
from segmint.llm.oracle import SQL
from segmint.llm.queries import QUERIES

import brute
import pytest

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    numbers = sorted(int(k[2:].split("_")[0]) for k in QUERIES)
    assert numbers == list(range(1, 14)) and {*QUERIES, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    ok, msg = compare(QUERIES[name](spark, SF), duck(SF), SQL[name])
    assert ok, msg


def test_components(spark):
    import random

    rng = random.Random(1)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + k, 1001 + k) for k in range(70)] + [(3, 3), (None, 4), (5, None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    edges = [(a, b) for a, b in pairs if a is not None and b is not None and a != b]
    assert got == brute.groups(edges, {n for e in edges for n in e})


def test_pipeline_stages(spark):
    """Every stage against a plain version on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.store(stage(spark, docs, SF))
        seen[name] = (docs, out)
        docs = out
    for name, (before, after) in seen.items():
        if name != "packing":
            assert after.columns == before.columns and after.count() <= before.count()
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    before, after = seen["ngram_jaccard"]
    want = brute.jaccard_groups(rows(before), 80, 100, 5)
    assert Counter(rows(after)) == Counter(r for r in rows(before) if want[r[0]] == r[0])
    before, after = seen["substring_dedup"]
    want = brute.repeats(rows(before), 20, words=True)
    assert Counter(rows(after)) == Counter((i, want[i, t][3] if want[i, t][1] else t) for i, t in rows(before) if not want[i, t][0] or want[i, t][1] < want[i, t][0])
    before, after = seen["packing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == Counter(r.doc_id for r in after.collect())
