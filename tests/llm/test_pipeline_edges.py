"""The pipeline and its document-returning stages on nulls, repeated rows, empty tables and clashing column names."""

from collections import Counter

import corpus_pipeline
import pytest

import brute
from segmint.llm.ngram_join import first_of_each, jaccard_components
from segmint.llm.pii import find_personal, redact

EXTRA = ["_id", "_key", "_hash", "_cuts", "_gone", "_segmint_row", "id", "doc", "hash", "cuts", "gone", "key", "row", "kind"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in EXTRA)


def rows():
    return [(i, t, "en", None if i == 5 else "src0", None if t is None else len(t), *(f"{c}{k}" for c in EXTRA)) for k, (i, t) in enumerate(brute.documents())]


@pytest.fixture(scope="module")
def clashing(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def test_redact_keeps_clashing_columns(clashing):
    out = redact(clashing, find_personal(clashing))
    assert out.columns == clashing.columns and out.count() == clashing.count()
    before, after = ({r._key: r.asDict() for r in df.collect()} for df in (clashing, out))
    for k, r in after.items():
        was = before[k]
        assert all(r[c] == was[c] for c in r if c not in ("text", "n_chars"))
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))
    assert "[EMAIL]" in " ".join(r["text"] or "" for r in after.values())


def test_first_of_each_keeps_clashing_columns(clashing):
    out = first_of_each(clashing, jaccard_components(clashing, (80, 100), 5))
    assert out.columns == clashing.columns
    want = brute.jaccard_groups(brute.documents(), 80, 100, 5)
    got = Counter(r.doc_id for r in out.collect())
    assert got == Counter({**{i: 1 for i in want if want[i] == i}, None: sum(i is None for i, _ in brute.documents())})


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_on_awkward_tables(spark, clashing, tmp_path, empty):
    docs = clashing.where("false") if empty else clashing
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(0, 70, 2)] + [(None, 1, 1)], "doc_id bigint, quality int, toxic int")
    (labels.where("false") if empty else labels).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.store(stage(spark, docs, str(tmp_path)))
        assert name == "packing" or docs.columns == clashing.columns
    assert (docs.count() == 0) == empty
    if not empty:
        assert Counter(r.doc_id for r in docs.where("piece = 0").collect()) == Counter(r.doc_id for r in before.collect())
