"""Physical alternatives give the same result as the default path."""

import pytest
from pyspark.sql import functions as F

from segmint.operators.assign import assign, first_rows_as_centers
from segmint.operators.features import (
    action_counts,
    assemble_vectors,
    dimension_table,
    embedding_points,
    group_by_user,
)
from segmint.operators.profile import cluster_summary
from segmint.sources.tables import table

from conftest import SF_SMALL


def test_vector_assembly_pivot_equals_map(spark):
    events = table(spark, SF_SMALL, "events", ["user_id", "event_type"])
    counts = action_counts(events, "user_id", "event_type")
    dims = dimension_table(counts, "event_type")
    pivot = {r["user_id"]: r["features"] for r in assemble_vectors(counts, dims, "user_id", "event_type", method="pivot").collect()}
    mapped = {r["user_id"]: r["features"] for r in assemble_vectors(counts, dims, "user_id", "event_type", method="map").collect()}
    raw = {r["user_id"]: r["features"] for r in assemble_vectors(events, dims, "user_id", "event_type", value_col=None).collect()}
    assert pivot == mapped == raw
    assert all(len(v) == 5 for v in pivot.values())


def test_dimension_table_numbers_sorted_pages(spark):
    events = table(spark, SF_SMALL, "events", ["event_type"])
    dims = [tuple(r) for r in dimension_table(events, "event_type").orderBy("dim").collect()]
    assert dims == [(i, t, t) for i, t in enumerate(["click", "error", "purchase", "signup", "view"])]
    names = spark.createDataFrame([("click", "Clicks")], "event_type string, name string")
    labelled = {r["dimension_id"]: r["dimension_name"] for r in dimension_table(events, "event_type", names=names).collect()}
    assert labelled["click"] == "Clicks" and labelled["view"] == "view"


def test_group_by_user_kinds(spark):
    rows = [("u1", "p1", "like"), ("u1", "p1", "like"), ("u1", "p2", "comment"), ("u2", "p1", "comment")]
    ev = spark.createDataFrame(rows, "user_id string, page_id string, kind string")
    got = {r["user_id"]: (dict(r["like"]), dict(r["comment"])) for r in group_by_user(ev, kind_col="kind", kinds=["like", "comment"]).collect()}
    assert got == {"u1": ({"p1": 2}, {"p2": 1}), "u2": ({}, {"p1": 1})}


@pytest.mark.parametrize("strategy", ["wide", "long"])
def test_summary_strategies_agree(spark, strategy):
    emb = embedding_points(spark, SF_SMALL)
    cents = first_rows_as_centers(emb, 6, "vec_id")
    a = assign(emb, cents).cache()
    base = {r["cluster"]: r for r in cluster_summary(a, 64).collect()}
    other = {r["cluster"]: r for r in cluster_summary(a, 64, strategy=strategy).collect()}
    assert base.keys() == other.keys()
    for c, r in base.items():
        o = other[c]
        assert (r["n"], r["positives"], r["mins"], r["maxs"]) == (o["n"], o["positives"], o["mins"], o["maxs"])
        assert r["sse"] == pytest.approx(o["sse"], rel=1e-12)
        assert r["means"] == pytest.approx(o["means"], rel=1e-9, abs=1e-12)
        assert r["sums"] == pytest.approx(o["sums"], rel=1e-9, abs=1e-9)
    # positives really count values > 0 (embeddings have negative values too)
    neg = a.where(F.col("cluster") == 0).select(F.count_if(F.col("features")[0] > 0)).first()[0]
    assert base[0]["positives"][0] == neg
