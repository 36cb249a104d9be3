"""Edge cases named in the survey: short curves, empty clusters, single centre."""

import pytest

from segmint.operators.assign import assign
from segmint.operators.profile import cluster_profile
from segmint.operators.select import select_k


def _pts(spark, rows):
    return spark.createDataFrame([(i, [float(a), float(b)]) for i, (a, b) in enumerate(rows)], "user_id int, features array<double>")


def test_select_k_with_one_candidate(spark):
    pts = _pts(spark, [(0, 0), (5, 5), (9, 9)])  # N = 3: the only candidate is k = 2
    best = select_k(pts.select("features"), max_iter=10)
    assert best.k == 2


def test_select_k_needs_two_points(spark):
    with pytest.raises(ValueError):
        select_k(_pts(spark, [(1, 1)]).select("features"))


def test_profile_keeps_or_drops_empty_clusters(spark):
    pts = _pts(spark, [(0, 0), (0, 1), (9, 9)])
    cents = [[0.0, 0.5], [9.0, 9.0], [9.0, 9.0]]  # the third centre duplicates the second: no members
    dims = spark.createDataFrame([(0, "a", "A"), (1, "b", "B")], "dim int, dimension_id string, dimension_name string")
    a = assign(pts, cents)
    kept = {r["cluster_id"]: r for r in cluster_profile(a, cents, dims, "t", keep_empty=True).collect()}
    assert kept["t-2"]["cluster_member_count"] == 0
    assert kept["t-2"]["cluster_diameter"] is None
    assert kept["t-2"]["dimensions"] == []
    assert kept["t-0"]["cluster_wssse"] == pytest.approx(0.5)  # the model's cost on every row
    dropped = {r["cluster_id"] for r in cluster_profile(a, cents, dims, "t").collect()}
    assert dropped == {"t-0", "t-1"}
    # labels shorter than the vectors: the unlabelled dimension is dropped
    short = dims.where("dim = 0")
    prof = cluster_profile(a, cents, short, "t").collect()
    assert all([d["dimension_id"] for d in r["dimensions"]] == ["a"] for r in prof)


@pytest.mark.parametrize("method", ["expression", "batches"])
def test_single_centre(spark, method):
    pts = _pts(spark, [(0, 0), (3, 4)])
    got = assign(pts, [[0.0, 0.0]], method=method).orderBy("user_id").select("cluster", "dist").collect()
    assert [(r["cluster"], r["dist"]) for r in got] == [(0, 0.0), (0, 5.0)]


def test_bad_feature_width_fails(spark):
    pts = _pts(spark, [(0, 0)])
    with pytest.raises(Exception):
        assign(pts, [[0.0, 0.0, 0.0]] * 20, method="batches").collect()
