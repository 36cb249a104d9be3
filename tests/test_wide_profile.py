"""Profiles as long tables, sparse vectors made in the JVM, centres tried in groups."""

import contextlib
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmint.operators import sparse as SP
from segmint.operators import train as TR
from segmint.operators.profile import profile_from_summary
from segmint.operators.wide_profile import center_cells, long_stats, profile_cells, wide_profile


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(4)
    rows = []
    for u in range(400):
        idx = sorted(rng.choice(50, size=int(rng.integers(0, 12)), replace=False).tolist())
        rows.append((u, idx, [float(x) for x in rng.choice([-2.0, 1.0, 3.0], size=len(idx))]))
    return spark.createDataFrame(rows, "user_id int, idx array<int>, val array<double>").repartition(5).cache()


@pytest.fixture(scope="module")
def dims(spark):
    return spark.createDataFrame([(k, f"p{k}", f"name {k}") for k in range(45)], "dim int, dimension_id string, dimension_name string")


def flat(profile):
    return {(r.cluster_id, r.cluster_member_count, round(r.cluster_diameter, 9), round(r.cluster_wssse, 6), tuple(tuple(round(x, 9) if isinstance(x, float) else x for x in d) for d in r.dimensions))
            for r in profile.collect()}


def test_equals_the_array_form(spark, points, dims):
    """Negative values, users without entries, dimensions without a label, a cluster without members."""
    cents = np.vstack([np.eye(4, 50) * 2, np.full((1, 50), 90.0)])
    assigned = SP.assign_sparse(points, cents)
    old = profile_from_summary(SP.cluster_summary_sparse(assigned, 50), cents, dims, "r")
    new = wide_profile(assigned, cents, dims, "r")
    assert flat(new) == flat(old) and new.where("part > 0").count() == 0
    cut = wide_profile(assigned, cents, dims, "r", part_dims=20)
    joined = {}
    for r in cut.orderBy("cluster", "part").collect():
        joined.setdefault(r.cluster_id, []).extend(d.dimension_id for d in r.dimensions)
        assert len(r.dimensions) <= 20
    assert joined == {r.cluster_id: [d.dimension_id for d in r.dimensions] for r in old.collect()}


def test_a_million_dimensions_need_no_broadcast_of_cells(spark):
    """512 clusters x 10^6 pages: the plan joins cells by shuffle and nests parts, never whole clusters."""
    centers = spark.range(512 * 1_000_000).select((F.col("id") / 1_000_000).cast("int").alias("cluster"), (F.col("id") % 1_000_000).cast("int").alias("dim"), F.lit(0.5).alias("center"))
    dims = spark.range(1_000_000).select(F.col("id").cast("int").alias("dim"), F.col("id").cast("string").alias("dimension_id"), F.col("id").cast("string").alias("dimension_name"))
    few = spark.createDataFrame([(0, 1.0, 1.0, [3], [1.0]), (1, 0.0, 0.0, [], [])], "cluster int, dist double, d2 double, idx array<int>, val array<double>")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        profile_cells(long_stats(few), centers, dims).explain()
    plan = buf.getvalue()
    assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") >= 1
    assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan


def test_center_cells_come_in_chunks(spark):
    c = np.arange(3 * 10_000, dtype=float).reshape(3, 10_000)
    got = center_cells(spark, c)
    assert got.count() == 30_000 and got.where("center <> cluster * 10000 + dim").count() == 0


def test_sparse_vectors_without_python(spark, points):
    vectors = SP.vector_frame(points, 50)
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    got = sorted((v.size, v.indices.tolist(), v.values.tolist()) for (v,) in vectors.collect())
    assert got == sorted((50, r.idx, r.val) for r in points.collect())
    model = TR.centers_of(SP.train_kmeans_sparse(points, 50, 3))
    assert model.shape == (3, 50)


def test_groups_of_centres_agree_with_all_at_once(points, monkeypatch):
    cents = np.vstack([np.eye(7, 50), np.eye(7, 50)])  # every centre twice: ties go to the lower cluster
    pick = lambda df: sorted((r.user_id, r.cluster, round(r.d2, 9)) for r in df.select("user_id", "cluster", "d2").collect())
    whole = pick(SP.assign_sparse(points, cents))
    monkeypatch.setattr(SP, "MAX_CENTER_BYTES", 3 * 50 * 8)
    split = SP.assign_sparse(points, cents)
    assert split.columns == [*points.columns, "cluster", "d2", "dist"] and pick(split) == whole


def test_no_points(spark, dims):
    none = spark.createDataFrame([], "cluster int, dist double, d2 double, idx array<int>, val array<double>")
    assert wide_profile(none, np.eye(2, 50), dims, "r").collect() == []
