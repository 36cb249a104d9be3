"""the end-to-end golden fixture — six users, two pages, k = 2."""

import json
import os

import pytest
from pyspark.sql import functions as F

from segmint.operators.assign import assign
from segmint.operators.profile import cluster_profile
from segmint.operators.train import centers_of, train_kmeans
from segmint.plans.kmeans_job import run_kmeans_job

POINTS = [("a", 0.0, 0.0), ("b", 0.0, 1.0), ("c", 1.0, 0.0), ("d", 9.0, 9.0), ("e", 8.0, 9.0), ("f", 9.0, 8.0)]
TOL = 1e-9


def _check_profiles(profiles):
    by_size = sorted(profiles, key=lambda p: p["dimensions"][0]["center"])
    near, far = by_size
    for p in (near, far):
        assert p["cluster_member_count"] == 3
        assert p["private"] is False
        assert p["cluster_diameter"] == pytest.approx(1.4907119849998591, abs=TOL)
        assert p["cluster_wssse"] == pytest.approx(2.666666666666591, abs=TOL)
        assert [d["dimension_id"] for d in p["dimensions"]] == ["page1", "page2"]
    for d in far["dimensions"]:
        assert d["center"] == pytest.approx(8.666666666666666, abs=TOL)
        assert d["avg"] == pytest.approx(8.666666666666666, abs=TOL)
        assert (d["min"], d["max"], d["member_count"]) == (8.0, 9.0, 3)
    for d in near["dimensions"]:
        assert d["center"] == pytest.approx(0.3333333333333333, abs=TOL)
        assert d["avg"] == pytest.approx(0.3333333333333333, abs=TOL)
        assert (d["min"], d["max"], d["member_count"]) == (0.0, 1.0, 1)


def test_golden_profile_in_memory(spark):
    pts = spark.createDataFrame(POINTS, "user_id string, page1 double, page2 double").select(
        "user_id", F.array("page1", "page2").alias("features")
    )
    dims = spark.createDataFrame([(0, "page1", "page1"), (1, "page2", "page2")], "dim int, dimension_id string, dimension_name string")
    model = train_kmeans(pts, 2, "kmeans||", 100, 0.001, seed=1)
    centers = centers_of(model)
    assigned = assign(pts, centers)
    members = {frozenset(r["u"]) for r in assigned.groupBy("cluster").agg(F.collect_set("user_id").alias("u")).collect()}
    assert members == {frozenset("abc"), frozenset("def")}
    prof = [r.asDict(recursive=True) for r in cluster_profile(assigned, centers, dims, "t").collect()]
    _check_profiles(prof)


@pytest.mark.parametrize("representation", ["dense", "sparse"])
def test_golden_text_folder_job(spark, workdir, representation):
    """The reference's flow: inputs.txt + users/pages/names → data.json + meta-data.json."""
    inp = os.path.join(workdir, "in")
    os.makedirs(inp)
    with open(os.path.join(inp, "inputs.txt"), "w") as f:
        # a zero count is written out here, as the reference's fixture has one
        for _, x, y in POINTS:
            f.write(f"0:{x} 1:{y}\n")
    with open(os.path.join(inp, "users.txt"), "w") as f:
        f.write("\n".join(u for u, _, _ in POINTS) + "\n")
    for name in ("pages.txt", "names.txt"):
        with open(os.path.join(inp, name), "w") as f:
            f.write("page1\npage2\n")
    out = os.path.join(workdir, "out")
    run_kmeans_job(spark, inp, out, 2, "kmeans||,100,0.001", run_id="golden", seed=1, representation=representation)
    data = [json.loads(r["value"]) for r in spark.read.text(out + "/data.json").collect()]
    assert {tuple(d["user_ids"]) for d in data} == {("a", "b", "c"), ("d", "e", "f")}
    assert all(d["cluster_id"].startswith("golden-") for d in data)
    meta = [r.asDict(recursive=True) for r in spark.read.json(out + "/meta-data.json").collect()]
    _check_profiles(meta)


def test_params_are_checked():
    from segmint.operators.train import parse_params

    assert parse_params("kmeans||,100,0.001") == ("k-means||", 100, 0.001)
    assert parse_params("random,5,1.0") == ("random", 5, 1.0)
    for bad in ("kmeans,100,0.001", "kmeans||,1.5,0.001", "kmeans||,100,1", "kmeans||,100"):
        with pytest.raises(ValueError):
            parse_params(bad)


def test_choose_k_job_on_folder(spark, workdir):
    """Entry B: candidate ks from the point count (6 → 2, 4), sweep, largest BIC gap, bisection."""
    from segmint.plans.choose_k_job import choose_k_job

    inp = os.path.join(workdir, "in")
    os.makedirs(inp)
    with open(os.path.join(inp, "inputs.txt"), "w") as f:
        for _, x, y in POINTS:
            f.write(f"0:{x} 1:{y}\n")
    with open(os.path.join(inp, "users.txt"), "w") as f:
        f.write("\n".join(u for u, _, _ in POINTS) + "\n")
    for name in ("pages.txt", "names.txt"):
        with open(os.path.join(inp, name), "w") as f:
            f.write("page1\npage2\n")
    k = choose_k_job(spark, inp, "random,20,0.001")
    assert k in (2, 3, 4)
    assert choose_k_job(spark, inp, "random,20,0.001", representation="sparse") in (2, 3, 4)
