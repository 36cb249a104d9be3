"""Broken inputs fail, nothing is dropped or lowered without a record."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmint.operators.assign import assign, nearest_rows
from segmint.operators.select import MemoScorer, _best_range, binsearch_bic, candidate_ks, linear_bic, run_kmeans
from segmint.operators.train import ScoredModel, centers_of, train_kmeans
from segmint.plans.kmeans_job import load_inputs
from segmint.plans.monthly import run_monthly
from segmint.sources import jsonl

from conftest import SF_SMALL


def folder(workdir, points, users, pages=2):
    for name, lines in (("inputs", points), ("users", users), ("pages", [f"p{i}" for i in range(pages)]), ("names", [f"n{i}" for i in range(pages)])):
        with open(os.path.join(workdir, f"{name}.txt"), "w") as f:
            f.write("\n".join(lines) + "\n")
    return workdir


def test_points_without_a_user_fail(spark, workdir):
    with pytest.raises(ValueError, match="3 points but 2 users"):
        load_inputs(spark, folder(workdir, ["0:1.0", "1:1.0", "0:2.0"], ["a", "b"]))


def test_an_index_without_a_page_fails(spark, workdir):
    with pytest.raises(ValueError, match="index 7"):
        load_inputs(spark, folder(workdir, ["0:1.0", "7:4.0"], ["a", "b"]))


@pytest.mark.parametrize("line", ["not json", '["a", "1", "{broken", {}, {}, {}]'])
def test_malformed_activity_fails(spark, line):
    df = spark.createDataFrame([(line,)], "value string")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        jsonl.read_user_activity(spark, df).collect()


def test_malformed_category_fails(spark, workdir):
    df = spark.createDataFrame([("{oops",)], "value string")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        jsonl.read_category(spark, df).collect()
    path = os.path.join(workdir, "category.json")
    with open(path, "w") as f:
        f.write("{oops")
    with pytest.raises(Exception):
        jsonl.read_category(spark, path).collect()


def test_monthly_empty_and_one_user_categories(spark, workdir):
    none = spark.createDataFrame([("no such brand",)], "page_id string")
    got = run_monthly(spark, SF_SMALL, os.path.join(workdir, "out"), {"none": none}, ["199601"])
    path = got[0]["path"]
    assert spark.read.parquet(f"{path}/members").count() == 0
    assert spark.read.text(f"{path}/meta-data.json").count() == 0 and spark.read.text(f"{path}/data.json").count() == 0
    many = run_monthly(spark, SF_SMALL, os.path.join(workdir, "many"), {"c": spark.createDataFrame([("Brand#11",)], "page_id string")}, ["199601"], k=100_000)
    step = spark.read.json(f"{many[0]['path']}/step").first()
    assert step["requested_k"] == 100_000 and step["k"] < 100_000


def test_one_point_and_one_center(spark):
    one = spark.createDataFrame([([1.0, 2.0],)], "features array<double>")
    s = run_kmeans(one, 1)
    assert (s.k, s.n) == (1, 1)
    two = spark.createDataFrame([([0.0, 0.0],), ([2.0, 4.0],)], "features array<double>")
    model = train_kmeans(two, 1)
    assert np.allclose(centers_of(model), [[1.0, 2.0]])
    assert [r["cluster"] for r in assign(two, model).collect()] == [0, 0]


def stub(bics: dict):
    return MemoScorer(lambda k: ScoredModel(k, 1.0, 1.0, None, 10, 2, bics.get(k), None))


def test_searches_pass_over_zero_variance(spark):
    scorer = stub({2: 5.0, 3: 6.0, 4: 7.0, 5: None, 6: None, 7: None, 8: None})
    assert binsearch_bic(scorer, (2, 5.0), (8, None)) == (4, 7.0)
    assert linear_bic(scorer, 2, 8) == (4, 7.0)
    assert linear_bic(stub({}), 2, 8) == (2, None)
    assert _best_range(spark, [stub({})(k) for k in (2, 4)]) == ((2, None), (2, None))
    assert binsearch_bic(stub({}), (2, None), (3, None)) == (2, None)


def test_candidate_bounds_are_parameters():
    assert candidate_ks(1) == []
    assert candidate_ks(200_000) == [16, 32, 64, 128, 256, 512]
    assert candidate_ks(500, limit=100, max_k=64, min_k=8) == [8, 16, 32, 64]


def test_tiny_features_are_assigned_like_large_ones(spark):
    rng = np.random.default_rng(3)
    x, c = rng.random((2000, 16)), rng.random((12, 16))
    near = lambda s: nearest_rows(x * s, c * s, ((c * s) ** 2).sum(1))[0]
    assert (near(1.0) == near(1e-6)).all()
    ties = np.repeat(c[:1], 3, axis=0)
    assert (nearest_rows(x[:50], ties, (ties**2).sum(1))[0] == 0).all()


def test_members_json_has_one_schema(spark):
    from segmint.sources import sinks

    rows = spark.range(10).select(F.lit("c-0").alias("cluster_id"), F.col("id").cast("string").alias("user_id"))
    small = [json.loads(r["value"]) for r in sinks.membership_lines(rows).collect()]
    parts = [json.loads(r["value"]) for r in sinks.membership_lines(rows, chunk_size=4).collect()]
    assert set(small[0]) == {"cluster_id", "part", "parts", "user_ids"} == set(parts[0])
    assert small[0]["parts"] == 1 and {p["parts"] for p in parts} == {3}


def test_large_models_go_in_groups(spark, monkeypatch):
    import segmint.operators.assign as A
    from segmint.operators.score import score_many

    rng = np.random.default_rng(4)
    pts = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.random((300, 8)))], "id int, features array<double>")
    cents = {k: rng.random((k, 8)) for k in (3, 11, 20)}
    whole = {k: [(r["id"], r["cluster"], r["d2"]) for r in assign(pts, c, method="batches").orderBy("id").collect()] for k, c in cents.items()}
    scores = sorted(map(tuple, score_many(pts, cents).collect()))
    monkeypatch.setattr(A, "MAX_CENTER_BYTES", 8 * 8 * 4)  # four centres at a time
    assert whole == {k: [(r["id"], r["cluster"], r["d2"]) for r in assign(pts, c, method="batches").orderBy("id").collect()] for k, c in cents.items()}
    assert scores == sorted(map(tuple, score_many(pts, cents).collect()))
