"""Monthly pipeline: a completed step is skipped on rerun; a suffix opens a new output."""

import json
import os

from pyspark.sql import functions as F

from segmint.plans.monthly import run_monthly
from segmint.sources.tables import table

from conftest import SF_SMALL


def test_monthly_write_once(spark, workdir):
    part = table(spark, SF_SMALL, "part", ["p_brand"])
    cats = {"m1": part.where(F.col("p_brand").startswith("Brand#1")).select(F.col("p_brand").alias("page_id")).distinct()}
    out = os.path.join(workdir, "out")
    first = run_monthly(spark, SF_SMALL, out, cats, ["199601"], k=2)
    assert [r["ran"] for r in first] == [True]
    path = first[0]["path"]
    members = spark.read.parquet(path + "/members")
    profile = spark.read.json(path + "/meta-data.json")
    assert members.count() > 0
    assert profile.agg(F.sum("cluster_member_count")).first()[0] == members.count()
    data = [json.loads(r["value"]) for r in spark.read.text(path + "/data.json").collect()]
    assert sum(len(d["user_ids"]) for d in data) == members.count()
    again = run_monthly(spark, SF_SMALL, out, cats, ["199601"], k=2)
    assert [r["ran"] for r in again] == [False]
    other = run_monthly(spark, SF_SMALL, out, cats, ["199601"], k=3, suffix="k3")
    assert [r["ran"] for r in other] == [True]
    assert other[0]["path"].endswith("category=m1-k3")


def test_monthly_sparse_route(spark, workdir):
    part = table(spark, SF_SMALL, "part", ["p_brand"])
    cats = {"all": part.select(F.col("p_brand").alias("page_id")).distinct()}
    out = os.path.join(workdir, "out")
    dense = run_monthly(spark, SF_SMALL, out, cats, ["199601"], k=2, representation="dense")
    sparse = run_monthly(spark, SF_SMALL, out, cats, ["199601"], k=2, representation="sparse", suffix="sparse")
    a = spark.read.json(dense[0]["path"] + "/meta-data.json")
    b = spark.read.json(sparse[0]["path"] + "/meta-data.json")
    sizes = lambda df: sorted(r["cluster_member_count"] for r in df.collect())
    assert sizes(a) == sizes(b)
    assert spark.read.parquet(sparse[0]["path"] + "/members").count() == spark.read.parquet(dense[0]["path"] + "/members").count()


def test_monthly_parallel_steps_and_month_pruning(spark, workdir):
    from segmint.plans.monthly import month_counts
    from segmint.session import materialize_table

    table_ = materialize_table(month_counts(spark, SF_SMALL, ["199601", "199602"]), ["month"])
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        table_.where(F.col("month") == "199602").explain()
    plan = buf.getvalue()
    assert "PartitionFilters: [isnotnull(month" in plan and "199602" in plan
    part = table(spark, SF_SMALL, "part", ["p_brand"])
    cats = {
        f"m{i}": part.where(F.col("p_brand").startswith(f"Brand#{i}")).select(F.col("p_brand").alias("page_id")).distinct()
        for i in (1, 2)
    }
    out = os.path.join(workdir, "out")
    got = run_monthly(spark, SF_SMALL, out, cats, ["199601", "199602"], k=2, parallelism=4)
    assert sorted((r["month"], r["category"], r["ran"]) for r in got) == [
        ("199601", "m1", True), ("199601", "m2", True), ("199602", "m1", True), ("199602", "m2", True)
    ]
    for r in got:  # every step wrote its own outputs, tagged with its own run id
        ids = {x["cluster_id"].rsplit("-", 1)[0] for x in spark.read.parquet(r["path"] + "/members").collect()}
        assert ids == {f"{r['month']}-{r['category']}"}
    again = run_monthly(spark, SF_SMALL, out, cats, ["199601", "199602"], k=2, parallelism=4)
    assert not any(r["ran"] for r in again)
