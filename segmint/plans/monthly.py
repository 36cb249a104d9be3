"""Entry C: the monthly pipeline over month × category.

activity (orders ⋈ lineitem ⋈ part: a customer "acts on" a brand by buying
it) → per (month, customer, brand) counts, computed once for all months
and written as a month-partitioned table in the checkpoint folder (each
step reads only its month) → for each month and category: keep the category's
brands, scale, assemble vectors → k (given, or chosen by k selection) →
fit → assign → write membership rows, membership JSON and profiles under
``<out>/month=<m>/category=<c>[-suffix]``.

Categories with more than ``DENSE_MAX_Q`` pages run on sparse vectors
(``operators.sparse``); narrower ones on dense arrays.

A completed output folder makes its step a no-op, so rerunning the
pipeline with the same arguments does no fit; a new ``suffix`` opens new
outputs for the segmentation step only.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmint.operators.assign import assign
from segmint.operators.features import (
    assemble_vectors,
    customer_brand_counts,
    dimension_table,
    filter_to_category,
    scale_actions,
)
from segmint.operators.profile import cluster_profile
from segmint.operators.select import select_k
from segmint.operators.sparse import assemble_sparse, assign_sparse, sparse_scorer, train_kmeans_sparse
from segmint.operators.train import centers_of, train_kmeans
from segmint.operators.wide_profile import wide_profile
from segmint.session import materialize, materialize_table
from segmint.sources import sinks
from segmint.sources.publish import publish_once

log = logging.getLogger(__name__)

# Categories wider than this many pages use sparse vectors.
DENSE_MAX_Q = 1024


ALL_MONTHS = "all"


def month_counts(spark: SparkSession, root: str, months: Sequence[str] | None = None) -> DataFrame:
    """(month, customer, brand, n); ``months=None`` puts the whole history in one ``all`` bucket."""
    if months is None:
        return customer_brand_counts(spark, root).withColumn("month", F.lit(ALL_MONTHS))
    return customer_brand_counts(spark, root, by_month=True, months=months)


def run_monthly(
    spark: SparkSession,
    root: str,
    out: str,
    categories: dict[str, DataFrame],
    months: Sequence[str] | None,
    k: int | None = None,
    ks: Sequence[int] | None = None,
    max_iter: int = 20,
    seed: int = 7,
    scale: float | None = None,
    suffix: str = "",
    representation: str = "auto",
    parallelism: int = 1,
) -> list[dict]:
    """Run every (month, category); returns one record per step with ``ran`` True/False."""

    def _fit_and_write(points, dims, q, sparse, path, run_id):
        n = points.count()
        step = "run_id string, requested_k int, k int"
        if n == 0:  # the three outputs exist, empty and with their schema
            log.warning("no activity for %s", run_id)
            none = spark.createDataFrame([], "cluster_id string, user_id string")
            sinks.write_membership_rows(none, f"{path}/members", mode="overwrite")
            sinks.write_membership(none, f"{path}/data.json", mode="overwrite")
            sinks.write_profile(spark.createDataFrame([], sinks.PROFILE_SCHEMA), f"{path}/meta-data.json", mode="overwrite")
            spark.createDataFrame([(run_id, k, 0)], step).write.mode("overwrite").json(f"{path}/step")
            return
        kk = k
        if kk is None and n == 1:
            kk = 1
        if kk is None:
            if sparse:
                kk = select_k(points, ks=ks, scorer=sparse_scorer(points, q, max_iter)).k
            else:
                kk = select_k(points.select("features"), ks=ks, max_iter=max_iter).k
        if kk > n:
            log.warning("%s: %d users for k = %d, using k = %d (both are in the step record)", run_id, n, kk, n)
            kk = n
        users = points.withColumnRenamed("o_custkey", "user_id")
        if sparse:
            model = train_kmeans_sparse(points, q, kk, "k-means||", max_iter, 1e-4, seed)
            centers = centers_of(model)
            assigned = assign_sparse(users, centers)
        else:
            model = train_kmeans(points, kk, "k-means||", max_iter, 1e-4, seed)
            centers = centers_of(model)
            assigned = assign(users, model)
        rows = sinks.membership_rows(assigned.withColumn("user_id", F.col("user_id").cast("string")), run_id)
        sinks.write_membership_rows(rows, f"{path}/members", mode="overwrite")
        # the JSON form is built from the written rows: no second assignment pass
        written = spark.read.parquet(f"{path}/members")
        sinks.write_membership(written, f"{path}/data.json", mode="overwrite")
        if sparse:
            profile = wide_profile(assigned, centers, dims, run_id)
        else:
            profile = cluster_profile(assigned, centers, dims, run_id)
        sinks.write_profile(profile, f"{path}/meta-data.json", mode="overwrite")
        # The marker of a completed step is written last.
        spark.createDataFrame([(run_id, k, kk)], step).write.mode("overwrite").json(f"{path}/step")

    # one table for all steps, partitioned by month: each step reads only its month
    counts = materialize_table(month_counts(spark, root, months), ["month"])
    steps = []
    for month in months if months is not None else [ALL_MONTHS]:
        month_rows = counts.where(F.col("month") == month).drop("month")
        for cat_name, category in categories.items():
            path = f"{out.rstrip('/')}/month={month}/category={cat_name}{('-' + suffix) if suffix else ''}"
            run_id = f"{month}-{cat_name}"

            def build(path, month_rows=month_rows, category=category, run_id=run_id):
                kept = filter_to_category(month_rows, category, "p_brand")
                scaled = scale_actions(kept, scale)
                dims = dimension_table(scaled, "p_brand")
                q = dims.count()
                sparse = representation == "sparse" or (representation == "auto" and q > DENSE_MAX_Q)
                if sparse:
                    points = materialize(assemble_sparse(scaled, dims, "o_custkey", "p_brand"))
                else:
                    points = materialize(assemble_vectors(scaled, dims, "o_custkey", "p_brand", q=q))
                try:
                    _fit_and_write(points, dims, q, sparse, path, run_id)
                finally:
                    points.unpersist()  # one step's points; never kept across steps

            steps.append((month, cat_name, path, build))

    def run(step):
        month, cat_name, path, build = step
        ran = publish_once(spark, path, build)
        return {"month": month, "category": cat_name, "path": path, "ran": ran}

    try:
        if parallelism <= 1 or len(steps) <= 1:
            return [run(st) for st in steps]
        # independent steps, each its own set of Spark jobs on the shared session
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            return list(pool.map(run, steps))
    finally:
        counts.unpersist()
