"""Entry A: the k-means job — load, train, assign, profile, write.

Two ways in:

* ``profile_job``: from the parquet tables (events → per-user vectors).
* ``run_kmeans_job``: from a segmentation input folder (``inputs.txt``,
  ``users.txt``, ``pages.txt``, ``names.txt``), writing ``data.json``
  (membership) and ``meta-data.json`` (profiles) under the output folder.
"""

from __future__ import annotations

import logging
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmint.operators.assign import assign
from segmint.operators.features import user_actions
from segmint.operators.profile import cluster_profile
from segmint.operators.sparse import assign_sparse, train_kmeans_sparse
from segmint.operators.train import centers_of, parse_params, train_kmeans
from segmint.operators.wide_profile import wide_profile
from segmint.session import materialize
from segmint.sources import sinks, text
from segmint.sources.counted import read_points_counted

log = logging.getLogger(__name__)

# Page sets wider than this run on sparse vectors.
DENSE_MAX_Q = 1024


def profile_job(
    spark: SparkSession,
    root: str,
    k: int,
    init: str = "k-means||",
    max_iter: int = 20,
    tol: float = 1e-4,
    seed: int = 7,
    run_id: str = "run",
) -> DataFrame:
    """events → vectors → fit → nested profile of every non-empty cluster."""
    points, dims = user_actions(spark, root)
    model = train_kmeans(points, k, init, max_iter, tol, seed)
    return cluster_profile(assign(points, model), centers_of(model), dims, run_id)


def load_inputs(spark: SparkSession, input_dir: str, sparse: bool = False, quarantine: str | None = None) -> tuple[DataFrame, DataFrame, int]:
    """(points, dims, Q) from a segmentation input folder.

    Fails when points and users differ in number or an index has no page.

    Points carry ``row_id``, ``user_id`` and either dense ``features`` or,
    with ``sparse=True``, the non-zero ``idx``/``val`` arrays of each line.
    With ``quarantine`` (a new folder) broken lines of points are set aside there with
    their reasons, their users left out, and the counts come from the same pass.
    """
    d = input_dir.rstrip("/")
    pages = text.read_lookup(spark, f"{d}/pages.txt", "dim", "dimension_id")
    names = text.read_lookup(spark, f"{d}/names.txt", "dim", "dimension_name")
    # The labels are zipped by position: the shorter file wins.
    dims = pages.join(names, "dim", "inner").withColumn("dim", F.col("dim").cast("int"))
    q = pages.count()
    if quarantine:
        read = read_points_counted(spark, f"{d}/inputs.txt", quarantine)
        raw, n, top = read.rows, read.counts["lines"], read.counts["top_index"]
        if read.counts["broken"]:
            log.warning("%d of %d lines of inputs.txt are broken, see %s", read.counts["broken"], n, quarantine)
    else:
        raw = materialize(text.read_points(spark, f"{d}/inputs.txt"))
        n, top = raw.agg(F.count(F.lit(1)), F.max(F.array_max(F.map_keys("features")))).first()
    users = text.read_lookup(spark, f"{d}/users.txt", "row_id", "user_id")
    n_users = users.count()
    if n != n_users:
        raise ValueError(f"{n} points but {n_users} users: every line of inputs.txt needs its line of users.txt")
    if top is not None and top >= q:
        raise ValueError(f"point index {top} has no line in pages.txt ({q} pages)")
    joined = raw.join(users, "row_id", "inner")
    if sparse:
        entries = F.filter(F.array_sort(F.map_entries("features")), lambda e: e["value"] != 0)
        points = joined.select(
            "row_id",
            "user_id",
            F.transform(entries, lambda e: e["key"]).alias("idx"),
            F.transform(entries, lambda e: e["value"]).alias("val"),
        )
    else:
        points = joined.select("row_id", "user_id", text.dense_from_map("features", q).alias("features"))
    return points, dims, q


def _is_sparse(spark: SparkSession, input_dir: str, representation: str) -> bool:
    if representation in ("dense", "sparse"):
        return representation == "sparse"
    q = text.read_lookup(spark, f"{input_dir.rstrip('/')}/pages.txt", "dim", "dimension_id").count()
    return q > DENSE_MAX_Q


def run_kmeans_job(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    k: int,
    params: str = "kmeans||,20,0.0001",
    run_id: str | None = None,
    seed: int = 7,
    representation: str = "auto",
) -> dict:
    """Entry A: folder in → members (parquet), data.json, meta-data.json out.

    Wide page sets (more than ``DENSE_MAX_Q`` pages) run on sparse vectors.
    """
    init, iterations, epsilon = parse_params(params)
    run_id = run_id or str(uuid.uuid4())
    sparse = _is_sparse(spark, input_dir, representation)
    points, dims, q = load_inputs(spark, input_dir, sparse)
    points = materialize(points)
    t = time.time()
    if sparse:
        model = train_kmeans_sparse(points, q, k, init, iterations, epsilon, seed)
    else:
        model = train_kmeans(points, k, init, iterations, epsilon, seed)
    log.info("model trained in %d s", time.time() - t)
    centers = centers_of(model)
    assigned = assign_sparse(points, centers) if sparse else assign(points, model)
    out = output_dir.rstrip("/")
    sinks.write_membership_rows(sinks.membership_rows(assigned, run_id), f"{out}/members", mode="overwrite")
    # the JSON form is built from the written rows: no second assignment pass
    sinks.write_membership(spark.read.parquet(f"{out}/members"), f"{out}/data.json", mode="overwrite")
    t = time.time()
    if sparse:
        profile = wide_profile(assigned, centers, dims, run_id)
    else:
        profile = cluster_profile(assigned, centers, dims, run_id)
    sinks.write_profile(profile, f"{out}/meta-data.json", mode="overwrite")
    log.info("profile written in %d s", time.time() - t)
    points.unpersist()
    return {"run_id": run_id, "k": k, "output": out}
