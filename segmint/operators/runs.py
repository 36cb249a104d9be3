"""Many models in one job: fixed-centre models for every run and every k.

A run is one point set (a month × category, a label …). For each run the
centres are that run's first rows by id, and a model with k centres uses the
first k of them. Each point is assigned once per k, in one pass: the table
of every run's centres (runs × max(ks) vectors, size-checked) is broadcast
to the executors and each Arrow batch is searched per run and k. Beyond the
size cap the run's centre list is joined on the run key instead and the
nearest centre is found inside the row.

This is the deterministic stand-in for training that the k-curve and the
k-selection operators are checked with, and a cheap way to score many
candidate centre sets at once.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmint.functions.vector import nearest_center
from segmint.operators.assign import MAX_CENTER_BYTES, feature_matrix, nearest_rows
from segmint.operators.profile import cluster_summary
from segmint.operators.score import score_summary



def run_centers(points: DataFrame, run_col: str, id_col: str, max_k: int, features: str = "features") -> DataFrame:
    """(run, centers array<array<double>>): the first ``max_k`` rows of each run by id."""
    w = Window.partitionBy(run_col).orderBy(id_col)
    firsts = points.select(run_col, id_col, features).withColumn("_j", F.row_number().over(w)).where(
        F.col("_j") <= max_k
    )
    # At most max_k entries per run.
    return firsts.groupBy(run_col).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_j", F.col(features).alias("c")))), lambda s: s["c"]).alias(
            "centers"
        )
    )


def _assign_runs_hof(points, cents, run_col, id_col, ks, features):
    joined = points.join(cents, run_col, "inner")
    per_k = F.explode(
        F.array(
            *[
                F.struct(F.lit(k).alias("k"), nearest_center(features, F.slice("centers", 1, k)).alias("a"))
                for k in ks
            ]
        )
    )
    return joined.select(run_col, id_col, features, per_k.alias("m")).select(
        run_col,
        F.col("m.k").alias("k"),
        id_col,
        features,
        F.col("m.a.cluster").cast("int").alias("cluster"),
        F.col("m.a.d2").alias("d2"),
        F.sqrt(F.col("m.a.d2")).alias("dist"),
    )


def _assign_runs_batches(points, table, run_col, id_col, ks, features, q):
    import pyarrow as pa

    bc = points.sparkSession.sparkContext.broadcast(table)
    fields = {f.name: f for f in points.schema.fields}
    out_schema = T.StructType(
        [
            fields[run_col],
            T.StructField("k", T.IntegerType(), False),
            fields[id_col],
            fields[features],
            T.StructField("cluster", T.IntegerType(), False),
            T.StructField("d2", T.DoubleType(), False),
            T.StructField("dist", T.DoubleType(), False),
        ]
    )
    names = [run_col, "k", id_col, features, "cluster", "d2", "dist"]

    def run(batches):
        per_run = bc.value
        sq = {r: np.einsum("ij,ij->i", c, c) for r, c in per_run.items()}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            runs = batch.column(0).to_numpy(zero_copy_only=False)
            x = feature_matrix(batch.column(2), q)
            for r in np.unique(runs):
                if r not in per_run:
                    continue
                idx = np.nonzero(runs == r)[0]
                sub = batch.take(pa.array(idx))
                xs = x[idx]
                for k in ks:
                    c = per_run[r][:k]
                    j, d2 = nearest_rows(xs, c, sq[r][:k])
                    yield pa.RecordBatch.from_arrays(
                        [
                            sub.column(0),
                            pa.array(np.full(len(idx), k, dtype=np.int32)),
                            sub.column(1),
                            sub.column(2),
                            pa.array(j.astype(np.int32)),
                            pa.array(d2),
                            pa.array(np.sqrt(d2)),
                        ],
                        names=names,
                    )

    return points.select(run_col, id_col, features).mapInArrow(run, out_schema)


def assign_runs(
    points: DataFrame, run_col: str, id_col: str, ks: Sequence[int], features: str = "features"
) -> DataFrame:
    """(run, k, id, features, cluster, d2, dist): every point under every k of its run.

    The per-run centre table (runs × max(ks) vectors) is broadcast to the
    executors when it fits ``MAX_CENTER_BYTES``; the nearest centre is then
    found per Arrow batch. Larger tables are joined on the run key and
    searched inside the row.
    """
    ks = sorted({int(k) for k in ks})
    cents = run_centers(points, run_col, id_col, max(ks), features)
    n_runs = cents.count()
    q = len(points.select(features).first()[0]) if n_runs else 0
    if n_runs * max(ks) * max(q, 1) * 8 <= MAX_CENTER_BYTES:
        table = {r[run_col]: np.asarray(r["centers"], dtype=np.float64) for r in cents.collect()}
        return _assign_runs_batches(points, table, run_col, id_col, ks, features, q)
    return _assign_runs_hof(points, cents, run_col, id_col, ks, features)


def runs_summary(
    assigned_runs: DataFrame, run_col: str, q: int, features: str = "features", with_dims: bool = False
) -> DataFrame:
    """Per (run, k, cluster) summary, one aggregation over all runs and ks."""
    return cluster_summary(assigned_runs, q, features, by=(run_col, "k"), with_dims=with_dims)


def k_curve(
    points: DataFrame,
    run_col: str,
    id_col: str,
    ks: Sequence[int],
    q: int,
    features: str = "features",
    run_id: str = "run_id",
) -> DataFrame:
    """(run_id, k, n, wssse, avg_diameter, variance, ln_l, aic, bic) for fixed-centre models."""
    summary = runs_summary(assign_runs(points, run_col, id_col, ks, features), run_col, q, features)
    curve = score_summary(summary, q, "k", by=(run_col, "k"))
    return curve.withColumnRenamed(run_col, run_id) if run_col != run_id else curve
