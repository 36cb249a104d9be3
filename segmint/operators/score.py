"""Model scoring (O29–O35): one aggregation per model, the rest is arithmetic.

From the per-cluster summary (k rows per model) come N, Σd² and the cluster
diameters; variance, log-likelihood, AIC and BIC are column expressions.

The log-likelihood uses the closed form: with σ² = Σd²/N, the sum over
points of ln(1/√(2πσ²) · e^(−d²/2σ²)) is exactly −N/2·(ln(2πσ²) + 1). The
per-point form underflows to −∞ once d²/σ² passes about 1490; the closed form
stays finite. σ² = 0 gives null.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmint.operators.assign import as_centers, assign
from segmint.operators.profile import cluster_summary


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def variance_expr(n, sse) -> Column:
    """σ² = Σd² / N."""
    return _c(sse) / _c(n)


def point_density(d2, variance) -> Column:
    """1/√(2πσ²) · e^(−½ d²/σ²), the one-dimensional factor whatever Q is."""
    v = _c(variance)
    return F.lit(1.0) / F.sqrt(F.lit(2.0 * math.pi) * v) * F.exp(F.lit(-0.5) * _c(d2) / v)


def ln_likelihood_expr(n, variance) -> Column:
    """Σ ln density = −N/2·(ln(2πσ²) + 1); null when σ² ≤ 0."""
    v = _c(variance)
    return F.when(v > 0, -_c(n).cast("double") / 2.0 * (F.log(F.lit(2.0 * math.pi) * v) + 1.0))


def aic_expr(ln_l, k, q) -> Column:
    """lnL − (k·Q + 1); larger is better."""
    return _c(ln_l) - (_c(k) * _c(q) + 1).cast("double")


def bic_expr(ln_l, k, q, n) -> Column:
    """lnL − (k·Q + 1)/2 · ln N; larger is better."""
    return _c(ln_l) - (_c(k) * _c(q) + 1).cast("double") / 2.0 * F.log(_c(n).cast("double"))


def score_summary(summary: DataFrame, q: int, k, by: Sequence[str] = ()) -> DataFrame:
    """One row per model: k, n, wssse, avg_diameter (O29), variance, ln_l, aic, bic.

    ``summary`` is ``cluster_summary`` output (only non-empty clusters appear).
    ``k`` is the model's number of centres: an int or the name of a column in ``by``.
    """
    k_col = F.col(k) if isinstance(k, str) else F.lit(int(k))
    per_model = summary.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.sum("sse").alias("wssse"),
        F.avg(F.when(F.col("n") > 0, F.col("max_dist") * 2.0)).alias("avg_diameter"),
    )
    if not (isinstance(k, str) and k in by):
        per_model = per_model.withColumn("k", k_col)
    qc = F.lit(int(q))
    return (
        per_model.withColumn("variance", variance_expr("n", "wssse"))
        .withColumn("ln_l", ln_likelihood_expr("n", "variance"))
        .withColumn("aic", aic_expr("ln_l", "k", qc))
        .withColumn("bic", bic_expr("ln_l", "k", qc, "n"))
        .select(*[c for c in by if c != "k"], F.col("k").cast("int").alias("k"), "n", "wssse", "avg_diameter", "variance", "ln_l", "aic", "bic")
    )


def score_centers(points: DataFrame, centers, features: str = "features") -> DataFrame:
    """Score fixed centres: assign, summarise and score in one pass (a 1-row frame)."""
    mat = as_centers(centers)
    k, q = mat.shape
    summary = cluster_summary(assign(points, mat, features), q, features, with_dims=False)
    return score_summary(summary, q, k)


def score_model(points: DataFrame, model, features: str = "features"):
    """The reference's ``[k wssse avg-d model]`` plus N, Q, BIC and AIC: one job."""
    from segmint.operators.train import ScoredModel

    mat = as_centers(model)
    k, q = mat.shape
    # a trained model is assigned by its own (JVM) prediction; a plain matrix exactly
    assigned = assign(points, model if hasattr(model, "transform") else mat, features)
    row = score_summary(cluster_summary(assigned, q, features, with_dims=False), q, k).first()
    return ScoredModel(
        k=int(mat.shape[0]),
        wssse=float(row["wssse"]),
        avg_diameter=float(row["avg_diameter"]),
        model=model,
        n=int(row["n"]),
        q=int(mat.shape[1]),
        bic=None if row["bic"] is None else float(row["bic"]),
        aic=None if row["aic"] is None else float(row["aic"]),
    )


def avg_cluster_diameter(summary: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean diameter over the clusters that have members."""
    return summary.where(F.col("n") > 0).groupBy(*by).agg(F.avg(F.col("max_dist") * 2.0).alias("avg_diameter"))


def model_variance(summary: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """σ² = Σd² / N per model."""
    return summary.groupBy(*by).agg((F.sum("sse") / F.sum("n")).alias("variance"))


def bics(k_curve: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """(k, bic) per model."""
    return k_curve.select(*by, "k", "bic")


def model_diameters(k_curve: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """(k, avg_diameter) per model."""
    return k_curve.select(*by, "k", "avg_diameter")


def model_errors(k_curve: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """(k, wssse) per model."""
    return k_curve.select(*by, "k", "wssse")


def score_many(points: DataFrame, centers_by_k: dict, features: str = "features") -> DataFrame:
    """Score several models in ONE pass over the points: (k, n, wssse, avg_diameter, variance, ln_l, aic, bic).

    Every Arrow batch is assigned under each model's centres and gives one row per
    (k, cluster) with its count, largest distance and sum of squares; one aggregation
    follows. Models that are too large to be broadcast together are scored in groups,
    one pass each.
    """
    import numpy as np
    import pyarrow as pa
    from pyspark.sql import types as T

    from segmint.operators.assign import MAX_CENTER_BYTES, feature_matrix, nearest_rows

    table = {int(k): as_centers(c) for k, c in centers_by_k.items()}
    if not table:
        raise ValueError("no models to score")
    qs = {m.shape[1] for m in table.values()}
    if len(qs) != 1:
        raise ValueError("all models must have the same width")
    q = qs.pop()
    if len(table) > 1 and sum(m.nbytes for m in table.values()) > MAX_CENTER_BYTES:
        ks = sorted(table)
        half = [score_many(points, {k: table[k] for k in part}, features) for part in (ks[: len(ks) // 2], ks[len(ks) // 2 :])]
        return half[0].union(half[1])
    bc = points.sparkSession.sparkContext.broadcast(table)
    feat = points.select(features)
    out_schema = T.StructType(
        [
            T.StructField("k", T.IntegerType(), False),
            T.StructField("cluster", T.IntegerType(), False),
            T.StructField("n", T.LongType(), False),
            T.StructField("max_dist", T.DoubleType(), False),
            T.StructField("sse", T.DoubleType(), False),
        ]
    )

    def run(batches):
        models = bc.value
        sq = {k: np.einsum("ij,ij->i", c, c) for k, c in models.items()}
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            x = feature_matrix(batch.column(0), q)
            for k, c in models.items():
                j, d2 = nearest_rows(x, c, sq[k])
                seen, at = np.unique(j, return_inverse=True)
                far = np.zeros(len(seen))
                np.maximum.at(far, at, d2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(seen), k, dtype=np.int32)),
                        pa.array(seen.astype(np.int32)),
                        pa.array(np.bincount(at).astype(np.int64)),
                        pa.array(np.sqrt(far)),
                        pa.array(np.bincount(at, weights=d2)),
                    ],
                    names=["k", "cluster", "n", "max_dist", "sse"],
                )

    assigned = feat.mapInArrow(run, out_schema)
    summary = assigned.groupBy("k", "cluster").agg(
        F.sum("n").alias("n"), F.max("max_dist").alias("max_dist"), F.sum("sse").alias("sse")
    )
    return score_summary(summary, q, "k", by=("k",))
