"""Sparse vectors for wide dimension sets (many pages per category).

A sparse point is two parallel arrays on the row, ``idx array<int>``
(ascending, distinct) and ``val array<double>`` (non-zero), plus the width
Q known to the caller. Nothing here ever materialises Q values per row:

* ``assemble_sparse``: (user, page, value) → (user, idx, val); at most Q
  entries per user after (user, page) pre-aggregation.
* ``vector_frame``: Spark ML ``SparseVector`` column for training, by way of
  the vectors' stored form (JVM only; the fit caches its input once).
* ``assign_sparse``: nearest centre per Arrow batch from the non-zeros,
  d² = ‖x‖² + ‖c‖² − 2x·c for the search, then the exact d² of the chosen
  centre as Σ_nz (x − c)² + Σ_zero c², with the dense tie rule.
* ``cluster_summary_sparse``: the same output as the dense summary (per
  cluster n, max/sum distance, Σd², and per dimension min, max, sum, mean,
  positives), aggregated over non-zeros only, then corrected for the
  implicit zeros of each cluster's members.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmint.operators.assign import MAX_CENTER_BYTES, as_centers
from segmint.session import ensure_checkpoint_dir, materialize
from segmint.sources.text import dense_from_map, spread

log = logging.getLogger(__name__)

# A dimension index up to this many bytes is broadcast.
MAX_BROADCAST_BYTES = 32 * 1024 * 1024


def assemble_sparse(
    counts: DataFrame,
    dims: DataFrame,
    user_col: str,
    page_col: str,
    value_col: str | None = "n",
    by: Sequence[str] = (),
    q: int | None = None,
) -> DataFrame:
    """(by…, user, idx, val): the non-zero dimensions of every user, ascending."""
    value = F.lit(1.0) if value_col is None else F.col(value_col).cast("double")
    d = dims.select(F.col("dimension_id").alias("_page"), F.col("dim").cast("int").alias("_dim"))
    size = dims.agg(F.sum(F.octet_length("dimension_id") + 16)).first()[0] or 0
    if size <= MAX_BROADCAST_BYTES:
        d = F.broadcast(d)  # size just checked; beyond it the planner picks the join
    keyed = counts.join(d, F.col(page_col).cast("string") == F.col("_page"), "inner")
    per_dim = keyed.groupBy(*by, user_col, "_dim").agg(F.sum(value).alias("_v")).where(F.col("_v") != 0)
    entries = per_dim.groupBy(*by, user_col).agg(F.sort_array(F.collect_list(F.struct("_dim", "_v"))).alias("_e"))
    return entries.select(
        *by,
        user_col,
        F.col("_e._dim").alias("idx"),
        F.col("_e._v").alias("val"),
    )


def dense_to_sparse(points: DataFrame, features: str = "features") -> DataFrame:
    """Dense ``array<double>`` → (idx, val) of the non-zero entries."""
    nz = F.filter(F.transform(features, lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda e: e["v"] != 0)
    return points.withColumn("_nz", nz).withColumn("idx", F.col("_nz.i")).withColumn("val", F.col("_nz.v")).drop(
        "_nz", features
    )


def sparse_to_dense(points: DataFrame, q: int) -> DataFrame:
    """(idx, val) → dense ``features`` (for narrow Q only)."""
    m = F.map_from_arrays(F.col("idx"), F.col("val"))
    return points.withColumn("features", dense_from_map(m, q)).drop("idx", "val")


def vector_frame(points: DataFrame, q: int) -> DataFrame:
    """Only a Spark ML sparse vector column ``_vec`` (for ``KMeans.fit``).

    Spark has no function from arrays to a sparse vector, but a vector is stored as the struct
    (type, size, indices, values): the points are written in that form and read again under a
    schema that names the vector type, all in the JVM. The table lies in the shared checkpoint
    folder; without one the vectors are made by a row function instead.
    """
    spark = points.sparkSession
    base = ensure_checkpoint_dir(spark)
    if not base:
        log.warning("spark.checkpoint.dir is unset; sparse vectors are made row by row")
        to_vec = F.udf(lambda idx, val: SparseVector(q, idx, val), VectorUDT())
        return points.select(to_vec("idx", "val").alias("_vec"))
    stored = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(q).cast("int").alias("size"),
                      F.col("idx").cast("array<int>").alias("indices"), F.col("val").cast("array<double>").alias("values"))
    path = f"{base.rstrip('/')}/vectors-{uuid.uuid4().hex}"
    points.select(stored.alias("_vec")).write.parquet(path)
    return spark.read.schema(T.StructType([T.StructField("_vec", VectorUDT())])).parquet(path)


def train_kmeans_sparse(points: DataFrame, q: int, k: int, init="k-means||", max_iter=20, tol=1e-4, seed=7, vectors=None):
    """O09 on sparse points: Spark ML k-means over sparse vectors.

    ``vectors`` (a stored ``vector_frame``) saves building them again when several fits share the points.
    """
    from pyspark.ml.clustering import KMeans

    from segmint.operators.train import check_params, one_center

    mode, max_iter, tol = check_params(init, max_iter, tol)
    vectors = vector_frame(points, q) if vectors is None else vectors
    if k == 1:
        return one_center(vectors)
    km = KMeans(k=k, initMode=mode, maxIter=max_iter, tol=tol, seed=seed, featuresCol="_vec", solver="row")
    return km.fit(vectors)


def _segment_dots(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, n: int, c: np.ndarray) -> np.ndarray:
    """X·Cᵀ for a batch given as entries (row id, column id, value) → (n × k): one bincount per centre."""
    out = np.empty((n, c.shape[0]), dtype=np.float64)
    for j in range(c.shape[0]):
        out[:, j] = np.bincount(rows, weights=vals * c[j, cols], minlength=n)
    return out


def _exact_sparse(rows, cols, vals, n, c, c_sq, jj):
    """Σ_nz (x − c)² + (‖c‖² − Σ_nz c²) for each row against centre jj[row], clamped at 0."""
    cj = c[jj[rows], cols]
    diff = vals - cj
    acc = np.bincount(rows, weights=diff * diff - cj * cj, minlength=n)
    return np.maximum(acc + c_sq[jj], 0.0)


def nearest_sparse(rows, cols, vals, n, c, c_sq):
    """(cluster, d2) per row of a sparse batch; lowest index on exact ties."""
    k = c.shape[0]
    x_sq = np.bincount(rows, weights=vals * vals, minlength=n)
    approx = x_sq[:, None] + c_sq[None, :] - 2.0 * _segment_dots(rows, cols, vals, n, c)
    j = np.argmin(approx, axis=1)
    if k > 1:
        two = np.partition(approx, 1, axis=1)[:, :2]
        unsure = np.nonzero((two[:, 1] - two[:, 0]) <= 1e-9 * (x_sq + c_sq.max()))[0]
        if unsure.size:
            # re-decide near-ties exactly, on the entries of those rows only
            pos = np.full(n, -1)
            pos[unsure] = np.arange(unsure.size)
            mask = pos[rows] >= 0
            r2, c2, v2, m = pos[rows[mask]], cols[mask], vals[mask], unsure.size
            best = np.full(m, np.inf)
            pick = np.zeros(m, dtype=j.dtype)
            for cand in range(k):
                d = _exact_sparse(r2, c2, v2, m, c, c_sq, np.full(m, cand))
                better = d < best
                best[better], pick[better] = d[better], cand
            j[unsure] = pick
    return j, _exact_sparse(rows, cols, vals, n, c, c_sq, j)


def assign_sparse(points: DataFrame, centers, idx: str = "idx", val: str = "val") -> DataFrame:
    """O10 on sparse points: add cluster, d2, dist.

    Centres beyond ``MAX_CENTER_BYTES`` are tried group by group; of equal distances the lowest cluster stays.
    """
    mat = as_centers(centers)
    most = max(1, MAX_CENTER_BYTES // mat[0].nbytes)
    found = _nearest_of(points, mat[:most], idx, val)
    for lo in range(most, len(mat), most):
        so_far = found.withColumnsRenamed({"cluster": "_cluster", "d2": "_d2", "dist": "_dist"})
        here = _nearest_of(so_far, mat[lo : lo + most], idx, val)
        nearer = F.col("d2") < F.col("_d2")
        best = [F.when(nearer, new).otherwise(F.col(f"_{c}")).alias(c) for c, new in
                (("cluster", F.col("cluster") + lo), ("d2", F.col("d2")), ("dist", F.col("dist")))]
        found = here.select(*points.columns, *best)
    return found


def _nearest_of(points: DataFrame, mat: np.ndarray, idx: str, val: str) -> DataFrame:
    """``assign_sparse`` for centres that are broadcast together."""
    import pyarrow as pa
    import pyarrow.compute as pc

    bc = points.sparkSession.sparkContext.broadcast(mat)
    i_idx, v_idx = points.columns.index(idx), points.columns.index(val)
    out_schema = T.StructType(
        list(points.schema.fields)
        + [
            T.StructField("cluster", T.IntegerType(), False),
            T.StructField("d2", T.DoubleType(), False),
            T.StructField("dist", T.DoubleType(), False),
        ]
    )
    names = points.columns + ["cluster", "d2", "dist"]

    def run(batches):
        c = bc.value
        c_sq = np.einsum("ij,ij->i", c, c)
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            ic, vc = batch.column(i_idx), batch.column(v_idx)
            lengths = pc.list_value_length(ic).fill_null(0).to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(n), lengths)
            cols = np.asarray(pc.list_flatten(ic).to_numpy(zero_copy_only=False), dtype=np.int64)
            vals = np.asarray(pc.list_flatten(vc).to_numpy(zero_copy_only=False), dtype=np.float64)
            j, d2 = nearest_sparse(rows, cols, vals, n, c, c_sq)
            cols_out = list(batch.columns) + [pa.array(j.astype(np.int32)), pa.array(d2), pa.array(np.sqrt(d2))]
            yield pa.RecordBatch.from_arrays(cols_out, names=names)

    return points.mapInArrow(run, out_schema)


def cluster_summary_sparse(assigned: DataFrame, q: int, by: Sequence[str] = ()) -> DataFrame:
    """Same columns as ``profile.cluster_summary``, from the non-zeros only, in one aggregation.

    Each row contributes its non-zero entries plus one marker entry (dim −1)
    that carries the row's distance, so the cluster-level and the
    per-dimension statistics come from the same pass and the same shuffle.
    """
    keys = [*by, "cluster"]
    marker = F.array(F.struct(F.lit(-1).alias("i"), F.lit(0.0).alias("v")))
    entries = F.concat(marker, F.arrays_zip(F.col("idx").alias("i"), F.col("val").alias("v")))
    exploded = assigned.select(*keys, "dist", "d2", F.explode(entries).alias("e"))
    is_row = F.col("e.i") < 0
    per_dim = exploded.groupBy(*keys, F.col("e.i").alias("dim")).agg(
        F.count(F.lit(1)).alias("nz"),
        F.max(F.when(is_row, F.col("dist"))).alias("max_dist"),
        F.sum(F.when(is_row, F.col("dist"))).alias("dist_sum"),
        F.sum(F.when(is_row, F.col("d2"))).alias("sse"),
        F.min("e.v").alias("mn"),
        F.max("e.v").alias("mx"),
        F.sum("e.v").alias("sm"),
        F.count_if(F.col("e.v") > 0).alias("ps"),
    )
    # At most Q + 1 entries per cluster: the profile's own size.
    fields = F.struct("dim", "nz", "max_dist", "dist_sum", "sse", "mn", "mx", "sm", "ps")
    packed = per_dim.groupBy(*keys).agg(F.sort_array(F.collect_list(fields)).alias("_e"))
    joined = packed.withColumn("_all", spread(F.col("_e"), "dim", q))
    row = F.col("_all")[0]  # the marker
    joined = joined.select(
        *keys,
        row["nz"].alias("n"),
        row["max_dist"].alias("max_dist"),
        row["dist_sum"].alias("dist_sum"),
        row["sse"].alias("sse"),
        F.slice("_all", 2, q).alias("_m"),
    )
    n = F.col("n")

    def per(fn):
        return F.transform("_m", fn)

    # A member without an entry has 0 in that dimension.
    has_zero = lambda e: e.isNull() | (e["nz"] < n)
    mins = per(lambda e: F.when(e.isNull(), F.lit(0.0)).when(has_zero(e), F.least(e["mn"], F.lit(0.0))).otherwise(e["mn"]))
    maxs = per(lambda e: F.when(e.isNull(), F.lit(0.0)).when(has_zero(e), F.greatest(e["mx"], F.lit(0.0))).otherwise(e["mx"]))
    sums = per(lambda e: F.coalesce(e["sm"], F.lit(0.0)))
    pos = per(lambda e: F.coalesce(e["ps"], F.lit(0).cast("bigint")))
    return joined.select(
        *keys,
        "n",
        "max_dist",
        "dist_sum",
        "sse",
        mins.alias("mins"),
        maxs.alias("maxs"),
        sums.alias("sums"),
        F.transform(sums, lambda s: s / n).alias("means"),
        pos.alias("positives"),
    )


def sparse_scorer(points: DataFrame, q: int, max_iter: int = 20, seed: int = 7):
    """k → ScoredModel for sparse points: fit, assign, one aggregation (for ``select_k``)."""
    from segmint.operators.score import score_summary
    from segmint.operators.select import MemoScorer
    from segmint.operators.train import ScoredModel, centers_of

    vectors = vector_frame(points, q).persist()  # built once for all fits

    def score(k):
        model = train_kmeans_sparse(points, q, k, max_iter=max_iter, seed=seed, vectors=vectors)
        a = assign_sparse(points, centers_of(model))
        base = a.groupBy("cluster").agg(
            F.count(F.lit(1)).alias("n"), F.max("dist").alias("max_dist"), F.sum("d2").alias("sse")
        )
        row = score_summary(base, q, k).first()
        return ScoredModel(
            k=k, wssse=row["wssse"], avg_diameter=row["avg_diameter"], model=model, n=row["n"], q=q,
            bic=row["bic"], aic=row["aic"],
        )

    return MemoScorer(score, owned=vectors)
