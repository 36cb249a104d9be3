"""Registered queries: one per operator, each over the given tables.

Inputs (all derived by Spark from the parquet tables):

* ``ua``     F4: events → per-user counts per event type (Q = 5)
* ``emb``    F5: embeddings as double vectors (Q = 64), runs = labels
* ``brands`` F6: orders ⋈ lineitem ⋈ part, lines per (customer, brand)

Deterministic models for exact checks: the first ``K_FIXED`` users by id
are the centres of the ``ua`` model; the embedding k-curve uses, per label,
its first k vectors by id for k in ``KS_CURVE``. Queries with real
(seeded) training have no SQL twin.

Every double column is rounded to ``DIGITS`` places on output so that the
SQL twin (``oracle.py``) can be compared value for value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmint.functions import keys as K
from segmint.functions import vector as V
from segmint.functions.curve_math import slope
from segmint.operators import curve as C
from segmint.operators import features as FE
from segmint.operators import profile as P
from segmint.operators import runs as R
from segmint.operators import score as S
from segmint.operators import select as SEL
from segmint.operators import sparse as SP
from segmint.operators import train as TR
from segmint.operators.fold import cluster_fold
from segmint.operators.assign import (
    as_centers,
    assign,
    attach_users,
    centers_frame,
    distance_to_center,
    first_rows_as_centers,
)
from segmint.operators.wide_profile import wide_profile
from segmint.sources import jsonl, sinks, text
from segmint.sources.counted import read_points_counted
from segmint.session import ensure_checkpoint_dir, materialize
from segmint.sources.tables import table

DIGITS = 6
K_FIXED = 4
KS_CURVE = (2, 4, 8, 16)
RUN = "run"
HASH_SLOTS = 16
SEED = 7
TRAIN_ITER = 20

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ---- shared inputs --------------------------------------------------------------------------


def _ua(spark, root):
    return FE.user_actions(spark, root)


def _ua_model(spark, root):
    pts, dims = _ua(spark, root)
    cents = first_rows_as_centers(pts, K_FIXED, "user_id")
    return pts, dims, cents


def _ua_assigned(spark, root):
    pts, dims, cents = _ua_model(spark, root)
    return assign(pts, cents), dims, cents


def _ua_summary_all(spark, root):
    a, dims, cents = _ua_assigned(spark, root)
    summary = P.cluster_summary(a, as_centers(cents).shape[1])
    return P.with_all_clusters(summary, cents), dims, cents


def _emb(spark, root):
    return FE.embedding_points(spark, root)


def _emb_runs_assigned(spark, root):
    return R.assign_runs(_emb(spark, root), "label", "vec_id", KS_CURVE)


def _emb_runs_summary(spark, root):
    return R.runs_summary(_emb_runs_assigned(spark, root), "label", 64).withColumnRenamed("label", "run_id")


def _curve(spark, root):
    return R.k_curve(_emb(spark, root), "label", "vec_id", KS_CURVE, 64)


def _brand_counts(spark, root):
    return FE.customer_brand_counts(spark, root)


def _categories(spark, root):
    """(category_id, page_id): one category per manufacturer, its pages are the manufacturer's brands."""
    part = table(spark, root, "part", ["p_brand"])
    return part.select(
        F.substring("p_brand", 7, 1).cast("bigint").alias("category_id"), F.col("p_brand").alias("page_id")
    ).distinct()


def _all_brands(spark, root):
    """One category holding every brand."""
    part = table(spark, root, "part", ["p_brand"])
    return part.select(F.col("p_brand").alias("page_id")).distinct()


# ---- sources (O01–O04) ----------------------------------------------------------------------


def q_read_points(spark, root):
    pts, _ = _ua(spark, root)
    lines = pts.orderBy("user_id").select(text.format_points("features").alias("value"))
    parsed = text.read_points(spark, lines)
    return parsed.select("row_id", F.explode("features").alias("dim", "value"))


def q_read_points_counted(spark, root):
    pts, _ = _ua(spark, root)
    good = text.format_points("features")
    # users whose first two counts are equal get broken tokens; those with a larger third than fourth name indexes twice
    value = (F.when(F.col("features")[0] == F.col("features")[1], F.replace(good, F.lit(":"), F.lit(";")))
             .when(F.col("features")[2] > F.col("features")[3], F.concat(good, F.lit(" "), good)).otherwise(good))
    folder = f"{ensure_checkpoint_dir(spark, fallback_local=True)}/counted-{uuid.uuid4().hex}"
    read = read_points_counted(spark, pts.orderBy("user_id").select(value.alias("value")), folder)
    counts = [F.lit(read.counts[c]).cast("bigint").alias(c) for c in ("lines", "broken", "entries", "top_index")]
    rows = read.rows.select("row_id", F.lit(None).cast("string").alias("reason"), F.explode("features").alias("dim", "value"))
    broken = read.broken.select("row_id", "reason", F.lit(None).cast("int").alias("dim"), F.lit(None).cast("double").alias("value"))
    return rows.union(broken).select("*", *counts)


def q_read_lookup(spark, root):
    pts, _ = _ua(spark, root)
    lines = pts.orderBy("user_id").select(F.col("user_id").cast("string").alias("value"))
    return text.read_lookup(spark, lines, "row_id", "user_id")


def q_read_category(spark, root):
    part = table(spark, root, "part", ["p_brand"])
    pages = part.select(
        F.substring("p_brand", 7, 1).cast("bigint").alias("id"), F.col("p_brand")
    ).distinct()
    # A handful of brands per manufacturer: the page list of one category.
    docs = pages.groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct(F.col("p_brand").alias("id"), F.col("p_brand").alias("name")))).alias(
            "facebook"
        )
    )
    lines = docs.select(F.to_json(F.struct("id", "facebook")).alias("value"))
    return jsonl.read_category(spark, lines)


def q_read_user_activity(spark, root):
    events = table(spark, root, "events", ["user_id", "event_type"])
    users = FE.group_by_user(events, "user_id", "event_type")
    activity = users.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.lit("1").alias("gender"),
        F.col("actions").alias("page_like"),
        *[F.create_map().cast("map<string,bigint>").alias(c) for c in ("page_comment", "post_like", "post_comment")],
    )
    lines = activity.select(jsonl.activity_line().alias("value"))
    parsed = jsonl.read_user_activity(spark, lines)
    return parsed.select("user_id", "gender", F.explode("page_like").alias("page", "n"))


# ---- feature building (O05–O08) ---------------------------------------------------------------


def q_group_by_user(spark, root):
    events = table(spark, root, "events", ["user_id", "event_type"])
    users = FE.group_by_user(events, "user_id", "event_type")
    return users.select("user_id", F.explode("actions").alias("page", "n"))


def _category_counts(spark, root):
    return FE.filter_to_category(
        _brand_counts(spark, root), _categories(spark, root), "p_brand", category_col="category_id"
    )


def q_filter_to_category(spark, root):
    """Both forms, on categories that leave brands out: several tagged ones (inner join), and one (semi-join, tagged −1)."""
    counts = _brand_counts(spark, root)
    some = _categories(spark, root).where(F.substring("page_id", 8, 1) <= "3")
    tagged = FE.filter_to_category(counts, some, "p_brand", category_col="category_id")
    one = FE.filter_to_category(counts, some.where("category_id = 2"), "p_brand").withColumn("category_id", F.lit(-1).cast("bigint"))
    return tagged.unionByName(one).select("category_id", "o_custkey", "p_brand", "n")


def q_scale_actions(spark, root):
    return rounded(FE.scale_actions(_category_counts(spark, root), by=("category_id",)))


def q_assemble_vectors(spark, root):
    counts = _brand_counts(spark, root)
    dims = FE.dimension_table(counts, "p_brand")
    vecs = FE.assemble_vectors(counts, dims, "o_custkey", "p_brand")
    return rounded(vecs.select("o_custkey", F.posexplode("features").alias("dim", "value")))


# ---- training (O09, O12) ----------------------------------------------------------------------


def _towns(spark, root):
    """Points whose best models SQL can state: the embeddings' first four components around four far places,
    two and two of a kind, so that one, two, three and four clusters have one clear optimum each."""
    e = table(spark, root, "embeddings", ["vec_id", "embedding"])
    east, north = F.col("vec_id") % 4 >= 2, F.col("vec_id") % 2 == 1
    place = [F.when(east, 1000.0).otherwise(0.0), F.when(north & east, 120.0).when(north, 12.0).otherwise(0.0)]
    around = [F.element_at("embedding", i).cast("double") * 0.5 for i in range(1, 5)]
    return e.select("vec_id", F.array(*place, *around).alias("features"))


KS_TOWNS = (1, 2, 4)


def _model_rows(spark, scored) -> DataFrame:
    rows = [(s.k, s.n, s.wssse, s.avg_diameter, s.aic, s.bic) for s in scored]
    return rounded(spark.createDataFrame(rows, "k int, n bigint, wssse double, avg_diameter double, aic double, bic double"))


def q_train_kmeans(spark, root):
    """Centres and members of a real fit; clusters are numbered by their centres' places."""
    pts = materialize(_towns(spark, root))
    model = TR.train_kmeans(pts, K_FIXED, "kmeans||", TRAIN_ITER, 1e-4, SEED)
    cents = sorted(TR.centers_of(model).tolist())
    members = assign(pts, cents).groupBy("cluster").agg(F.count(F.lit(1)).alias("members"))
    cells = centers_frame(spark, cents).join(members, "cluster").select("cluster", "members", F.posexplode("center").alias("dim", "center"))
    return rounded(cells)


def q_train_kmeans_default(spark, root):
    return _model_rows(spark, [TR.train_kmeans_default(materialize(_towns(spark, root)), K_FIXED, TRAIN_ITER)])


def q_compute_next_model(spark, root):
    """The models of a search's next steps: two clusters, then four."""
    pts = materialize(_towns(spark, root))
    return _model_rows(spark, [TR.compute_next_model(pts, k, TRAIN_ITER) for k in (2, 4)])


def q_next_model_diameter(spark, root):
    pts = materialize(_towns(spark, root))
    d, model = TR.next_model_diameter(pts, K_FIXED, TRAIN_ITER)
    return rounded(spark.createDataFrame([(len(model.clusterCenters()), float(d))], "k int, avg_diameter double"))


def q_cluster_centers(spark, root):
    _, _, cents = _ua_model(spark, root)
    return rounded(centers_frame(spark, cents).select("cluster", F.posexplode("center").alias("dim", "center")))


# ---- assignment (O10, O14, O25a) --------------------------------------------------------------


def q_assign(spark, root):
    a, _, _ = _ua_assigned(spark, root)
    return rounded(a.select("user_id", "cluster", "d2"))


def q_distance_to_center(spark, root):
    a, _, _ = _ua_assigned(spark, root)
    return rounded(distance_to_center(a, "user_id"))


def q_attach_users(spark, root):
    pts, _, cents = _ua_model(spark, root)
    ordered = pts.orderBy("user_id")
    rows = text.index_rows(ordered.select("features"), "row_id")
    users = text.read_lookup(spark, ordered.select(F.col("user_id").cast("string")), "row_id", "user_id")
    predictions = assign(rows, cents).select("row_id", "cluster")
    return attach_users(predictions, users).select("user_id", "cluster")


# ---- profile (O11, O13–O24, O23a) -------------------------------------------------------------


def _with_empty_cluster(spark, root):
    """The fixed model and its first centre once more: ties go to the first, so the last cluster is empty."""
    pts, dims, cents = _ua_model(spark, root)
    cents = [*as_centers(cents), as_centers(cents)[0]]
    return assign(pts, cents), dims, cents


def q_cluster_counts(spark, root):
    a, _, cents = _with_empty_cluster(spark, root)
    return P.cluster_counts(P.with_all_clusters(P.cluster_summary(a, as_centers(cents).shape[1]), cents))


def q_cluster_diameters(spark, root):
    full, _, _ = _ua_summary_all(spark, root)
    return rounded(P.cluster_diameters(full))


def q_cluster_max_distance(spark, root):
    full, _, _ = _ua_summary_all(spark, root)
    return rounded(P.cluster_max_distance(full))


def q_cluster_distance_sum(spark, root):
    full, _, _ = _ua_summary_all(spark, root)
    return rounded(P.cluster_distance_sum(full))


def q_cluster_reduce(spark, root):
    a, _, _ = _ua_assigned(spark, root)
    return rounded(P.cluster_reduce(a, F.min("dist").alias("min_dist"), F.max("d2").alias("max_d2")))


def _span(x, y):
    """Lowest values in a vector's first half, highest in its second."""
    half = x.shape[-1] // 2
    return np.concatenate([np.minimum(x[..., :half], y[..., :half]), np.maximum(x[..., half:], y[..., half:])], axis=-1)


def q_cluster_reduce_function(spark, root):
    """A Python reduce over whole vectors: the box around each cluster, of the points laid twice end to end."""
    a, _, _ = _ua_assigned(spark, root)
    boxes = cluster_fold(a.select("cluster", F.concat("features", "features").alias("box")), _span, "box", elementwise=True)
    half = (F.size("box") / 2).cast("int")
    sides = F.arrays_zip(F.slice("box", 1, half).alias("low"), F.slice("box", half + 1, half).alias("high"))
    return rounded(boxes.select("cluster", F.posexplode(sides).alias("dim", "s")).select("cluster", "dim", "s.low", "s.high"))


def _dim_rows(spark, root):
    full, dims, _ = _ua_summary_all(spark, root)
    return P.dimension_rows(full, dims=dims)


def q_cluster_mins(spark, root):
    return rounded(_dim_rows(spark, root).select("cluster", "dim", "min"))


def q_cluster_maxes(spark, root):
    return rounded(_dim_rows(spark, root).select("cluster", "dim", "max"))


def q_cluster_sums(spark, root):
    return rounded(_dim_rows(spark, root).select("cluster", "dim", "sum"))


def q_cluster_averages(spark, root):
    return rounded(_dim_rows(spark, root).select("cluster", "dim", "avg"))


def q_cluster_dim_users(spark, root):
    return _dim_rows(spark, root).select("cluster", "dim", "member_count")


def q_attach_dimensions(spark, root):
    return rounded(_dim_rows(spark, root).select("cluster", "dimension_id", "dimension_name", "center"))


def q_wssse(spark, root):
    a, _, _ = _ua_assigned(spark, root)
    return rounded(P.wssse(a))


def _profile(spark, root, keep_empty=False):
    a, dims, cents = _ua_assigned(spark, root)
    return P.cluster_profile(a, cents, dims, RUN, keep_empty=keep_empty)


def q_cluster_profile(spark, root):
    prof = _profile(spark, root)
    flat = prof.select(
        "cluster_id",
        "cluster_member_count",
        "private",
        "cluster_diameter",
        "cluster_wssse",
        F.posexplode("dimensions").alias("dim", "d"),
    ).select(
        "cluster_id",
        "cluster_member_count",
        "private",
        "cluster_diameter",
        "cluster_wssse",
        F.col("dim").cast("int").alias("dim"),
        "d.dimension_id",
        "d.dimension_name",
        "d.member_count",
        "d.center",
        "d.min",
        "d.max",
        "d.avg",
    )
    return rounded(flat)


def q_cluster_profile_wide(spark, root):
    """Profiles over all parts as pages: centres and statistics stay (cluster, dim) rows, cut into parts of 100 dimensions."""
    orders = table(spark, root, "orders", ["o_orderkey", "o_custkey"])
    items = table(spark, root, "lineitem", ["l_orderkey", "l_partkey"])
    counts = orders.join(items, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey", F.col("l_partkey").cast("string").alias("page_id")).agg(F.count(F.lit(1)).alias("n"))
    dims = materialize(FE.dimension_table(counts, "page_id"))
    q = dims.count()
    points = materialize(SP.assemble_sparse(counts, dims, "o_custkey", "page_id"))
    first = points.orderBy("o_custkey").limit(K_FIXED).collect()
    cents = np.zeros((len(first), q))
    for j, r in enumerate(first):
        cents[j, r["idx"]] = r["val"]
    prof = wide_profile(SP.assign_sparse(points, cents), cents, dims, RUN, part_dims=100)
    head = ["cluster_id", "cluster_member_count", "cluster_diameter", "cluster_wssse"]
    return rounded(prof.select(*head, "part", F.explode("dimensions").alias("d")).select(*head, "part", "d.*"))


def q_drop_empty_clusters(spark, root):
    a, dims, cents = _with_empty_cluster(spark, root)
    prof = P.drop_empty_clusters(P.cluster_profile(a, cents, dims, RUN, keep_empty=True))
    return rounded(prof.select("cluster_id", "cluster_member_count", "cluster_diameter"))


# ---- sinks (O25, O25b, O26) and ids (O51, O54b) ------------------------------------------------


def q_membership_rows(spark, root):
    a, _, _ = _ua_assigned(spark, root)
    return sinks.membership_rows(a.withColumn("user_id", F.col("user_id").cast("string")), RUN)


def q_write_membership(spark, root):
    a, _, _ = _ua_assigned(spark, root)
    rows = sinks.membership_rows(a.withColumn("user_id", F.col("user_id").cast("string")), RUN)
    return sinks.membership_lines(rows)


def q_write_profile(spark, root):
    prof = _profile(spark, root)
    return sinks.profile_lines(prof, digits=DIGITS)


def q_consistent_hash(spark, root):
    cust = table(spark, root, "customer", ["c_custkey", "c_name"])
    return cust.select("c_custkey", K.consistent_hash("c_name", HASH_SLOTS).alias("bucket"))


def q_consistent_hash_utf16(spark, root):
    """The reference's own bucket, of names in Latin letters and of the same names moved to other planes."""
    cust = table(spark, root, "customer", ["c_custkey", "c_name"])
    moved = F.translate("c_name", "Custome", "Çü\u4e16\u2028\U0001f600\uffffé")
    return cust.select("c_custkey", K.consistent_hash("c_name", HASH_SLOTS, "utf16").alias("bucket"), K.murmur3_utf16(moved).alias("moved_hash"))


def q_run_cluster_id(spark, root):
    a, _, _ = _ua_assigned(spark, root)
    return a.select("user_id", K.cluster_id(RUN, "cluster").alias("cluster_id"))


def q_write_once(spark, root):
    """The same pipeline step twice; the second finds the completed output and skips."""
    from segmint.plans.monthly import run_monthly

    base = ensure_checkpoint_dir(spark, fallback_local=True)
    out = f"{base.rstrip('/')}/write-once-{uuid.uuid4().hex}"
    cats = {"all": _all_brands(spark, root)}
    found = None
    for attempt in (1, 2):
        for r in run_monthly(spark, root, out, cats, None, k=2):
            row = spark.read.parquet(f"{r['path']}/members").agg(F.count(F.lit(1)).alias("members")).select(
                F.lit(r["month"]).alias("month"), F.lit(r["category"]).alias("category"), F.lit(attempt).alias("attempt"), F.lit(r["ran"]).alias("ran"), "members")
            found = row if found is None else found.union(row)
    return found


# ---- scalar vector functions (O52a–d) ----------------------------------------------------------


def _emb_with_anchor(spark, root):
    emb = _emb(spark, root)
    anchors = R.run_centers(emb, "label", "vec_id", 1).select("label", F.col("centers")[0].alias("anchor"))
    return emb.join(FE.checked_broadcast(anchors, 1_000_000), "label")


def q_square(spark, root):
    emb = _emb(spark, root)
    cells = emb.select("vec_id", F.posexplode("features").alias("dim", "x"))
    return rounded(cells.select("vec_id", "dim", V.square("x").alias("sq")))


def q_vector_diff(spark, root):
    e = _emb_with_anchor(spark, root)
    return rounded(e.select("vec_id", F.posexplode(V.vector_diff("features", "anchor")).alias("dim", "diff")))


def q_vector_norm(spark, root):
    emb = _emb(spark, root)
    return rounded(emb.select("vec_id", V.vector_norm("features").alias("norm")))


def q_euclidean_distance(spark, root):
    e = _emb_with_anchor(spark, root)
    return rounded(e.select("vec_id", V.euclidean_distance("features", "anchor", 64).alias("distance")))


# ---- scoring (O29–O35) -----------------------------------------------------------------------


def q_avg_cluster_diameter(spark, root):
    return rounded(S.avg_cluster_diameter(_emb_runs_summary(spark, root), by=("run_id", "k")))


def q_model_diameters(spark, root):
    return rounded(S.model_diameters(_curve(spark, root).withColumnRenamed("label", "run_id")))


def q_model_errors(spark, root):
    return rounded(S.model_errors(_curve(spark, root)))


def q_cluster_sq_distance(spark, root):
    return rounded(P.cluster_sq_distance(_emb_runs_summary(spark, root), by=("run_id", "k")))


def q_model_variance(spark, root):
    return rounded(S.model_variance(_emb_runs_summary(spark, root), by=("run_id", "k")))


def q_point_density(spark, root):
    a = _emb_runs_assigned(spark, root).withColumnRenamed("label", "run_id")
    var = S.model_variance(P.cluster_summary(a, 64, by=("run_id", "k")), by=("run_id", "k"))
    return rounded(
        a.join(FE.checked_broadcast(var, 1_000_000), ["run_id", "k"]).select(
            "run_id", "k", "vec_id", S.point_density("d2", "variance").alias("density")
        )
    )


def q_ln_likelihood(spark, root):
    return rounded(_curve(spark, root).select("run_id", "k", "ln_l"))


def q_aic(spark, root):
    return rounded(_curve(spark, root).select("run_id", "k", "aic"))


def q_bic(spark, root):
    return rounded(_curve(spark, root).select("run_id", "k", "bic"))


def q_bics(spark, root):
    return rounded(S.bics(_curve(spark, root)))


# ---- curve operators (O36–O39, O44–O50) ----------------------------------------------------------


def q_successive_pairs(spark, root):
    return rounded(C.successive_pairs(_curve(spark, root), "avg_diameter"))


def q_slope(spark, root):
    p = C.successive_pairs(_curve(spark, root), "wssse")
    return rounded(p.select("run_id", "k1", "k2", slope("k1", "v1", "k2", "v2").alias("slope")))


def q_k_slopes(spark, root):
    return rounded(C.k_slopes(_curve(spark, root), "avg_diameter"))


def _steep_curve(spark, root):
    """Diameters times 20: slopes on both sides of −1."""
    return _curve(spark, root).withColumn("avg_diameter", F.col("avg_diameter") * 20)


def q_filter_slopes(spark, root):
    return rounded(C.filter_slopes(C.k_slopes(_steep_curve(spark, root), "avg_diameter")))


def q_max_bic_gap(spark, root):
    return rounded(C.max_bic_gap(_curve(spark, root)))


def q_best_k_range_bic(spark, root):
    return rounded(C.best_k_range_bic(_curve(spark, root)))


def q_best_k_range_slope(spark, root):
    return rounded(C.best_k_range_slope(_steep_curve(spark, root), "avg_diameter"))


def q_best_k_diameter_drop(spark, root):
    return rounded(C.best_k_diameter_drop(_curve(spark, root), "avg_diameter"))


def q_best_k_error_ratio(spark, root):
    return rounded(C.best_k_error_ratio(_curve(spark, root), "wssse"))


def q_elbow_point(spark, root):
    return rounded(C.elbow_point(_curve(spark, root), "avg_diameter"))


def q_midpoint(spark, root):
    return rounded(C.curve_midpoint(_curve(spark, root), "avg_diameter"))


def q_scale_points(spark, root):
    return rounded(C.scale_points(_curve(spark, root), "wssse"))


def q_first_k(spark, root):
    return C.first_k(_curve(spark, root))


def _diameters(spark, root):
    return P.cluster_diameters(_emb_runs_summary(spark, root), by=("run_id", "k"))


def q_diameter_observations(spark, root):
    return rounded(C.diameter_observations(_diameters(spark, root)))


def q_overall_mean(spark, root):
    return rounded(C.overall_mean(C.diameter_observations(_diameters(spark, root))))


def q_between_group_ssd(spark, root):
    return rounded(C.between_group_ssd(C.diameter_observations(_diameters(spark, root))))


def q_msb(spark, root):
    return rounded(C.msb(C.diameter_observations(_diameters(spark, root))))


def q_center_data(spark, root):
    return rounded(C.center_data(_diameters(spark, root)))


# ---- k selection (O27, O28, O40–O43) -----------------------------------------------------------


def q_candidate_ks(spark, root):
    """Both branches of the rule: the usual limit, and one below the number of points."""
    pts, _ = _ua(spark, root)
    small = SEL.candidate_ks_frame(pts).withColumn("branch", F.lit("small"))
    return small.union(SEL.candidate_ks_frame(pts, limit=5, max_k=100, min_k=8).withColumn("branch", F.lit("large")))


def q_sweep(spark, root):
    pts = materialize(_towns(spark, root).select("features"))
    return _model_rows(spark, SEL.sweep_models(pts, KS_TOWNS, TRAIN_ITER))


KS_SEARCH = (2, 4, 8, 16, 32)


def _ua_fixed_scorer(spark, root):
    pts, _ = _ua(spark, root)
    return SEL.fixed_center_scorer(pts, "user_id")


def _sweep_range(spark, scorer):
    return SEL._best_range(spark, SEL.sweep(scorer, KS_SEARCH, parallelism=4))


def q_binsearch_bic(spark, root):
    scorer = _ua_fixed_scorer(spark, root)
    try:
        lo, hi = _sweep_range(spark, scorer)
        k, b = SEL.binsearch_bic(scorer, lo, hi)
    finally:
        scorer.release()
    return rounded(spark.createDataFrame([(k, b)], "k int, bic double"))


def q_linear_bic(spark, root):
    scorer = _ua_fixed_scorer(spark, root)
    try:
        lo, hi = _sweep_range(spark, scorer)
        k, b = SEL.linear_bic(scorer, lo[0], hi[0])
    finally:
        scorer.release()
    return rounded(spark.createDataFrame([(k, b)], "k int, bic double"))


def q_binsearch_diameter(spark, root):
    scorer = _ua_fixed_scorer(spark, root)
    try:
        scored = SEL.sweep(scorer, KS_SEARCH, parallelism=4)
        lo, hi = scored[0], scored[-1]
        k, d = SEL.binsearch_diameter(scorer, (lo.k, lo.avg_diameter), (hi.k, hi.avg_diameter))
    finally:
        scorer.release()
    return rounded(spark.createDataFrame([(k, d)], "k int, avg_diameter double"))


def q_select_k(spark, root):
    """The chosen model: widest BIC gap of the sweep, bisected with real fits."""
    return _model_rows(spark, [SEL.select_k(materialize(_towns(spark, root).select("features")), ks=list(KS_TOWNS), max_iter=TRAIN_ITER)])


def q_run_kmeans(spark, root):
    """O42b, all three branches: one k, a list of candidates, all powers of two up to a bound."""
    pts = materialize(_towns(spark, root).select("features"))
    asked = {"one": (2, {}), "list": (list(KS_TOWNS), {}), "all": (None, {"limit": 1, "min_k": 2, "max_k": 4})}
    found = None
    for kind, (k, bounds) in asked.items():
        row = _model_rows(spark, [SEL.run_kmeans(pts, k, TRAIN_ITER, **bounds)]).withColumn("kind", F.lit(kind))
        found = row if found is None else found.union(row)
    return found


QUERIES: dict[str, Query] = {
    # sources
    "read_points": q_read_points,
    "read_points_counted": q_read_points_counted,
    "read_lookup": q_read_lookup,
    "read_category": q_read_category,
    "read_user_activity": q_read_user_activity,
    # features
    "group_by_user": q_group_by_user,
    "filter_to_category": q_filter_to_category,
    "scale_actions": q_scale_actions,
    "assemble_vectors": q_assemble_vectors,
    # training
    "train_kmeans": q_train_kmeans,
    "train_kmeans_default": q_train_kmeans_default,
    "compute_next_model": q_compute_next_model,
    "next_model_diameter": q_next_model_diameter,
    "cluster_centers": q_cluster_centers,
    # assignment
    "assign": q_assign,
    "distance_to_center": q_distance_to_center,
    "attach_users": q_attach_users,
    # profile
    "cluster_counts": q_cluster_counts,
    "cluster_diameters": q_cluster_diameters,
    "cluster_max_distance": q_cluster_max_distance,
    "cluster_distance_sum": q_cluster_distance_sum,
    "cluster_reduce": q_cluster_reduce,
    "cluster_reduce_function": q_cluster_reduce_function,
    "cluster_mins": q_cluster_mins,
    "cluster_maxes": q_cluster_maxes,
    "cluster_sums": q_cluster_sums,
    "cluster_averages": q_cluster_averages,
    "cluster_dim_users": q_cluster_dim_users,
    "attach_dimensions": q_attach_dimensions,
    "wssse": q_wssse,
    "cluster_profile": q_cluster_profile,
    "cluster_profile_wide": q_cluster_profile_wide,
    "drop_empty_clusters": q_drop_empty_clusters,
    # sinks and ids
    "membership_rows": q_membership_rows,
    "write_membership": q_write_membership,
    "write_profile": q_write_profile,
    "write_once": q_write_once,
    "consistent_hash": q_consistent_hash,
    "consistent_hash_utf16": q_consistent_hash_utf16,
    "run_cluster_id": q_run_cluster_id,
    # vector functions
    "square": q_square,
    "vector_diff": q_vector_diff,
    "vector_norm": q_vector_norm,
    "euclidean_distance": q_euclidean_distance,
    # scoring
    "avg_cluster_diameter": q_avg_cluster_diameter,
    "model_diameters": q_model_diameters,
    "model_errors": q_model_errors,
    "cluster_sq_distance": q_cluster_sq_distance,
    "model_variance": q_model_variance,
    "point_density": q_point_density,
    "ln_likelihood": q_ln_likelihood,
    "aic": q_aic,
    "bic": q_bic,
    "bics": q_bics,
    # curve
    "successive_pairs": q_successive_pairs,
    "slope": q_slope,
    "k_slopes": q_k_slopes,
    "filter_slopes": q_filter_slopes,
    "max_bic_gap": q_max_bic_gap,
    "best_k_range_bic": q_best_k_range_bic,
    "best_k_range_slope": q_best_k_range_slope,
    "best_k_diameter_drop": q_best_k_diameter_drop,
    "best_k_error_ratio": q_best_k_error_ratio,
    "elbow_point": q_elbow_point,
    "midpoint": q_midpoint,
    "scale_points": q_scale_points,
    "first_k": q_first_k,
    "diameter_observations": q_diameter_observations,
    "overall_mean": q_overall_mean,
    "between_group_ssd": q_between_group_ssd,
    "msb": q_msb,
    "center_data": q_center_data,
    # k selection
    "candidate_ks": q_candidate_ks,
    "sweep": q_sweep,
    "binsearch_bic": q_binsearch_bic,
    "linear_bic": q_linear_bic,
    "binsearch_diameter": q_binsearch_diameter,
    "select_k": q_select_k,
    "run_kmeans": q_run_kmeans,
}
