"""The sparse route gives the dense route's results."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmint.operators.assign import assign, first_rows_as_centers
from segmint.operators.features import assemble_vectors, customer_brand_counts, dimension_table
from segmint.operators.profile import cluster_profile, cluster_summary, profile_from_summary
from segmint.operators.sparse import (
    assemble_sparse,
    assign_sparse,
    cluster_summary_sparse,
    dense_to_sparse,
    sparse_scorer,
    sparse_to_dense,
    train_kmeans_sparse,
)

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def brands(spark):
    counts = customer_brand_counts(spark, SF_SMALL).cache()
    dims = dimension_table(counts, "p_brand").cache()
    dense = assemble_vectors(counts, dims, "o_custkey", "p_brand").cache()
    sparse = assemble_sparse(counts, dims, "o_custkey", "p_brand").cache()
    return counts, dims, dense, sparse


def test_assembly_round_trip(brands):
    _, dims, dense, sparse = brands
    q = dims.count()
    back = {r["o_custkey"]: r["features"] for r in sparse_to_dense(sparse, q).collect()}
    assert back == {r["o_custkey"]: r["features"] for r in dense.collect()}
    again = {r["o_custkey"]: (list(r["idx"]), list(r["val"])) for r in dense_to_sparse(dense).collect()}
    assert again == {r["o_custkey"]: (list(r["idx"]), list(r["val"])) for r in sparse.collect()}
    assert all(list(r["idx"]) == sorted(r["idx"]) and 0 not in r["val"] for r in sparse.collect())


def test_assign_and_summary_match_dense(brands):
    _, dims, dense, sparse = brands
    q = dims.count()
    cents = first_rows_as_centers(dense, 6, "o_custkey")
    a_d = assign(dense, cents).cache()
    a_s = assign_sparse(sparse, cents).cache()
    d = {r["o_custkey"]: (r["cluster"], r["d2"]) for r in a_d.collect()}
    s = {r["o_custkey"]: (r["cluster"], r["d2"]) for r in a_s.collect()}
    assert {u: c for u, (c, _) in d.items()} == {u: c for u, (c, _) in s.items()}
    assert all(s[u][1] == pytest.approx(d[u][1], abs=1e-9) for u in d)
    sd = {r["cluster"]: r for r in cluster_summary(a_d, q).collect()}
    ss = {r["cluster"]: r for r in cluster_summary_sparse(a_s, q).collect()}
    assert sd.keys() == ss.keys()
    for c in sd:
        for f in ("n", "mins", "maxs", "positives"):
            assert sd[c][f] == ss[c][f], f
        assert np.allclose(sd[c]["means"], ss[c]["means"], rtol=1e-12, atol=1e-12)
        assert sd[c]["sse"] == pytest.approx(ss[c]["sse"], rel=1e-9)
    pd_ = sorted(r.asDict(recursive=True)["dimensions"][0]["avg"] for r in cluster_profile(a_d, cents, dims, "r").collect())
    ps_ = sorted(
        r.asDict(recursive=True)["dimensions"][0]["avg"]
        for r in profile_from_summary(cluster_summary_sparse(a_s, q), cents, dims, "r").collect()
    )
    assert pd_ == pytest.approx(ps_)


def test_sparse_training_and_scoring(brands):
    _, dims, _, sparse = brands
    q = dims.count()
    model = train_kmeans_sparse(sparse, q, 3, seed=1)
    assert len(model.clusterCenters()) == 3
    s = sparse_scorer(sparse, q)(3)
    assert s.n == sparse.count() and s.bic is not None and s.wssse > 0
    sizes = assign_sparse(sparse, model.clusterCenters()).groupBy("cluster").count()
    assert sizes.agg(F.sum("count")).first()[0] == sparse.count()


def test_summary_is_linear_in_the_number_of_dimensions(spark):
    """50,000 dimensions: every position is filled, in time that map lookups per position would not allow."""
    import time

    from pyspark.sql import functions as F

    from segmint.operators.sparse import cluster_summary_sparse

    q = 50_000
    a = spark.range(3000).select(
        (F.col("id") % 3).cast("int").alias("cluster"), F.lit(1.0).alias("dist"), F.lit(1.0).alias("d2"),
        F.sort_array(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.pmod(F.xxhash64("id", i), F.lit(q)).cast("int")))).alias("idx"),
    ).withColumn("val", F.transform("idx", lambda i: i.cast("double") + 1))
    t = time.time()
    got = cluster_summary_sparse(a, q).select("n", F.size("mins").alias("w"), F.aggregate("sums", F.lit(0.0), lambda s, v: s + v).alias("s"),
                                              F.aggregate("positives", F.lit(0).cast("bigint"), lambda s, v: s + v).alias("p")).collect()
    took = time.time() - t
    assert [(r["n"], r["w"]) for r in got] == [(1000, q)] * 3
    want = a.select("cluster", F.explode("val").alias("v")).groupBy("cluster").agg(F.sum("v"), F.count("*")).orderBy("cluster").collect()
    assert sorted((r["s"], r["p"]) for r in got) == sorted((r[1], r[2]) for r in want)
    assert took < 60
