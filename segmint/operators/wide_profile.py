"""Cluster profiles of very wide vectors (O23, O23a) as long tables.

``profile.cluster_profile`` keeps a cluster's statistics in arrays of Q values and joins them with
k x Q centres by broadcast, which is right for some thousand dimensions. Here nothing holds Q
values: centres and statistics are (cluster, dim) rows, aggregated and joined by shuffles on
both keys, so a cluster's or a page's cells are spread like any others. Only the k rows of
(members, diameter, cost) are small enough to be broadcast, and their number is checked.
A nested profile is cut into parts of at most ``PART_DIMS`` dimensions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmint.functions.keys import cluster_id as make_cluster_id
from segmint.session import materialize

PART_DIMS = 10_000
#: clusters whose (cluster, n, max_dist, sse) rows are broadcast; 32 bytes each
MOST_CLUSTERS = 1_000_000
CHUNK = 4096


def center_cells(spark: SparkSession, centers: np.ndarray) -> DataFrame:
    """(cluster, dim, center) of a model's centres; the driver's matrix leaves it in chunks of a row."""
    rows = [(j, lo, c[lo : lo + CHUNK].tolist()) for j, c in enumerate(np.asarray(centers, dtype=np.float64)) for lo in range(0, len(c), CHUNK)]
    chunks = spark.createDataFrame(rows, "cluster int, first int, part array<double>")
    return chunks.select("cluster", "first", F.posexplode("part").alias("at", "center")).select("cluster", (F.col("first") + F.col("at")).alias("dim"), "center")


def long_stats(assigned: DataFrame) -> DataFrame:
    """(cluster, dim, n, max_dist, sse, low, high, total, positive), stored: the non-zero entries of sparse rows
    by cluster and dimension, and under dim -1 the rows themselves. One pass over the rows, one shuffle."""
    marker = F.array(F.struct(F.lit(-1).alias("dim"), F.lit(0.0).alias("x")))
    entries = F.concat(marker, F.arrays_zip(F.col("idx").alias("dim"), F.col("val").alias("x")))
    cells = assigned.select("cluster", "dist", "d2", F.explode(entries).alias("e")).select("cluster", "e.dim", "e.x", "dist", "d2")
    row = F.col("dim") < 0
    return materialize(cells.groupBy("cluster", "dim").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.when(row, F.col("dist"))).alias("max_dist"), F.sum(F.when(row, F.col("d2"))).alias("sse"),
        F.min("x").alias("low"), F.max("x").alias("high"), F.sum("x").alias("total"), F.count_if(F.col("x") > 0).alias("positive")))


def cluster_rows(stats: DataFrame) -> DataFrame:
    """(cluster, n, max_dist, sse): one row of each cluster with members."""
    return stats.where("dim < 0").select("cluster", "n", "max_dist", "sse")


def profile_cells(stats: DataFrame, centers: DataFrame, dims: DataFrame) -> DataFrame:
    """O17–O21, O23a in long form: (cluster, dim, dimension_id, dimension_name, member_count, center, min, max, avg).

    ``stats`` comes from ``long_stats``, ``centers`` (cluster, dim, center) are the cells of the profile. A member
    without an entry has 0 there; clusters without members and dimensions without a label have no rows.
    """
    sizes = cluster_rows(stats).select("cluster", F.col("n").alias("members"))
    if sizes.limit(MOST_CLUSTERS + 1).count() <= MOST_CLUSTERS:
        sizes = F.broadcast(sizes)
    entries = stats.where("dim >= 0").select("cluster", "dim", F.col("n").alias("entries"), "low", "high", "total", "positive")
    cells = centers.join(entries, ["cluster", "dim"], "left").join(sizes, "cluster")
    labelled = cells.join(dims.select(F.col("dim").cast("int").alias("dim"), "dimension_id", "dimension_name"), "dim")
    all_here = F.coalesce("entries", F.lit(0).cast("long")) == F.col("members")
    zero = F.lit(0.0)
    return labelled.select(
        "cluster", "dim", "dimension_id", "dimension_name", F.coalesce("positive", F.lit(0).cast("long")).alias("member_count"), "center",
        F.when(all_here, F.col("low")).otherwise(F.least(F.coalesce("low", zero), zero)).alias("min"),
        F.when(all_here, F.col("high")).otherwise(F.greatest(F.coalesce("high", zero), zero)).alias("max"),
        (F.coalesce("total", zero) / F.col("members")).alias("avg"))


def wide_profile(assigned: DataFrame, centers, dims: DataFrame, run_id: str, part_dims: int = PART_DIMS) -> DataFrame:
    """O23 of clusters with members: the columns of ``profile.cluster_profile`` and ``part`` (from 0).

    A cluster with more than ``part_dims`` dimensions has several rows, whose ``dimensions`` follow one another;
    a task nests at most that many cells at a time. ``centers`` is a matrix or (cluster, dim, center).
    """
    spark = assigned.sparkSession
    cells = centers if isinstance(centers, DataFrame) else center_cells(spark, centers)
    stats = long_stats(assigned)
    clusters = cluster_rows(stats)
    total = clusters.agg(F.sum("sse")).first()[0]
    long = profile_cells(stats, cells, dims)
    entry = F.struct("dim", "dimension_id", "dimension_name", "member_count", "center", "min", "max", "avg")
    parts = long.groupBy("cluster", F.floor(F.col("dim") / part_dims).cast("int").alias("part")).agg(F.sort_array(F.collect_list(entry)).alias("cells"))
    names = ("dimension_id", "dimension_name", "member_count", "center", "min", "max", "avg")
    # a cluster none of whose dimensions has a label keeps its row, without dimensions
    joined = clusters.join(parts, "cluster", "left")
    return joined.select(
        "cluster", make_cluster_id(run_id, "cluster").alias("cluster_id"), F.col("n").alias("cluster_member_count"), F.lit(False).alias("private"),
        (F.col("max_dist") * 2.0).alias("cluster_diameter"), F.lit(total).cast("double").alias("cluster_wssse"),
        F.coalesce(F.transform("cells", lambda c: F.struct(*[c[x].alias(x) for x in names])), F.array()).alias("dimensions"), F.coalesce("part", F.lit(0)).alias("part"))
