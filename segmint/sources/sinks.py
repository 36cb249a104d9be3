"""Result writers.

* membership rows ``(cluster_id, user_id)``: the scalable form, written as parquet.
* membership lines ``{"cluster_id": …, "part": …, "parts": …, "user_ids": […]}``: the JSON form.
  A cluster may hold a large share of all users, so its ids are split into
  chunks of about ``chunk_size`` users (bucket = first 32 bits of md5(user
  id) mod the chunk count); each chunk is its own line and its own task.
  With fewer users than ``chunk_size`` a cluster is one line.
* profile lines: one JSON object per cluster.
* ``write_once``: an existing, completed output makes the step a no-op.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmint.functions.keys import cluster_id as make_cluster_id

log = logging.getLogger(__name__)

CHUNK_USERS = 100_000


def membership_rows(assigned: DataFrame, run_id: str, user_col: str = "user_id") -> DataFrame:
    """(cluster_id, user_id) per member."""
    return assigned.select(make_cluster_id(run_id, "cluster").alias("cluster_id"), F.col(user_col).alias("user_id"))


def _md5_bucket(x, n) -> F.Column:
    return F.pmod(F.conv(F.substring(F.md5(x.cast("string")), 1, 8), 16, 10).cast("bigint"), n)


def membership_lines(rows: DataFrame, chunk_size: int = CHUNK_USERS) -> DataFrame:
    """JSON lines ``{cluster_id, part, parts, user_ids}``, ids sorted; a big cluster has several parts."""
    sizes = rows.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("_n"))
    n_chunks = F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("_n") / F.lit(float(chunk_size))).cast("bigint"))
    # One row per cluster id: k per model.
    tagged = rows.join(F.broadcast(sizes), "cluster_id").withColumn("parts", n_chunks).withColumn("part", _md5_bucket(F.col("user_id"), F.col("parts")))
    grouped = tagged.groupBy("cluster_id", "part", "parts").agg(F.sort_array(F.collect_list("user_id")).alias("user_ids"))
    return grouped.select(F.to_json(F.struct("cluster_id", "part", "parts", "user_ids")).alias("value"))


def _round_profile(profile: DataFrame, digits: int | None) -> DataFrame:
    if digits is None:
        return profile
    r = lambda c: F.round(c, digits)
    return profile.withColumn("cluster_diameter", r(F.col("cluster_diameter"))).withColumn(
        "cluster_wssse", r(F.col("cluster_wssse"))
    ).withColumn(
        "dimensions",
        F.transform(
            "dimensions",
            lambda d: F.struct(
                d["dimension_id"].alias("dimension_id"),
                d["dimension_name"].alias("dimension_name"),
                d["member_count"].alias("member_count"),
                r(d["center"]).alias("center"),
                r(d["min"]).alias("min"),
                r(d["max"]).alias("max"),
                r(d["avg"]).alias("avg"),
            ),
        ),
    )


PROFILE_SCHEMA = (
    "cluster_id string, cluster_member_count bigint, private boolean, cluster_diameter double, cluster_wssse double, "
    "dimensions array<struct<dimension_id:string,dimension_name:string,member_count:bigint,center:double,min:double,max:double,avg:double>>"
)
PROFILE_FIELDS = ("cluster_id", "cluster_member_count", "private", "cluster_diameter", "cluster_wssse", "dimensions")


def profile_lines(profile: DataFrame, digits: int | None = None) -> DataFrame:
    """One JSON object per cluster profile."""
    p = _round_profile(profile, digits)
    return p.select(F.to_json(F.struct(*PROFILE_FIELDS)).alias("value"))


def write_membership(rows: DataFrame, path: str, chunk_size: int = CHUNK_USERS, mode: str = "errorifexists") -> None:
    membership_lines(rows, chunk_size).write.mode(mode).text(path)


def write_membership_rows(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    rows.write.mode(mode).parquet(path)


def write_profile(profile: DataFrame, path: str, mode: str = "errorifexists") -> None:
    profile.select(*PROFILE_FIELDS).write.mode(mode).json(path)


def path_done(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a completed Spark output (its ``_SUCCESS`` marker).

    Resolving the marker is an analysis-time file listing; no job runs.
    """
    try:
        spark.read.text(path.rstrip("/") + "/_SUCCESS")
        return True
    except AnalysisException:
        return False


def write_once(spark: SparkSession, path: str, build: Callable[[], None]) -> bool:
    """Run ``build`` (which writes ``path``) unless a completed output is already there.

    Returns True when the step ran. A half-written folder (no ``_SUCCESS``)
    is rebuilt with overwrite semantics by the caller's writer.
    """
    if path_done(spark, path):
        log.info("output exists, skipping: %s", path)
        return False
    build()
    return True
