"""From activity lines to a segmentation input folder, and on to the job.

``prepare_folder`` reads user activity and one category, keeps the category's
pages, sums a user's actions of all kinds per page and writes the folder that
``run_kmeans_job`` reads: ``inputs.txt`` (points), ``users.txt`` (n-th line = n-th
point), ``pages.txt``, ``names.txt``, ``dimensions.txt`` (id and name). Users are
numbered in id order; every file is written in the order of those numbers, so lines
of different files match whatever their part files are.

``run_from_activity`` goes on with the k of ``k.txt`` if the folder has one, or with
the chosen k.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmint.operators.features import dimension_table, filter_to_category, scale_actions
from segmint.plans.choose_k_job import choose_k_job
from segmint.plans.kmeans_job import run_kmeans_job
from segmint.session import materialize
from segmint.sources import jsonl, text
from segmint.sources.sinks import path_done

KINDS = ("page_like", "page_comment", "post_like", "post_comment")


def activity_counts(activity: DataFrame, user_col: str = "user_id", kinds: Sequence[str] = KINDS) -> DataFrame:
    """(user_id, page_id, n): a user's actions on a page, summed over the kinds (maps of page → count)."""
    each = [activity.select(F.col(user_col).alias("user_id"), F.explode(kind).alias("page_id", "n")) for kind in kinds]
    return reduce(DataFrame.union, each).groupBy("user_id", "page_id").agg(F.sum("n").alias("n"))


def write_folder(counts: DataFrame, names: DataFrame | None, folder: str) -> dict:
    """Write the five files from (user_id, page_id, n); ``names`` maps page_id to name. Returns their sizes."""
    counts = materialize(counts)
    dims = materialize(dimension_table(counts, "page_id", names))
    users = text.index_rows(counts.select(F.col("user_id").cast("string").alias("user_id")).distinct().orderBy("user_id"))
    keyed = counts.select(F.col("user_id").cast("string").alias("user_id"), F.col("page_id").cast("string").alias("dimension_id"), F.col("n").cast("double").alias("v"))
    entries = (keyed.join(dims, "dimension_id").groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("dim", "v"))).alias("e")))
    line = F.concat_ws(" ", F.transform("e", lambda e: F.concat(e["dim"].cast("string"), F.lit(":"), e["v"].cast("string"))))
    points = materialize(users.join(entries, "user_id").select("row_id", "user_id", line.alias("line")))
    base = folder.rstrip("/")
    files = {"inputs": (points, "row_id", F.col("line")), "users": (points, "row_id", F.col("user_id")), "pages": (dims, "dim", F.col("dimension_id")),
             "names": (dims, "dim", F.col("dimension_name")), "dimensions": (dims, "dim", F.concat_ws("\t", "dimension_id", "dimension_name"))}
    for name, (rows, order, value) in files.items():
        rows.orderBy(order).select(value.alias("value")).write.mode("overwrite").text(f"{base}/{name}.txt")
    return {"points": points.count(), "pages": dims.count()}


def prepare_folder(spark: SparkSession, activity, category, folder: str, category_id: int | None = None, kinds: Sequence[str] = KINDS,
                   factor: float | None = None, columns: Sequence[str] = jsonl.ACTIVITY_COLUMNS) -> dict:
    """Activity lines and category JSON (paths or line frames) → the input folder.

    ``category_id`` picks one of several categories. ``factor`` scales the counts (1 keeps
    them, None: 1 / (1 + largest)). Zero counts and pages outside the category are left out.
    """
    pages = jsonl.read_category(spark, category)
    if category_id is not None:
        pages = pages.where(F.col("category_id") == category_id)
    counts = activity_counts(jsonl.read_user_activity(spark, activity, columns), columns[0], kinds)
    kept = materialize(filter_to_category(counts, pages, "page_id"))
    return write_folder(scale_actions(kept, factor), pages.select("page_id", "name"), folder)


def folder_k(spark: SparkSession, folder: str) -> int | None:
    """The number in the folder's optional ``k.txt``."""
    path = f"{folder.rstrip('/')}/k.txt"
    try:
        rows = spark.read.text(path).where(F.trim("value") != "").limit(2).collect()
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    if len(rows) != 1:
        raise ValueError(f"{path} must hold one number")
    return int(rows[0]["value"])


def run_from_activity(spark: SparkSession, activity, category, folder: str, output: str, k: int | None = None, params: str = "kmeans||,20,0.0001",
                      run_id: str | None = None, seed: int = 7, factor: float | None = None, category_id: int | None = None, **select) -> dict:
    """Entry C: activity → folder (unless it is complete) → k (given, ``k.txt``, or chosen) → membership and profiles."""
    if not all(path_done(spark, f"{folder.rstrip('/')}/{name}.txt") for name in ("inputs", "users", "pages", "names", "dimensions")):
        prepare_folder(spark, activity, category, folder, category_id, factor=factor)
    if k is None:
        k = folder_k(spark, folder)
    if k is None:
        k = choose_k_job(spark, folder, params, **select)
    return run_kmeans_job(spark, folder, output, k, params, run_id, seed)
