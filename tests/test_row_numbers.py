"""Row numbers hold at size, on sorted frames, on folders of uneven files; lost users fail."""

import os

import pytest
from pyspark.sql import functions as F

from segmint.operators.assign import attach_users
from segmint.operators.features import dimension_table
from segmint.sources import text


def test_sorted_frame_of_400k_rows(spark):
    df = spark.range(400_000).select(F.xxhash64("id").alias("k"), F.rpad(F.col("id").cast("string"), 40, "x").alias("pad"))
    got = text.index_rows(df.orderBy("k"), "n").cache()
    assert tuple(got.agg(F.count("*"), F.countDistinct("n"), F.min("n"), F.max("n")).first()) == (400_000, 400_000, 0, 399_999)
    from pyspark.sql.window import Window

    lagged = got.select("k", F.lag("k").over(Window.orderBy("n")).alias("before"))
    assert lagged.where("before > k").count() == 0
    got.unpersist()


def test_attach_users_pairs_300k_rows(spark):
    base = spark.range(300_000).select(F.col("id").alias("user_id"), F.xxhash64("id").alias("s")).orderBy("s")
    rows = text.index_rows(base.select("s"), "row_id").select("row_id", F.col("s").alias("cluster"))
    users = text.read_lookup(spark, base.select(F.col("user_id").cast("string")), "row_id", "user_id")
    got = attach_users(rows, users)
    assert got.count() == 300_000
    assert got.where(F.xxhash64(F.col("user_id").cast("bigint")) != F.col("cluster")).count() == 0


def test_a_prediction_without_a_user_fails(spark):
    users = spark.createDataFrame([(0, "a")], "row_id bigint, user_id string")
    rows = spark.createDataFrame([(0, 1), (1, 1)], "row_id bigint, cluster int")
    with pytest.raises(Exception, match="no user for row_id 1"):
        attach_users(rows, users).collect()


def test_folder_of_uneven_files_keeps_name_order(spark, workdir):
    sizes, at = (10, 1990, 100), 0
    for k, n in enumerate(sizes):
        with open(os.path.join(workdir, f"part-{k:05d}.txt"), "w") as f:
            f.write("".join(f"u{i}\n" for i in range(at, at + n)))
        at += n
    got = text.read_lookup(spark, workdir).orderBy("row_id").collect()
    assert [(r["row_id"], r["user_id"]) for r in got] == [(i, f"u{i}") for i in range(at)]


def test_many_pages_get_dimensions_of_their_own(spark):
    pages = spark.range(120_000).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("page"))
    dims = dimension_table(pages, "page")
    assert tuple(dims.agg(F.countDistinct("dim"), F.min("dim"), F.max("dim")).first()) == (120_000, 0, 119_999)


def test_empty_frames(spark):
    assert text.index_rows(spark.range(0), "n").count() == 0
