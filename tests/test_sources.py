"""Readers and writers: text points, lookups, category and activity JSON, membership chunks."""

import json
import os

from pyspark.sql import functions as F

from segmint.sources import jsonl, sinks, text


def test_points_round_trip(spark, workdir):
    path = os.path.join(workdir, "inputs.txt")
    with open(path, "w") as f:
        f.write("0:1.5 3:2.0\n1:4.0\n\n2:0.25 0:7.0\n")
    got = {r["row_id"]: dict(r["features"]) for r in text.read_points(spark, path).collect()}
    assert got == {0: {0: 1.5, 3: 2.0}, 1: {1: 4.0}, 2: {}, 3: {2: 0.25, 0: 7.0}}
    dense = text.read_points(spark, path).select("row_id", text.dense_from_map("features", 4).alias("v"))
    assert {r["row_id"]: r["v"] for r in dense.collect()}[0] == [1.5, 0.0, 0.0, 2.0]


def test_lookup_keeps_line_order_across_partitions(spark, workdir):
    path = os.path.join(workdir, "users.txt")
    names = [f"user-{i:05d}" for i in range(5000)]
    with open(path, "w") as f:
        f.write("\n".join(names) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")  # several splits of one file
    try:
        lookup = text.read_lookup(spark, path)
        assert lookup.rdd.getNumPartitions() > 1
        got = lookup.orderBy("row_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["user_id"] for r in got] == names
    assert [r["row_id"] for r in got] == list(range(5000))


def test_category_file(spark, workdir):
    path = os.path.join(workdir, "category.txt")
    with open(path, "w") as f:
        json.dump({"id": 0, "facebook": [{"id": "page1", "name": "foo"}, {"id": "page2", "name": "bar"}]}, f)
    got = sorted(tuple(r) for r in jsonl.read_category(spark, path).collect())
    assert got == [(0, "page1", "foo"), (0, "page2", "bar")]


def test_activity_arrays(spark, workdir):
    path = os.path.join(workdir, "00000")
    rows = [["a", "1", {"page1": 0}, {}, {}, {}], ["d", "1", {"page1": 9, "page2": 9}, {}, {"x": 2}, {}]]
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))
    df = jsonl.read_user_activity(spark, path)
    got = {r["user_id"]: (r["gender"], dict(r["page_like"]), dict(r["post_like"])) for r in df.collect()}
    assert got == {"a": ("1", {"page1": 0}, {}), "d": ("1", {"page1": 9, "page2": 9}, {"x": 2})}


def test_membership_lines_split_big_clusters(spark):
    rows = spark.createDataFrame([("c-0", f"u{i}") for i in range(250)] + [("c-1", "z")], "cluster_id string, user_id string")
    lines = [json.loads(r["value"]) for r in sinks.membership_lines(rows, chunk_size=100).collect()]
    by_cluster = {}
    for ln in lines:
        assert ln["user_ids"] == sorted(ln["user_ids"])
        assert len(ln["user_ids"]) < 200
        by_cluster.setdefault(ln["cluster_id"], []).extend(ln["user_ids"])
    assert sorted(by_cluster["c-0"]) == sorted(f"u{i}" for i in range(250))  # nothing lost
    assert by_cluster["c-1"] == ["z"]
    assert sum(1 for ln in lines if ln["cluster_id"] == "c-0") == 3


def test_index_rows_is_dense(spark):
    df = spark.range(0, 1000, 1, numPartitions=7).withColumn("v", F.col("id") * 2)
    got = text.index_rows(df, "row_id").collect()
    assert sorted(r["row_id"] for r in got) == list(range(1000))
    assert all(r["row_id"] == r["id"] for r in got)


def test_consistent_hash_methods(spark):
    import hashlib

    from segmint.functions.keys import cluster_id, consistent_hash

    df = spark.createDataFrame([(f"user-{i}",) for i in range(200)], "u string")
    got = df.select("u", consistent_hash("u", 7).alias("md5"), consistent_hash("u", 7, "murmur").alias("mm")).collect()
    for r in got:
        assert r["md5"] == int(hashlib.md5(r["u"].encode()).hexdigest()[:8], 16) % 7
        assert 0 <= r["mm"] < 7
    assert len({r["mm"] for r in got}) == 7  # spreads over every slot
    again = {r["u"]: r["mm"] for r in df.select("u", consistent_hash("u", 7, "murmur").alias("mm")).collect()}
    assert again == {r["u"]: r["mm"] for r in got}
    assert df.select(cluster_id("run", F.lit(3)).alias("c")).first()["c"] == "run-3"
