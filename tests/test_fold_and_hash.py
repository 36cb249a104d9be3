"""O22 with a user's function and O51 with the reference's own hash."""

from functools import reduce

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmint.functions.keys import consistent_hash, murmur3_utf16
from segmint.operators import fold
from segmint.operators.fold import cluster_fold, fold_rows


def test_one_cluster_holding_all_rows(spark):
    """All rows in one cluster over 40 partitions: no task of the tree reads more than fan_in vectors."""
    rows = spark.range(0, 20_000, 1, 40).select(F.lit(0).alias("cluster"), F.array(F.col("id").cast("double"), -F.col("id").cast("double")).alias("features"))
    got = cluster_fold(rows, lambda x, y: x + y, fan_in=4).collect()
    assert [(r.cluster, r.features) for r in got] == [(0, [199990000.0, -199990000.0])]


def test_any_function_of_two_vectors(spark):
    """A function of whole vectors (the longer one stays) has no element-wise form."""
    rng = np.random.default_rng(3)
    data = [(int(k % 3), [float(x) for x in rng.normal(size=4)]) for k in range(500)] + [(5, None), (7, [1.0, 2.0, 3.0, 4.0]), (7, None)]
    frame = spark.createDataFrame(data, "cluster int, features array<double>").repartition(9)
    longer = lambda x, y: x if np.dot(x, x) >= np.dot(y, y) else y
    got = {r.cluster: r.features for r in cluster_fold(frame, longer, fan_in=2).collect()}
    want = {c: list(reduce(longer, [np.array(v) for k, v in data if k == c and v])) for c in (0, 1, 2, 7)}
    assert got == want


def test_width_may_change_and_runs_stay_apart(spark):
    frame = spark.createDataFrame([("a", 0, [1.0]), ("a", 0, [2.0]), ("b", 0, [3.0]), ("b", 1, []), (None, 0, [4.0])], "run string, cluster int, v array<double>").repartition(4)
    got = {(r.run, r.cluster): sorted(r.v) for r in cluster_fold(frame, lambda x, y: np.concatenate([x, y]), "v", by=["run"]).collect()}
    assert got == {("a", 0): [1.0, 2.0], ("b", 0): [3.0], ("b", 1): [], (None, 0): [4.0]}


def test_held_vectors_are_passed_on(spark, monkeypatch):
    """More clusters than a task may hold: partial results leave early, the sums are the same."""
    monkeypatch.setattr(fold, "HELD_BYTES", 1000)
    frame = spark.range(0, 6000, 1, 6).select((F.col("id") % 700).cast("int").alias("cluster"), F.array(F.lit(1.0)).alias("features"))
    got = {r.cluster: r.features[0] for r in cluster_fold(frame, np.add, elementwise=True, fan_in=3).collect()}
    assert got == {c: float(sum(1 for i in range(c, 6000, 700))) for c in range(700)}


def test_no_rows_no_clusters(spark):
    assert cluster_fold(spark.createDataFrame([], "cluster int, features array<double>"), np.add).collect() == []


def test_halves_and_steps_agree():
    m = [np.array([float(k), -k]) for k in range(11)]
    for n in range(1, 12):
        assert np.array_equal(fold_rows(m[:n], np.add, True), fold_rows(m[:n], np.add, False))


def plain_murmur(text: str) -> int:
    data = text.encode("utf-16-le")
    h, full = 0, len(data) // 4 * 4
    rot = lambda v, r: (v << r | v >> (32 - r)) & 0xFFFFFFFF
    mix = lambda k: rot(k * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
    for i in range(0, full, 4):
        h = (rot(h ^ mix(int.from_bytes(data[i : i + 4], "little")), 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
    if full < len(data):
        h ^= mix(int.from_bytes(data[full:], "little"))
    h ^= len(data)
    for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ h >> shift) * by & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


# published vectors of MurmurHash3 x86 32-bit, seed 0, whose bytes are UTF-16 units: bytes → hash
PUBLISHED = {b"": 0, b"test": 0xBA6BD213, b"\xff\xff\xff\xff": 0x76293B50, b"!Ce\x87": 0xF55B516B, b"!C": 0xA0F7B07A, b"\0\0\0\0": 0x2362F9DE, b"\0\0": 0x30F4C306}


def test_published_vectors(spark):
    texts = {b.decode("utf-16-le"): h for b, h in PUBLISHED.items()}
    frame = spark.createDataFrame([(t,) for t in texts], "x string")
    got = {r.x: r.h & 0xFFFFFFFF for r in frame.select("x", murmur3_utf16("x").alias("h")).collect()}
    assert got == texts and all(plain_murmur(t) & 0xFFFFFFFF == h for t, h in texts.items())


def test_utf16_buckets_of_awkward_keys(spark):
    keys = ["", "a", "ab", "abc", "Ünïcödé", "日本語", "😀", "a😀b", "😀😀😀", " ", "x" * 1001, "￿", "10", None]
    frame = spark.createDataFrame([(k,) for k in keys], "x string")
    for slots in (1, 7, 16, 1 << 20):
        got = {r.x: r.b for r in frame.select("x", consistent_hash("x", slots, "utf16").alias("b")).collect()}
        assert got == {k: None if k is None else plain_murmur(k) % slots for k in keys}
    with pytest.raises(ValueError):
        consistent_hash("x", 0, "utf16")


def test_a_key_is_encoded_once_and_not_for_each_of_its_blocks(spark):
    from pyspark.sql import functions as F

    # the lambda of the blocks reads what is encoded outside it: once written, and outside all lambdas but its own
    assert str(murmur3_utf16(F.upper("x"))).count("upper(") == 1
    keys = ["Customer#000000001", "é" * 5, "a😀", "", None]
    frame = spark.createDataFrame([(k,) for k in keys], "x string")
    for seed in (0, 42):
        got = {r.x: r.h for r in frame.select("x", murmur3_utf16("x", seed).alias("h")).collect()}
        assert got[None] is None and len(set(got.values())) == 5
        assert seed or all(got[k] == plain_murmur(k) for k in keys if k is not None)
