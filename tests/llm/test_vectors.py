"""Vector joins and search: exact links, high recall, awkward vectors take no part."""

import numpy as np
import pytest

import brute
from segmint.llm import hnsw
from segmint.llm.hnsw import nearest, shard_plan
from segmint.llm.metric_join import near_duplicates

SCHEMA = "vec_id bigint, embedding array<float>, label int, h long, vec string, cell int, id long"


def table(seed=4):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((12, 16))
    rows = []
    for i in range(700):
        v = centers[rng.integers(12)] + rng.standard_normal(16) * rng.choice([0.01, 0.05, 0.3])
        rows.append((i, v.astype(np.float32).tolist(), int(rng.integers(3)) if rng.random() < 0.95 else None))
    same = rows[5][1]
    rows += [(700 + i, same, rows[5][2]) for i in range(60)]
    rows += [(760, None, 1), (761, [], 1), (762, [0.0] * 16, 1), (763, [float("nan")] + [1.0] * 15, 1), (764, [float("inf")] + [1.0] * 15, 1), (765, [None] + [1.0] * 15, 1),
             (766, [1.0, 2.0], 1), (767, [2.0, 4.0], 1), (None, same, 1), (800, same, None), (850, [1e-30] * 16, 2), (900, [1e30] * 16, 2), (50, rows[50][1], rows[50][2])]
    return rows


def good(v):
    return v is not None and len(v) and None not in v and all(np.isfinite(v)) and any(v)


def cosine(a, b):
    a, b = np.asarray(a, float), np.asarray(b, float)
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float((a * b).sum() / np.sqrt((a * a).sum()) / np.sqrt((b * b).sum()))


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in table()], SCHEMA).repartition(4)


@pytest.mark.parametrize("cell,part", [(2000, 4096), (40, 16)])
def test_near_duplicates(vectors, cell, part):
    rows = table()
    links, pairs = [0] * len(rows), []
    for i, (a, v, x) in enumerate(rows):
        for j, (b, w, y) in enumerate(rows):
            if i != j and a is not None and b is not None and x is not None and x == y and good(v) and good(w) and len(v) == len(w) and cosine(v, w) >= 0.98:
                links[i] += 1
                pairs.append((a, b))
    group = brute.groups(pairs, {r[0] for r in rows if r[0] is not None})
    want = sorted(((r[0], n, group.get(r[0]), r[0] is not None and group[r[0]] == r[0]) for r, n in zip(rows, links)), key=str)
    got = near_duplicates(vectors, cell=cell, part=part).collect()
    assert sorted((tuple(r) for r in got), key=str) == want


def test_tight_group_is_joined_in_bounded_tiles(spark, monkeypatch):
    """Thousands of distinct near-copies lie in one cell: no task gets more than two parts of it, and links and components are exact."""
    from segmint.llm import metric_join

    rng = np.random.default_rng(8)
    x = (rng.standard_normal(16) + 0.14 * rng.standard_normal((3000, 16))).astype(np.float32)
    real, most = metric_join.join_tile, 2 * 256 * 1.3

    def bounded(pdf, least):
        assert len(pdf) <= most, f"{len(pdf)} rows in one task"
        return real(pdf, least)

    monkeypatch.setattr(metric_join, "join_tile", bounded)
    docs = spark.createDataFrame([(i, v.tolist(), 1, 1, "x", 2, 3) for i, v in enumerate(x)], SCHEMA).repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(docs, cell=100, part=256).collect()}
    u = x.astype(float) / np.sqrt((x.astype(float) ** 2).sum(axis=1, keepdims=True))
    near = u @ u.T >= 0.98
    low = np.arange(len(x))
    while True:
        new = np.where(near, low, len(x)).min(axis=1)
        if (new == low).all():
            break
        low = new
    assert 0.1 < near.mean() < 0.9
    assert got == {i: (int(n) - 1, int(c)) for i, (n, c) in enumerate(zip(near.sum(axis=1), low))}


def test_nearest(vectors):
    rows = {r[0]: r[1] for r in table() if r[0] is not None and good(r[1])}
    hit = total = 0
    got: dict = {}
    for r in nearest(vectors, shard=150).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    queries = [q for q in rows if q % 50 == 0]
    assert set(got) == set(queries)
    for q in queries:
        found = sorted(got[q])
        assert [f[0] for f in found] == list(range(1, len(found) + 1))
        near = sorted((-cosine(rows[q], v), i) for i, v in rows.items() if i != q and len(v) == len(rows[q]))[:5]
        assert all(abs(s - cosine(rows[q], rows[i])) < 1e-12 for _, i, s in found) and len(found) == len(near)
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        hit += sum(s >= -near[-1][0] - 1e-12 for _, _, s in found)
        total += len(near)
    assert hit / total >= 0.9


def test_shards_grow_with_the_table_up_to_their_bytes(spark):
    """The square root of the table decides, between the least shard and its most bytes."""
    from pyspark.sql import functions as F

    lengths = spark.range(60).select(F.lit(4).alias("dim")).union(spark.range(90_000).select(F.lit(8).alias("dim"))).union(
        spark.range(900).select(F.lit(hnsw.SHARD_BYTES // 80).alias("dim")))
    got = {r.dim: (r.shards, r.size) for r in shard_plan(lengths, 100).collect()}
    assert got == {4: (1, 100), 8: (30, 3000), hnsw.SHARD_BYTES // 80: (90, 10)}


def test_every_shard_and_block_is_asked(spark, monkeypatch):
    """Many shards and many blocks of queries: recall and ranks as from one graph."""
    monkeypatch.setattr(hnsw, "GROWTH", 1)
    monkeypatch.setattr(hnsw, "QUERY_BLOCK", 16)
    rng = np.random.default_rng(11)
    x = rng.standard_normal((2500, 8)).astype(np.float32)
    docs = spark.createDataFrame([(i, v.tolist(), 1, 1, "x", 2, 3) for i, v in enumerate(x)], SCHEMA).repartition(5)
    got: dict = {}
    for r in nearest(docs, every=10, shard=40).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    u = x.astype(float) / np.sqrt((x.astype(float) ** 2).sum(axis=1, keepdims=True))
    sims = u @ u.T
    np.fill_diagonal(sims, -2)
    assert set(got) == set(range(0, 2500, 10)) and all([r for r, _ in sorted(f)] == [1, 2, 3, 4, 5] for f in got.values())
    assert np.mean([len({i for _, i in f} & set(np.argsort(-sims[q])[:5].tolist())) / 5 for q, f in got.items()]) >= 0.97


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert near_duplicates(none).count() == nearest(none).count() == 0
