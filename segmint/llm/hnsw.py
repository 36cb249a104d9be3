"""Approximate nearest neighbours: one small-world graph per shard, results merged.

Distinct vectors are dealt to shards by their key; every shard is a task of its own and builds
a hierarchical navigable small-world graph, kept as flat neighbour arrays in one row of a
stored table. Shards grow with the square root of the table, from ``SHARD`` vectors up to
``SHARD_BYTES``, so that ``n`` vectors make about ``sqrt(n) / GROWTH`` of them. Queries, in blocks
as large as a shard, meet every shard's graph: what travels of graphs and of queries is then
about the same, and both grow like ``n ** 1.5``. The best of all shards are merged. A class of equal vectors stands for its ``k + 1`` smallest ids, which is all
that k neighbours of any query can need of it.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from segmint.llm.common import prepare, store
from segmint.llm.vectors import cosines, unit, usable

SHARD = 2500  # least vectors of a shard where there are more than one
GROWTH = 10  # a shard's vectors as a multiple of the square root of all
SHARD_BYTES = 256 << 20  # most of a shard's vectors
LINKS = 12
EF_BUILD = 48
EF_SEARCH = 64
QUERY_BLOCK = 4096  # least queries of a block where there are more than one


class Graph:
    """Layers of neighbour arrays: ``near[l]`` is (nodes of layer l) x links, -1 where empty;
    ``nodes[l]`` lists the layer's nodes, layer 0 being all of them."""

    def __init__(self, vec: np.ndarray, nodes: list[np.ndarray], near: list[np.ndarray], entry: int):
        self.vec, self.nodes, self.near, self.entry = vec, nodes, near, entry
        self.slot = []
        for ids in nodes:
            slot = np.full(len(vec), -1, dtype=np.int64)
            slot[ids] = np.arange(len(ids))
            self.slot.append(slot)

    @classmethod
    def build(cls, vec: np.ndarray, seed: int, links: int = LINKS, ef: int = EF_BUILD) -> Graph:
        n = len(vec)
        top = np.minimum(-np.log(1.0 - np.random.default_rng(seed).random(n)) / math.log(links), 12).astype(int)
        nodes = [np.flatnonzero(top >= layer) for layer in range(int(top.max(initial=0)) + 1)]
        near = [np.full((len(ids), links * 2 if layer == 0 else links), -1, dtype=np.int32) for layer, ids in enumerate(nodes)]
        self = cls(vec, nodes, near, 0)
        for v in range(1, n):
            self._insert(v, top, links, ef)
            if top[v] > top[self.entry]:
                self.entry = v
        return self

    def _insert(self, v: int, top, links: int, ef: int) -> None:
        q, at = self.vec[v], [self.entry]
        for layer in range(int(top[self.entry]), -1, -1):
            if layer > top[v]:
                at = [self._search(q, at, 1, layer)[0][1]]
                continue
            found = self._search(q, at, ef, layer)
            chosen = self._choose([u for _, u in found], np.array([s for s, _ in found]), links)
            self.near[layer][self.slot[layer][v], : len(chosen)] = chosen
            for u in chosen:
                self._link(u, v, layer)
            at = [u for _, u in found]

    def _choose(self, ids: list[int], sims: np.ndarray, most: int) -> list[int]:
        """Of candidates, nearest first, those nearer to the node than to any one chosen before; then the nearest rest."""
        x = self.vec[ids]
        among = x @ x.T
        chosen: list[int] = []
        rest: list[int] = []
        for k in range(len(ids)):
            if len(chosen) == most:
                break
            (rest if chosen and among[k, chosen].max() > sims[k] else chosen).append(k)
        return [ids[k] for k in (chosen + rest)[:most]]

    def _link(self, u: int, v: int, layer: int) -> None:
        row = self.near[layer][self.slot[layer][u]]
        free = np.flatnonzero(row < 0)
        if len(free):
            row[free[0]] = v
            return
        ids = np.append(row, v)
        sims = self.vec[ids] @ self.vec[u]
        order = np.argsort(-sims, kind="stable")
        chosen = self._choose(ids[order].tolist(), sims[order], len(row))
        row[:] = -1
        row[: len(chosen)] = chosen

    def _search(self, q: np.ndarray, start: list[int], ef: int, layer: int) -> list[tuple[float, int]]:
        """The ef nearest found, nearest first, as (similarity, node)."""
        near, slot, vec = self.near[layer], self.slot[layer], self.vec
        seen = np.zeros(len(vec), dtype=bool)
        seen[start] = True
        sims = (vec[start] @ q).tolist()
        best = list(zip(sims, start, strict=True))
        heapq.heapify(best)
        todo = [(-s, u) for s, u in best]
        heapq.heapify(todo)
        while len(best) > ef:
            heapq.heappop(best)
        while todo:
            s, u = heapq.heappop(todo)
            if len(best) >= ef and -s < best[0][0]:
                break
            ids = near[slot[u]]
            ids = ids[ids >= 0]
            ids = ids[~seen[ids]]
            if not len(ids):
                continue
            seen[ids] = True
            for s2, w in zip((vec[ids] @ q).tolist(), ids.tolist(), strict=True):
                if len(best) < ef:
                    heapq.heappush(best, (s2, w))
                elif s2 > best[0][0]:
                    heapq.heapreplace(best, (s2, w))
                else:
                    continue
                heapq.heappush(todo, (-s2, w))
        return sorted(best, reverse=True)

    def search(self, q: np.ndarray, ef: int = EF_SEARCH) -> list[int]:
        at = [self.entry]
        for layer in range(len(self.nodes) - 1, 0, -1):
            if self.slot[layer][at[0]] >= 0:
                at = [self._search(q, at, 1, layer)[0][1]]
        return [u for _, u in self._search(q, at, ef, 0)]


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("h").reset_index(drop=True)
    x = np.array(pdf["vec"].tolist(), dtype=np.float64)
    g = Graph.build(unit(x), int(pdf["shard"][0]))
    return pd.DataFrame({
        "dim": pdf["dim"][:1], "shard": pdf["shard"][:1], "vec": [x.ravel()], "ids": [[list(map(int, i)) for i in pdf["ids"]]],
        "layers": [[len(n) for n in g.nodes]], "nodes": [np.concatenate(g.nodes).astype(np.int32)],
        "near": [np.concatenate([n.ravel() for n in g.near])], "entry": [g.entry]})


def _load(row) -> tuple[Graph, np.ndarray]:
    x = np.array(row["vec"], dtype=np.float64).reshape(-1, int(row["dim"]))
    nodes, near, a, b = [], [], 0, 0
    for layer, n in enumerate(row["layers"]):
        wide = LINKS * 2 if layer == 0 else LINKS
        nodes.append(np.array(row["nodes"][a : a + n]))
        near.append(np.array(row["near"][b : b + n * wide]).reshape(n, wide))
        a, b = a + n, b + n * wide
    return Graph(unit(x), nodes, near, int(row["entry"])), x


def _ask(k: int):
    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(index) and len(queries):
            g, x = _load(index.iloc[0])
            ids = index["ids"].iloc[0]
            asked = np.array(queries["vec"].tolist(), dtype=np.float64)
            for h, raw, q in zip(queries["h"], asked, unit(asked), strict=True):
                found = g.search(q)[: 2 * k + 2]
                score = cosines(np.repeat(raw[None, :], len(found), 0), x[found])
                rows = sorted((-s, int(i)) for s, u in zip(score.tolist(), found, strict=True) for i in ids[u])[: k + 1]
                out += [(h, i, -s) for s, i in rows]
        return pd.DataFrame(out, columns=["h", "id", "score"])

    return run


def shard_plan(distinct: DataFrame, shard: int = SHARD) -> DataFrame:
    """dim, shards and size, the vectors of a shard, of each vector length."""
    n = F.count("*").alias("n")
    size = F.greatest(F.lit(1), F.least(F.greatest(F.lit(shard), F.ceil(F.sqrt("n") * GROWTH)), F.floor(F.lit(SHARD_BYTES) / (F.col("dim") * 8)))).cast("int")
    return distinct.groupBy("dim").agg(n).withColumn("size", size).select("dim", F.ceil(F.col("n") / F.col("size")).cast("int").alias("shards"), "size")


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vec_col: str = "embedding", shard: int = SHARD) -> DataFrame:
    """The ``k`` nearest found of each query (ids divisible by ``every``): query_id, rank, vec_id, score.

    All rows are indexed; a query's own id is never its neighbour. Nearness is the cosine of
    the original vectors in double precision, ties go to the smaller id. Vectors that are
    null, empty, zero or hold null or non-finite numbers, and rows without an id, take no
    part; only vectors of one length are compared. Repeated rows count once. An empty
    table gives no rows; other columns are not read.
    """
    prepare(vectors.sparkSession)
    ok = store(usable(vectors, id_col, vec_col).dropDuplicates(["id", "h"]))
    first = Window.partitionBy("h").orderBy("id")
    ids = ok.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1).select("h", "dim", "id", "r", F.when(F.col("r") == 1, F.col("vec")).alias("vec"))
    distinct = store(ids.groupBy("h", "dim").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.flatten(F.collect_list("vec")).alias("vec")))
    # few rows: one per vector length
    shards = store(shard_plan(distinct, shard))
    tasks = max(1, 2 * int(shards.agg(F.sum("shards")).first()[0] or 0))  # two a shard, so that few shards share one
    dealt = distinct.join(shards, "dim").withColumn("shard", F.pmod(F.xxhash64("h"), F.col("shards")).cast("int")).select("dim", "shard", "h", "ids", "vec")
    index = store(dealt.repartition(tasks, "dim", "shard").groupBy("dim", "shard").applyInPandas(
        _build, "dim int, shard int, vec array<double>, ids array<array<long>>, layers array<int>, nodes array<int>, near array<int>, entry int"))
    asked = ok.where(F.col("id") % every == 0).select("id", "h")
    queries = store(distinct.join(asked.select("h").distinct(), "h").select("h", "dim", "vec"))
    block = F.ceil(F.col("asked") / F.greatest(F.lit(QUERY_BLOCK), F.col("size"))).cast("int")
    blocks = queries.groupBy("dim").agg(F.count("*").alias("asked")).join(shards, "dim").select("dim", "shards", block.alias("blocks"))
    there = index.join(blocks.drop("shards"), "dim").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sent = (queries.join(blocks, "dim").withColumn("block", F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int"))
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select("dim", "shard", "block", "h", "vec"))
    met = [side.repartition(tasks, "dim", "shard", "block").groupBy("dim", "shard", "block") for side in (there, sent)]
    found = met[0].cogroup(met[1]).applyInPandas(_ask(k), "h long, id long, score double")
    best = Window.partitionBy("h").orderBy(F.desc("score"), "id")
    top = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).select("h", "id", "score")
    of_query = Window.partitionBy("query_id", "h").orderBy(F.desc("score"), "vec_id")
    pairs = asked.withColumnRenamed("id", "query_id").join(top.withColumnRenamed("id", "vec_id"), "h").where("query_id <> vec_id")
    return pairs.withColumn("rank", F.row_number().over(of_query)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
