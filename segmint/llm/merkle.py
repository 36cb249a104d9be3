"""A Merkle manifest of a table: leaf digests, subtree and table roots, and a proof of each row.

Rows are leaves; every group's leaves stand in order, and every two consecutive nodes
become their digest until one node, the subroot, remains (a last node alone becomes the
digest of itself). The subroots, in order of their groups, make the top tree and the root.

The trees are evaluated by time-forward processing. A node's label is its place in time:
(position of its last leaf, level), so children come before parents. A sweep takes the
node with the smallest label from a priority queue, works out its digest and sends it to
the parent by putting it back under the parent's label; the reversed sweep takes the
largest label first and sends every child the rest of its proof. The queue is external:
a task's part of it (``LabelQueue``) holds the messages of one block of 2 to the ``LEVELS`` leaves, and
what leaves a block is written as rows (tree, label of the parent's block, digest), which
Spark's sort delivers to the next sweep in label order. So a task holds one block at a time,
and the number of sweeps is the logarithm of the rows to the base of a block's leaves.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmint.llm.common import prepare, store

LEVELS = 12
#: steps of a proof: sibling to the left, sibling to the right, alone
LEFT, RIGHT, ALONE = "L", "R", "S"


def field(c: Column) -> Column:
    """A value as the digest reads it: its length in bytes, a colon, the value; null is a hyphen."""
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*columns: Column) -> Column:
    """SHA-256, lowercase hex, of a row's values."""
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that follows from a leaf's digest and its proof (JVM-side)."""
    def step(h: Column, s: Column) -> Column:
        other = F.substring(s, 2, 64)
        return F.sha2(F.when(s.startswith(LEFT), F.concat(other, h)).when(s.startswith(RIGHT), F.concat(h, other)).otherwise(h), 256)

    return F.aggregate(proof, leaf, step)


def siblings(proof: Column) -> Column:
    """The digests in a proof, from the leaf to the root, one after another."""
    return F.translate(F.concat_ws("", proof), LEFT + RIGHT + ALONE, "")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class LabelQueue:
    """Messages by label, smallest first; with ``sign = -1`` largest first."""

    def __init__(self, sign: int = 1):
        self.heap, self.sign = [], sign

    def push(self, time: int, level: int, place: int, value) -> None:
        heapq.heappush(self.heap, (self.sign * time, self.sign * level, place, value))

    def __bool__(self) -> bool:
        return bool(self.heap)

    def take(self) -> tuple[int, int, list]:
        """The next label and all its messages by place."""
        time, level, _, value = heapq.heappop(self.heap)
        values = [value]
        while self.heap and self.heap[0][:2] == (time, level):
            values.append(heapq.heappop(self.heap)[3])
        return self.sign * time, self.sign * level, values


def sweep_up(digests: Sequence[str], levels: int) -> tuple[str, list[list[str]]]:
    """Forward sweep over a block: its top digest, ``levels`` levels up, and every level's digests."""
    n = len(digests)
    queue = LabelQueue()
    found: list[list[str]] = [[] for _ in range(levels + 1)]
    # in label order already: a heap without sifting
    queue.heap = [(k, 0, 0, d) for k, d in enumerate(digests)]
    while queue:
        time, level, values = queue.take()
        digest = values[0] if level == 0 else _sha("".join(values))
        here = len(found[level])
        found[level].append(digest)
        if level < levels:
            # the parent's last leaf
            last = min(((here >> 1) + 1 << level + 1), n) - 1
            queue.push(last, level + 1, here & 1, digest)
    return found[levels][0], found


def sweep_down(found: list[list[str]], suffix: tuple[str, ...]) -> list[tuple[str, ...]]:
    """Reversed sweep over a block: every leaf's proof, given that of the block's top node."""
    n, levels = len(found[0]), len(found) - 1
    queue = LabelQueue(-1)
    queue.push(n - 1, levels, 0, suffix)
    at = [len(f) for f in found]
    proofs: list[tuple[str, ...]] = [()] * n
    while queue:
        _, level, (rest,) = queue.take()
        at[level] -= 1
        i = at[level]
        if level == 0:
            proofs[i] = rest
            continue
        below = found[level - 1]
        left, right = 2 * i, 2 * i + 1
        both = right < len(below)
        end = min((left + 1) << (level - 1), n) - 1
        if both:
            queue.push(min((right + 1) << (level - 1), n) - 1, level - 1, 0, (LEFT + below[left], *rest))
            queue.push(end, level - 1, 0, (RIGHT + below[right], *rest))
        else:
            queue.push(end, level - 1, 0, (ALONE, *rest))
    return proofs


def _height(n: int, levels: int) -> int:
    """How often ``n`` nodes are halved, rounding up, until one remains; a block takes at most ``levels``."""
    return min((n - 1).bit_length(), levels)


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by (tree, block) as one table of each block; at most a batch and a block are held."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        trees, blocks = batch.column(0), batch.column(1)
        new = pc.or_(pc.not_equal(trees.slice(1), trees.slice(0, len(batch) - 1)), pc.not_equal(blocks.slice(1), blocks.slice(0, len(batch) - 1)))
        starts = [0, *(k + 1 for k in np.flatnonzero(new.to_numpy(zero_copy_only=False)).tolist()), len(batch)]
        if held and (held[-1].column(0)[0], held[-1].column(1)[0]) != (trees[0], blocks[0]):
            yield pa.Table.from_batches(held)
            held = []
        for lo, hi in zip(starts, starts[1:]):
            if lo:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


UP = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
OUT_ROWS = 512


def _up(levels: int):
    """Blocks (tree, block, place, n, digest) sorted by label → one row of each block."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for block in _cut(batches):
            n = block["n"][0].as_py()
            top, _ = sweep_up(block["digest"].to_pylist(), _height(n, levels))
            out.append({"tree": block["tree"][0].as_py(), "pos": block["block"][0].as_py(), "n": -(-n // (1 << levels)), "digest": top})
            if len(out) >= OUT_ROWS:
                yield pa.RecordBatch.from_pylist(out, UP)
                out = []
        yield pa.RecordBatch.from_pylist(out, UP)

    return run


def _down(levels: int):
    """The same blocks, each with its top node's message first (place -1) → every place's proof beside its other columns."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _cut(batches):
            subroot, suffix = block["subroot"][0].as_py(), tuple(block["proof"][0].as_py())
            block = block.slice(1)
            _, found = sweep_up(block["digest"].to_pylist(), _height(block["n"][0].as_py(), levels))
            proofs = sweep_down(found, suffix)
            for lo in range(0, len(proofs), OUT_ROWS):
                part = block.slice(lo, OUT_ROWS)
                part = part.set_column(part.schema.get_field_index("proof"), "proof", pa.array(proofs[lo : lo + OUT_ROWS], pa.list_(pa.string())))
                part = part.set_column(part.schema.get_field_index("subroot"), "subroot", pa.array([subroot] * len(part), pa.string()))
                yield from part.combine_chunks().to_batches()

    return run


def _in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """``nodes`` with block and place in front, the other columns as they are."""
    rest = [c for c in nodes.columns if c not in ("tree", "pos", "n", "digest")]
    return nodes.select("tree", F.shiftright("pos", levels).alias("block"), (F.col("pos") % (1 << levels)).cast("int").alias("place"), "n", "digest", *rest)


def _delivered(rows: DataFrame, blocks: int) -> DataFrame:
    """Whole blocks in label order. The number of tasks is given, as few bytes may be much work."""
    most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(1, min(most, blocks)), "tree", "block").sortWithinPartitions("tree", "block", "place")


def _climb(nodes: DataFrame, levels: int) -> list[tuple[DataFrame, int]]:
    """``nodes`` (tree, pos, n, digest, …) and what each forward sweep makes of them, until every
    tree has one node (one sweep at least), with the number of their blocks."""
    rounds, most = [], None
    while not rounds or most > 1:
        blocks = nodes.agg(F.count_if(F.col("pos") % (1 << levels) == 0)).first()[0]
        rounds.append((nodes, blocks))
        rows = _in_blocks(nodes.select("tree", "pos", "n", "digest"), levels)
        nodes = store(_delivered(rows, blocks).mapInArrow(_up(levels), "tree string, pos long, n long, digest string"))
        most = nodes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    return [*rounds, (nodes, 0)]


def _descend(rounds: list[tuple[DataFrame, int]], tops: DataFrame, levels: int) -> DataFrame:
    """Reversed sweeps: ``tops`` (tree, pos, subroot, proof) of the last round → the first round's rows with both columns.

    Only the last sweep's result, the rows with their proofs, isn't stored."""
    for k, (nodes, blocks) in reversed(list(enumerate(rounds[:-1]))):
        rows = _in_blocks(nodes, levels).withColumn("subroot", F.lit(None).cast("string")).withColumn("proof", F.lit(None).cast("array<string>"))
        first = tops.select("tree", F.col("pos").alias("block"), F.lit(-1).alias("place"), "subroot", "proof")
        both = rows.unionByName(first, allowMissingColumns=True)
        done = _delivered(both, blocks).mapInArrow(_down(levels), both.schema)
        tops = done.withColumn("pos", F.shiftleft("block", levels) + F.col("place")).drop("block", "place")
        if k:
            tops = store(tops)
    return tops


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Stored ``rows`` in order within each ``tree``, with ``pos`` (from 0) and ``n`` (rows of the tree).

    The rows are range-partitioned by tree and order, so a tree of any size is spread over
    many tasks; only the counts of (task, tree) are summed up, at most tasks + trees rows.
    """
    put = store(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("at", F.monotonically_increasing_id()))
    runs = put.groupBy("tree", F.shiftright("at", 33).alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("size"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("tree", "part", "first", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"), F.sum("size").over(Window.partitionBy("tree")).alias("n"))
    placed = put.withColumn("part", F.shiftright("at", 33)).join(store(runs), ["tree", "part"])
    return placed.withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("part", "at", "first", "before")


def build_manifest(docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), group_col: str = "lang", id_col: str = "doc_id",
                   keep: Sequence[Column] = (), levels: int = LEVELS) -> DataFrame:
    """One row per row: doc_id, leaf, subroot, root, proof (array of steps) and the columns of ``keep``.

    A leaf is the digest of ``columns`` (whole texts, null apart from empty). Leaves stand by
    id within their group; rows without an id come first, rows of one id stand by their digest, so
    repeated rows are leaves of their own and any order of them gives the same trees. Null is a group of its own,
    before all others; groups stand by their bytes. A proof's steps go from the leaf to the
    root: ``L`` or ``R`` and the sibling's digest by its side, ``S`` where a node is alone; a table of
    one row has no steps and its leaf is the root. An empty table gives no rows. Columns that
    aren't named are not read, whatever their names.
    """
    prepare(docs.sparkSession)
    tree = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaves = store(docs.select(F.col(id_col).cast("long").alias("doc_id"), tree.alias("tree"), leaf_digest(*[F.col(c) for c in columns]).alias("digest"),
                               F.monotonically_increasing_id().alias("row"), F.struct(F.lit(0).alias("none"), *keep).alias("kept")))
    nodes = store(numbered(leaves, ["doc_id", "digest", "row"]))
    lower = _climb(nodes.select("tree", "pos", "n", "digest", "doc_id", "kept"), levels)
    # the top tree's leaves are the subroots, in order of their groups
    subroots = store(numbered(lower[-1][0].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"]))
    upper = _climb(subroots, levels)
    top = upper[-1][0].first()
    tops = _descend(upper, upper[-1][0].select("tree", "pos", F.lit(None).cast("string").alias("subroot"), F.array().cast("array<string>").alias("proof")), levels)
    tops = tops.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"), "proof")
    found = _descend(lower, tops, levels)
    return found.select("doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(top.digest if top else None).cast("string").alias("root"), "proof", "kept.*").drop("none")


def check_manifest(manifest: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Proof digests and verdicts of ``manifest``: every leaf, or what ``tampered`` says it is now, is folded along its proof."""
    leaf = F.col("leaf") if tampered is None else F.coalesce(tampered, F.col("leaf"))
    out = manifest.withColumn("folded_root", fold(leaf, F.col("proof")))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
