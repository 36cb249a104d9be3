"""Jaccard join of documents on word n-grams by vertical partitioning.

The n-grams have one global order (their 64-bit hashes), which is cut into fragments by
equal ranges. Two sets of at least the wanted similarity differ in a bounded number of
n-grams, each of which spoils one fragment at most, so a fine cut leaves them a known
number of equal fragments: fragments are the join key that finds every candidate, and a
set that shares fewer with all others together has no partner. Candidates then meet
fragment by fragment of a coarse cut: the join of a fragment counts a pair's common n-grams
in it alone, and Spark sums these partial overlaps per pair. No row holds a whole set beside
another, and pairs whose fragments are too unequal in size to reach the similarity, even
if the smaller of each pair of fragments lay in the larger, are left out before.

How fine the cut is depends on the size of a set, in bands half as large again as the
one before; a set near a band's lower end also takes part in the band below.

Equal sets are one class from the start. As partners share a known number of fragments, they
share one of a set's rarest, all but that number less one, in one order for all: only these
bring sets together. Each set that has such a fragment is first checked against the best
connected of those that have it; then only sets of different components are compared: those
that share a fragment with at most ``FEW`` sets pair by pair, if they share as many fragments as
partners do, and those of more common fragments in blocks of ``BLOCK`` sets with their counts in
one matrix. No pair of a common fragment is written unless it must be counted, and no link
between different sets is lost. What is copied for blocks goes by the sets that hang together
by common fragments, not by all that a chain of chance fragments joins.
"""

from __future__ import annotations

from functools import cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmint.llm.common import U64, byte_slices, collect_garbage, components, mix, prepare, release, store, tidy
from segmint.llm.windows import powers, word_codes, word_lists

NGRAM = 3
SIMILAR = (90, 100)
FINER = 0.5  # fragments beyond the most that a partner can spoil, as a share of those
PRUNE = 2
SHARES = 2  # of all fragments, looked through one after another
SLICES = 4  # fragments in which candidates are counted
BLOCK = 512
FEW = 32  # sets of a fragment that are compared pair by pair, not in blocks
SLICE_BYTES = 2 << 20  # of texts taken at a time (a longer one alone)
COLUMNS = 4096  # n-grams per fragment when a block is counted


@cache
def band_bounds(similar=SIMILAR, limit: int = 1 << 40) -> np.ndarray:
    """Least sizes of the bands: each half as large again as the one before, or more where partners may be further apart."""
    num, den = similar
    out = [1]
    while out[-1] < limit:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2, -(-out[-1] * den // num)))
    return np.array(out, dtype=np.int64)


def most_different(n: int, similar=SIMILAR) -> int:
    """The most n-grams in which a set of n and a similar larger one can differ."""
    num, den = similar
    return (n + n * den // num) * (den - num) // (den + num)


def ngram_sets(texts: pa.Array, ngram: int = NGRAM) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each (lower-cased) text; fewer words than n: the whole sequence."""
    lower = pa.compute.ascii_lower(texts)
    which, bounds, distinct = word_lists(lower)
    codes = word_codes(distinct)[which] if len(which) else np.zeros(0, np.uint64)
    grams = np.zeros(max(0, len(codes) - ngram + 1), dtype=np.uint64)
    for j in range(ngram):
        grams += mix(codes[j : len(codes) - ngram + 1 + j]) * powers(ngram - j)
    grams = mix(grams + U64(ngram))
    out = []
    for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
        n = b - a
        if n >= ngram:
            out.append(np.unique(grams[a : b - ngram + 1]))
        elif n:
            short = np.zeros(1, np.uint64)
            for j in range(n):
                short += mix(codes[a + j : a + j + 1]) * powers(n - j)
            out.append(mix(short + U64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(s: np.ndarray) -> int:
    """64-bit key of a set, even: the odd number after it stands for the set in the band below."""
    return int(mix(np.array([mix(s ^ U64(0xA24BAED4963EE407)).sum(dtype=np.uint64) + U64(len(s))], dtype=np.uint64)).view(np.int64)[0]) & ~1


def fragment_keys(s: np.ndarray, similar=SIMILAR, finer: float = FINER) -> list[tuple[np.ndarray, int]]:
    """Keys of a set's fragments and how many of them a partner shares at least: in its own
    band and, near the lower end, in the one below."""
    num, den = similar
    n = len(s)
    if not n:
        return []
    bounds = band_bounds(similar)
    band = int(np.searchsorted(bounds, n, side="right")) - 1
    out = []
    for b in [band] + ([band - 1] if band and -(-n * num // den) < bounds[band] else []):
        most = most_different(int(bounds[b + 1]) - 1, similar)
        cut = most + 1 + int(finer * (most + 1))
        piece = ((s >> U64(32)) * U64(cut)) >> U64(32)
        count = np.bincount(piece.astype(np.int64), minlength=cut)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(s))])
        end = np.cumsum(count)
        names = np.arange(cut, dtype=np.uint64) * powers(3) + np.full(1, b + 1, np.uint64) * powers(5)
        keys = mix(mix(sums[end] - sums[end - count] + count.astype(np.uint64)) + names)
        # a partner in this band: n and at most n / similarity, or the band's sizes
        spoilt = min(most_different(n, similar), most)
        full = count > 0
        need = cut - spoilt - int(cut - full.sum())
        # so many empty fragments that a partner's equal ones may all be empty: then those count too
        out.append((keys[full].view(np.int64), need) if need > 0 else (keys.view(np.int64), 1))
    return out


def _outline(ngram, similar, finer):
    """doc, n, k and for both bands the keys and the number a partner shares."""

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, 1, SLICE_BYTES):
                sets = ngram_sets(part.column(1), ngram)
                bands = [[*fragment_keys(s, similar, finer), (np.zeros(0, np.int64), 0), (np.zeros(0, np.int64), 0)][:2] for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_key(s) for s in sets], pa.int64()),
                     *(x for j in (0, 1) for x in (pa.array([b[j][0] for b in bands], pa.list_(pa.int64())), pa.array([b[j][1] for b in bands], pa.int32())))],
                    names=["doc", "n", "k", "keys", "need", "keys_below", "need_below"])

    return run


def slices_of(s: np.ndarray, fragments: int = SLICES) -> list[np.ndarray]:
    """A sorted set cut into fragments of the n-gram order by equal ranges."""
    at = np.arange(1, fragments, dtype=np.uint64) * U64((1 << 64) // fragments)
    return np.split(s, np.searchsorted(s, at))


def _sets(ngram):
    """k, n, sizes of all fragments, fragment and its n-grams: a row for each fragment of the wanted sets."""

    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, 1, SLICE_BYTES):
                rows = []
                for k, s in zip(part.column(2).to_pylist(), ngram_sets(part.column(1), ngram), strict=True):
                    if set_key(s) == k:
                        cut = slices_of(s)
                        rows += [(k, len(s), [len(x) for x in cut], f, x.view(np.int64)) for f, x in enumerate(cut)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.list_(pa.int64())))],
                    names=["k", "n", "sizes", "fragment", "grams"])

    return run


def rarest(met: DataFrame, needs: DataFrame) -> DataFrame:
    """key, node, need: of each node's shared fragments the rarest, all but ``need`` - 1 of them.

    ``met``: node, key; ``needs``: node, need. Two nodes with at least ``need`` fragments in common have the
    rarest of those among these, as the order (how many nodes have it, then the key itself) is one for all.
    """
    counts = met.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    ranked = met.join(counts, "key").select("key", "node", F.row_number().over(Window.partitionBy("node").orderBy("c", "key")).alias("at"),
                                            F.count("*").over(Window.partitionBy("node")).alias("m"))
    return ranked.join(needs, "node").where("at <= m - need + 1").select("key", "node", "need")


def fragment_lists(met: DataFrame, nodes: DataFrame) -> DataFrame:
    """The fragments of the wanted nodes in the form of ``sets``: k (the node), fragment (a share of the keys), grams (those keys)."""
    return met.join(nodes, "node", "left_semi").groupBy(
        F.col("node").alias("k"), F.pmod("key", F.lit(SLICES)).cast("int").alias("fragment")).agg(F.collect_list("key").alias("grams"))


def sharing_pairs(pairs: DataFrame, lists: DataFrame, needs: DataFrame) -> DataFrame:
    """Pairs of sets, of those pairs (a, b) of nodes that share as many fragments as either needs."""
    same = partial_overlaps(pairs, lists).groupBy("a", "b").agg(F.sum("partial").alias("same"))
    enough = same.join(needs.toDF("a", "na"), "a").join(needs.toDF("b", "nb"), "b").where("same >= na and same >= nb")
    return enough.select(set_of("a").alias("a"), set_of("b").alias("b")).where("a < b").distinct()


def set_of(node: str) -> Column:
    """The set of a node: a set in its own band is its (even) key, in the band below the odd number after it."""
    return F.col(node) - F.pmod(F.col(node), F.lit(2))


def partial_overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, fragment and the common n-grams of the pair in that fragment, from the fragment's n-grams alone."""
    left = sets.select(F.col("k").alias("a"), "fragment", F.col("grams").alias("ga"))
    right = sets.select(F.col("k").alias("b"), "fragment", F.col("grams").alias("gb"))
    return pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "fragment", F.size(F.array_intersect("ga", "gb")).alias("partial"))


def similar_pairs(pairs: DataFrame, sets: DataFrame, similar=SIMILAR) -> DataFrame:
    """The pairs (a, b) of set keys that are similar, by the sum of their partial overlaps."""
    num, den = similar
    sizes = sets.where("fragment = 0").select("k", "n", "sizes")
    both = pairs.join(sizes.toDF("a", "na", "sa"), "a").join(sizes.toDF("b", "nb", "sb"), "b")
    at_most = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    enough = lambda same: same * den >= (F.col("na") + F.col("nb") - same) * num
    fit = store(both.where(enough(at_most)).select("a", "b", "na", "nb"))
    same = partial_overlaps(fit.select("a", "b"), sets).groupBy("a", "b").agg(F.sum("partial").alias("same"))
    return fit.join(same, ["a", "b"]).where(enough(F.col("same"))).select("a", "b")


def block_links(pdf: pd.DataFrame, similar=SIMILAR) -> list[tuple[int, int]]:
    """Links between the two sides of a block (side 0 with 0 and 1), enough of them to join what they join.
    A set has a row for each of its fragments."""
    num, den = similar
    pdf = pdf.sort_values(["side", "k"]).reset_index(drop=True)
    of = (pdf[["side", "k"]] != pdf[["side", "k"]].shift()).any(axis=1).cumsum().to_numpy() - 1
    rows = np.repeat(of, [len(g) for g in pdf["grams"]])
    grams, at = np.unique(np.concatenate([np.asarray(g, np.int64) for g in pdf["grams"]]), return_inverse=True)
    pdf = pdf.drop(columns="grams").drop_duplicates(["side", "k"])
    size, label = pdf["n"].to_numpy(), pdf["component"].to_numpy()
    head = int((pdf["side"] == 0).sum())
    same = np.zeros((head, len(pdf)), dtype=np.float32)
    order = np.argsort(at, kind="stable")
    cut = np.searchsorted(at[order], np.arange(0, len(grams) + COLUMNS, COLUMNS))
    for c, (lo, hi) in enumerate(zip(cut, cut[1:], strict=False)):
        has = np.zeros((len(pdf), COLUMNS), dtype=np.float32)
        has[rows[order[lo:hi]], at[order[lo:hi]] - c * COLUMNS] = 1
        same += has[:head] @ has.T
    same = same.astype(np.int64)
    x, y = np.nonzero(same * den >= (size[:head, None] + size[None, :] - same) * num)
    parent = {}

    def root(v):
        while parent.get(v, v) != v:
            parent[v] = parent.get(parent[v], parent[v])
            v = parent[v]
        return v

    out = []
    k = pdf["k"].to_numpy()
    for p, q in zip(x.tolist(), y.tolist(), strict=True):
        if label[p] != label[q]:
            a, b = root(label[p]), root(label[q])
            if a != b:
                parent[a] = b
                out.append((int(k[p]), int(k[q])))
    return out


def open_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """key, node, k, component, c of the members (key, node, c) of fragments whose sets aren't all of one component so far."""
    known = members.select("key", "node", "c", set_of("node").alias("k")).join(labels, "k", "left").withColumn("component", F.coalesce("component", "k"))
    mixed = known.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    return known.join(mixed, "key").select("key", "node", "k", "component", "c")


def rest_links(members: DataFrame, labels: DataFrame, groups: DataFrame, sets: DataFrame, similar=SIMILAR, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between sets that share a fragment but not yet a component, found block by block.

    ``members``: key, k; ``labels``: k, component so far; ``groups``: k, group (what hangs
    together by shared fragments). The largest component of a group isn't compared with itself.
    The open sets and their blocks are tables of their own: the driver's memory goes by the
    size of a plan, and one plan of all would hold the join of members and labels a dozen times.
    """
    known = members.join(labels, "k", "left").withColumn("component", F.coalesce("component", "k"))
    mixed = known.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    open_ = store(known.join(mixed, "key", "left_semi").select("k", "component").distinct().join(groups, "k"))
    sizes = open_.groupBy("group", "component").agg(F.count("*").alias("c"))
    largest = sizes.groupBy("group").agg(F.max(F.struct("c", "component")).alias("m"), F.sum("c").alias("all"))
    each = (open_.join(largest, "group").withColumn("big", F.col("component") == F.col("m.component"))
            .withColumn("others", F.ceil((F.col("all") - F.col("m.c")) / block).cast("int")).withColumn("bigs", F.ceil(F.col("m.c") / block).cast("int")))
    spread = F.pmod(F.xxhash64("k"), F.when(F.col("big"), F.col("bigs")).otherwise(F.col("others"))).cast("int").alias("own")
    each = store(each.select("k", "component", "group", "big", "others", "bigs", spread))
    # a block of others meets each block of others (from its own number on) and each block of the largest component
    to_others = each.where("not big").withColumn("with", F.explode(F.sequence(F.lit(0), F.col("others") - 1))).select(
        "k", "component", "group", F.lit(False).alias("big"), F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"),
        F.when(F.col("own") <= F.col("with"), 0).otherwise(1).alias("side"))
    to_big = each.where("not big").withColumn("with", F.explode(F.sequence(F.lit(0), F.col("bigs") - 1))).select(
        "k", "component", "group", F.lit(True).alias("big"), F.col("own").alias("i"), F.col("with").alias("j"), F.lit(0).alias("side"))
    from_big = each.where("big and others > 0").withColumn("with", F.explode(F.sequence(F.lit(0), F.col("others") - 1))).select(
        "k", "component", "group", F.lit(True).alias("big"), F.col("with").alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"))
    rows = to_others.union(to_big).union(from_big).join(sets.drop("sizes"), "k")
    return rows.groupBy("group", "big", "i", "j").applyInPandas(
        lambda pdf: pd.DataFrame(block_links(pdf, similar), columns=["a", "b"], dtype="int64"), "a long, b long")


def jaccard_components(docs: DataFrame, similar=SIMILAR, ngram: int = NGRAM, id_col: str = "doc_id", text_col: str = "text",
                       finer: float = FINER) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    ``component_id`` is the smallest id that similar pairs lead to, its own included.
    Null and empty texts have the empty set, which is linked with nothing, not even
    another empty one. Rows with equal sets are one class, repeated rows among them. A
    null id gets no component and links nothing. Other columns are not read.
    """
    prepare(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    outline = store(plain.mapInArrow(tidy(_outline(ngram, similar, finer)), "doc long, n long, k long, keys array<long>, need int, keys_below array<long>, need_below int"))
    light = store(outline.select("doc", "n", "k", "need", "need_below"))
    full = light.where("doc is not null and n > 0")
    classes = store(full.groupBy("k").agg(F.min("doc").alias("doc")))
    # a set in its own band is its (even) key, in the band below the odd number after it
    own = outline.where("doc is not null and n > 0")
    each = own.select(F.col("k").alias("node"), F.explode("keys").alias("key")).union(own.select(F.col("k") + 1, F.explode("keys_below")))
    shares = []
    for share in range(SHARES):  # the disk holds the shuffled fragments of one share at a time
        part = each.where(F.pmod("key", F.lit(SHARES)) == share)
        often = store(part.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"))
        shares.append(store(part.join(often, "key").distinct()))
        release(often)
    release(outline)
    collect_garbage(docs.sparkSession)
    met = reduce(DataFrame.union, shares).select("key", "node")
    needs = full.select(F.col("k").alias("node"), "need").union(full.select(F.col("k") + 1, "need_below")).distinct()
    for _ in range(PRUNE):  # sets that share too few fragments with all others go, and with them what others share
        alone = met.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
        shared = met.join(alone, "key")
        enough = shared.groupBy("node").agg(F.count("*").alias("c")).join(needs, "node").where("c >= need").select("node")
        less = store(shared.join(enough, "node"))
        release(*shares)
        met, shares = less, [less]
    near = store(rarest(met, needs))
    members = store(near.join(near.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"), "key"))
    needs = store(members.select("node", "need").distinct())
    lists = store(fragment_lists(met, needs))
    release(less, near)
    collect_garbage(docs.sparkSession)

    weight = members.groupBy("node").agg(F.sum("c").alias("w"))
    middle = members.join(weight, "node").groupBy("key").agg(F.max(F.struct("w", "node")).alias("m")).select("key", F.col("m.node").alias("middle"))
    to_middle = members.join(middle, "key").where("node <> middle").select(F.least("node", "middle").alias("a"), F.greatest("node", "middle").alias("b")).distinct()
    wanted = needs.select(set_of("node").alias("k")).distinct().join(classes, "k")
    sets = store(plain.join(wanted, "doc").select("doc", "text", "k").mapInArrow(
        tidy(_sets(ngram)), "k long, n long, sizes array<int>, fragment int, grams array<long>").dropDuplicates(["k", "fragment"]))
    links = store(similar_pairs(store(sharing_pairs(to_middle, lists, needs)), sets, similar))
    collect_garbage(docs.sparkSession)
    so_far = store(components(links)).select(F.col("node").alias("k"), "component")
    open_ = store(open_members(members, so_far))
    few = open_.where(F.col("c") <= FEW)
    apart = few.select("key", F.col("node").alias("a"), F.col("component").alias("ca")).join(
        few.select("key", F.col("node").alias("b"), F.col("component").alias("cb")), "key").where("a < b and ca <> cb").select("a", "b").distinct()
    more = store(similar_pairs(store(sharing_pairs(apart, lists, needs)), sets, similar))
    collect_garbage(docs.sparkSession)
    many = open_.where(F.col("c") > FEW).select("key", "k")
    if not many.isEmpty():
        low = many.groupBy("key").agg(F.min("k").alias("low"))
        groups = store(components(many.join(low, "key").select(F.col("k").alias("a"), F.col("low").alias("b")))).select(
            F.col("node").alias("k"), F.col("component").alias("group"))
        more = more.union(store(rest_links(many, so_far, groups, sets, similar)))
        collect_garbage(docs.sparkSession)
    # the components so far stand for the links that made them
    final = components(so_far.toDF("a", "b").union(more)) if not more.isEmpty() else so_far.withColumnRenamed("k", "node")
    joined = final.select(F.col("node").alias("k"), "component").join(classes, "k")
    smallest = joined.groupBy("component").agg(F.min("doc").alias("component_id"))
    by_class = classes.join(joined.join(smallest, "component").select("k", "component_id"), "k", "left").select(
        "k", F.coalesce("component_id", "doc").alias("component_id"))
    return light.select("doc", "n", "k").join(by_class, "k", "left").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("doc").isNotNull(), F.col("component_id"))).otherwise(F.col("doc")).alias("component_id"))


def first_of_each(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", group_col: str = "component_id") -> DataFrame:
    """``docs`` without those whose group has a smaller id; of rows repeated under one id the first
    in the order of the other columns stays; rows without an id all stay."""
    gone = groups.where(F.col(group_col) < F.col("doc_id")).select(F.col("doc_id").alias("gone")).distinct()
    # the documents' own columns stay inside one struct, so their names can't clash with these
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    kept = rows.where("id is not null").join(gone, F.col("id") == F.col("gone"), "left_anti")
    first = kept.groupBy("id").agg(F.min("doc").alias("doc"))
    return first.unionByName(rows.where("id is null")).select("doc.*")
