"""What each filter of a chain removes, in every order, by forward-backward path counting.

The orders of k filters are the paths through the lattice of subsets, from none to all; a
step that applies filter f after the set S is the edge S → S + f. What a step removes or
keeps depends on its edge alone, so everything is worked out once for each edge and read
from there by every order that passes it. Counting forward gives the orders that
reach a state, counting backward those that leave it; their product over an edge is how many
orders pass it, the weight of its removals in the Shapley sum. Rows are only read to count
how many of each part fail which set of filters: at most 2^k rows a part.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmint.llm.common import store
from segmint.llm.exact_dedup import by_key

MOST_FILTERS = 7  # 5,040 orders
FEWEST_WORDS = 200
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: word borders: space and U+0009 to U+000D; what filter C counts and D looks for (fixed values)
WHITE = " \t\n\x0b\f\r"
UPPER = "[A-Z]"
SIGNS = r"[#$%&*|]"


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters that read one text (null: empty)."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.filter(F.split(F.translate(text, WHITE, " " * len(WHITE)), " "), lambda w: w != "")
    n = F.size(words).cast("long")
    return {
        "A": n < FEWEST_WORDS,
        "B": F.size(F.array_distinct(words)).cast("long") * 100 < n * 50,
        "C": F.regexp_count(text, F.lit(UPPER)).cast("long") * 100 > F.char_length(text).cast("long") * 3,
        "D": text.rlike(SIGNS),
    }


def failure_counts(docs: DataFrame, labels: DataFrame, failures: dict[str, Column] | None = None, copies: str = "E",
                   id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): rows of each part by the set of filters they fail, bit i for the i-th filter.

    ``failures`` are conditions on a row; the last filter, ``copies``, is failed by a text that
    some smaller id has too, table-wide. Rows without an id neither fail it nor make others fail it;
    repeated rows of one id are no copies of each other. ``labels`` (doc_id, quality, toxic) marks good and toxic
    ids, each id once however often it is listed; unlabelled rows are neither.
    """
    failures = failures or text_failures(F.col(text_col))
    if copies in failures or len(failures) + 1 > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters, each under its own name")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    mask = reduce(lambda a, b: a + b, [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failures.values())])
    rows = store(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                             mask.cast("int").alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest")))
    total = rows.count()
    # only texts that occur again can be copies; the other rows never leave the left side
    again = store(rows.groupBy("digest").agg(F.count("*").alias("size"), F.min("doc_id").alias("first")).where("size > 1"))
    late = by_key(rows.where("doc_id is not null"), again, "digest", total).where("doc_id > first")
    bit = 1 << len(failures)
    # a copy counts with its bit, and is taken off where it was counted without
    counts = (rows.select("doc_id", "part", "mask", F.lit(1).alias("n"))
              .unionByName(late.select("doc_id", "part", "mask", F.lit(-1).alias("n")))
              .unionByName(late.select("doc_id", "part", (F.col("mask") + bit).alias("mask"), F.lit(1).alias("n"))))
    # one row of an id, part and set, however often it is repeated
    counts = counts.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    marked = counts.where("n <> 0").join(marks, "doc_id", "left")
    return marked.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
                                              F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def path_counts(k: int) -> tuple[list[int], list[int]]:
    """For every subset of k filters, as a bit set: the orders that reach it, and those that go on from it to all."""
    full = (1 << k) - 1
    forward, backward = [0] * (full + 1), [0] * (full + 1)
    forward[0] = backward[full] = 1
    for s in range(1, full + 1):
        forward[s] = sum(forward[s & ~(1 << f)] for f in range(k) if s >> f & 1)
    for s in range(full - 1, -1, -1):
        backward[s] = sum(backward[s | 1 << f] for f in range(k) if not s >> f & 1)
    return forward, backward


def edge_counts(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """``counts`` per part and mask → per part and edge (before, filter): its counts and the orders that pass it.

    Every (part, mask) row goes to all edges of the lattice, whose number depends on the filters alone.
    """
    k = len(names)
    forward, backward = path_counts(k)
    edges = F.array(*[F.struct(F.lit(s).alias("before"), F.lit(f).alias("filter"), F.lit(1 << f).alias("bit"), F.lit(forward[s] * backward[s | 1 << f]).alias("orders"))
                      for s in range(1 << k) for f in range(k) if not s >> f & 1])
    at = counts.select("part", "mask", "n", "good", "toxic", F.explode(edges).alias("e")).select("part", "mask", "n", "good", "toxic", "e.*")
    mask, before, bit = F.col("mask"), F.col("before"), F.col("bit")
    fails, earlier = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) != 0
    here = fails & ~earlier
    total = lambda cond, c="n": F.sum(F.when(cond, F.col(c)).otherwise(0)).cast("long")
    return at.groupBy("part", "before", "filter", "orders").agg(
        total(~fails & ~earlier).alias("kept"), total(here).alias("removed"), total(fails & earlier).alias("redundant"),
        total(mask == bit).alias("unique_fails"), total(here, "good").alias("good_lost"), total(here, "toxic").alias("toxic_lost"))


def audit_filters(docs: DataFrame, labels: DataFrame, failures: dict[str, Column] | None = None, copies: str = "E", **columns: str) -> DataFrame:
    """One row per part, order and step: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Null and empty parts are one part; null texts are empty. Each part has all orders and steps, zeros included;
    an empty table has no parts and gives no rows. Repeated rows count each; other columns
    are not read, whatever their names (see ``failure_counts`` for ids and labels).
    """
    failures = failures or text_failures(F.col(columns.get("text_col", "text")))
    names = [*failures, copies]
    edges = edge_counts(failure_counts(docs, labels, failures, copies, **columns), names)
    per_filter = F.struct("before", "filter", *COUNTS, (F.col("removed") * F.col("orders")).alias("weighted"))
    # k * 2^(k-1) edges a part
    parts = edges.groupBy("part").agg(F.collect_list(per_filter).alias("edges"))
    k = len(names)
    parts = parts.select("part", F.map_from_entries(F.transform("edges", lambda e: F.struct((e["before"] * k + e["filter"]).alias("at"), e))).alias("edge"),
                         F.array(*[_weighted(f) for f in range(k)]).alias("shapley"))
    steps = []
    for order in permutations(range(k)):
        seen = 0
        for i, f in enumerate(order):
            steps.append((seen * k + f, f, i + 1, "".join(names[g] for g in order)))
            seen |= 1 << f
    listed = F.from_json(F.lit(_json(steps)), "array<struct<at:int,filter:int,step:int,filter_order:string>>")
    at = parts.select("part", "edge", "shapley", F.explode(listed).alias("s"))
    step = F.col("edge")[F.col("s.at")]
    return at.select("part", "s.filter_order", "s.step", *[step[c].alias(c) for c in COUNTS], F.get("shapley", F.col("s.filter")).alias("shapley"))


def _weighted(f: int) -> Column:
    """A filter's removals, summed over all orders."""
    return F.aggregate("edges", F.lit(0).cast("long"), lambda total, e: total + F.when(e["filter"] == f, e["weighted"]).otherwise(0))


def _json(steps: list[tuple]) -> str:
    import json

    return json.dumps([dict(zip(("at", "filter", "step", "filter_order"), s, strict=True)) for s in steps])
