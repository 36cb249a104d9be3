"""Exact copies of whole texts: local, salted and global combining, contents compared at each.

Texts are equal when identical after white space is deleted. A class of equal texts is
found in three steps, each an aggregation grouped by the whole normalised text beside its
digest, so that a shared digest alone never makes a class:

1. *local*: every task combines its own copies (the aggregation's map side), whatever
   their number, to one row of a text;
2. *salted*: keys that hold at least one row in ``SHARE`` get a salt, the task's number
   modulo ``SALTS``, so that a very large class meets in ``SALTS`` places, and there are at
   most ``SHARE`` such keys (a proven bound for the broadcast that names them);
3. *global*: the winners of these salts, at most ``SHARE * SALTS`` rows, are combined.

All other keys are settled by one shuffle. What travels back to the rows is narrow: a key
with one content is joined by its key (the hot ones by broadcast); rows of a key with
several contents, if there are any, are matched by their contents. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmint.llm.common import store

SALTS = 64
SHARE = 1000
#: deleted before texts are compared: space and U+0009 to U+000D (fixed values)
WHITE = " \t\n\x0b\f\r"


def _combine(rows: DataFrame, *keys: str) -> DataFrame:
    """One row of each key with its size and the best of its winners."""
    return rows.groupBy(*keys).agg(F.sum("size").alias("size"), F.min("best").alias("best"))


def _hot(counted: DataFrame, total: int) -> Column:
    """Whether a key holds at least one row in ``SHARE`` (at most ``SHARE`` keys can)."""
    return (F.col("size") > 1) & (F.col("size") * SHARE >= F.lit(total))


def by_key(rows: DataFrame, facts: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` joined with ``facts`` (one row of each ``key``, with its ``size`` among ``total`` rows).

    Keys that hold one row in ``SHARE`` or more are at most ``SHARE``: they are broadcast,
    so no task gets more than that share of the rows through one key.
    """
    hot = facts.where(_hot(facts, total))
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(facts.where(~_hot(facts, total)), key)
    return rows.join(F.broadcast(hot), key).unionByName(cold)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
                 shorten: Callable[[Column], Column] | None = None, keep_columns: bool = False) -> DataFrame:
    """One row per row: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    The text with the most code points stays, of those the one with the smallest id; rows
    without an id come last, and of wholly equal rows any one stays, so each class keeps
    exactly one row. Null texts count as empty, and all blank texts are one class. Very long
    texts are compared whole. An empty table gives no rows. Other columns are not read, whatever
    their names; with ``keep_columns`` they come along in one struct ``doc``. ``shorten`` makes the key
    from the digest (default: the digest itself); a shorter one costs comparisons, not results.
    """
    shorten = shorten or (lambda digest: digest)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if keep_columns else []
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.char_length(text).alias("n"), F.translate(text, WHITE, "").alias("norm"), *own)
    base = store(plain.withColumn("digest", F.unhex(F.sha2("norm", 256))).withColumn("row", F.monotonically_increasing_id()))
    base = base.withColumn("key", shorten(F.col("digest")))
    narrow = base.drop("norm", "doc")
    total = base.count()

    counted = narrow.groupBy("key").agg(F.count("*").alias("size"))
    hot = store(counted.where(_hot(counted, total)).select("key"))
    best = F.struct((-F.col("n")).alias("minus_n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row").alias("best")
    texts = base.select("key", "norm", F.lit(1).cast("long").alias("size"), best)
    cold = _combine(texts.join(F.broadcast(hot), "key", "left_anti"), "key", "norm")
    salted = texts.join(F.broadcast(hot), "key").withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    met = _combine(_combine(salted, "key", "salt", "norm"), "key", "norm")
    classes = store(cold.unionByName(met).drop("norm"))

    several = store(classes.groupBy("key").agg(F.count("*").alias("contents")).where("contents > 1").select("key"))
    if several.isEmpty():
        joined = by_key(narrow, classes, "key", total)
    else:
        one = classes.join(several, "key", "left_anti")
        open_rows = base.drop("doc").join(several, "key", "left_semi")
        first = open_rows.select(F.col("row").alias("at"), "norm")
        contents = classes.join(several, "key").join(first, F.col("at") == F.col("best.row")).drop("at")
        joined = by_key(narrow, one, "key", total).unionByName(open_rows.join(contents, ["key", "norm"]).drop("norm"))
    out = joined.select("row", "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
                        (F.col("row") == F.col("best.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
    if keep_columns:
        out = out.join(base.select("row", "doc"), "row")
    return out.drop("row")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all its columns, with one row of each class of equal texts."""
    return exact_groups(docs, id_col, text_col, keep_columns=True).where("kept").select("doc.*")
