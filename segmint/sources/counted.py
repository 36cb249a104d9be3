"""Counted reads of the text inputs (O01, O03, O04): broken lines are set aside, not fatal.

The strict readers stop at the first malformed line. Here one pass over the input parses
every line, counts (``observe``) and writes a table of two parts: what parsed, and a
quarantine of the lines that didn't, whole, each with its reason. Nothing is read twice to
be counted, and no line is lost: ``lines`` = good + broken. Points keep the row number of
their line, broken ones too, so the lines of ``users.txt`` still name them.

Reasons: ``token`` (not ``index:value`` with an index from 0), ``index twice``; ``json``
(not the expected JSON, null lines among them), ``fields`` (an array of another length),
or the name of the map field that doesn't hold whole counts; ``page`` (a page without id).
The table stays in ``folder``, which must be new and shared by all executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from segmint.sources import jsonl, text

COUNTS = "map<string,bigint>"


@dataclass(frozen=True)
class CountedRead:
    """Parsed rows, quarantined lines (with ``value`` and ``reason``) and the counts of the pass."""

    rows: DataFrame
    broken: DataFrame
    counts: dict[str, int | None]


def _split(parsed: DataFrame, folder: str, **measures: Column) -> tuple[DataFrame, dict]:
    """Store ``parsed`` (with ``reason``) in its two parts and count it in the same pass."""
    spark = parsed.sparkSession
    seen = Observation("counted read")
    counted = parsed.withColumn("ok", F.col("reason").isNull()).observe(
        seen, F.count(F.lit(1)).alias("lines"), F.count("reason").alias("broken"), *[c.alias(k) for k, c in measures.items()])
    counted.write.mode("errorifexists").partitionBy("ok").parquet(folder)
    return spark.read.schema(counted.schema).parquet(folder), dict(seen.get)


def _parts(stored: DataFrame, counts: dict, columns: Sequence[str], place: Sequence[str] = ()) -> CountedRead:
    return CountedRead(stored.where("ok").select(*place, *columns), stored.where("not ok").select(*place, "value", "reason"), counts)


def read_points_counted(spark: SparkSession, source, folder: str) -> CountedRead:
    """O01 with ``rows`` (row_id, features), ``broken`` (row_id, value, reason) and the counts
    lines, broken, entries and top_index (null without entries)."""
    lines, block = text.tagged_lines(spark, source)
    tokens = F.filter(F.split(F.trim(F.coalesce("value", F.lit(""))), " "), lambda t: t != "")
    pairs = F.transform(tokens, lambda t: F.struct(
        F.when(F.size(F.split(t, ":")) == 2, F.get(F.split(t, ":"), F.lit(0)).try_cast("int")).alias("key"),
        F.get(F.split(t, ":"), F.lit(1)).try_cast("double").alias("value")))
    keys = F.transform("pairs", lambda p: p["key"])
    wrong = F.exists("pairs", lambda p: p["key"].isNull() | p["value"].isNull() | (p["key"] < 0))
    reason = F.when(wrong, "token").when(F.size(F.array_distinct(keys)) < F.size(keys), "index twice")
    parsed = lines.withColumn("pairs", pairs).withColumn("reason", reason)
    parsed = parsed.withColumn("features", F.when(F.col("reason").isNull(), F.map_from_entries("pairs"))).drop("pairs")
    stored, counts = _split(parsed, folder, entries=F.sum(F.size("features")), top_index=F.max(F.array_max(F.map_keys("features"))))
    return _parts(text.number_stored(stored, block, "row_id"), counts, ["features"], ["row_id"])


def read_user_activity_counted(spark: SparkSession, source, folder: str, columns: Sequence[str] = jsonl.ACTIVITY_COLUMNS) -> CountedRead:
    """O04 with ``rows`` (the typed columns), ``broken`` (value, reason) and the counts lines, broken and entries."""
    maps = [c for c in columns if c in jsonl.MAP_COLUMNS]
    fields = jsonl.lines_of(spark, source).withColumn("fields", F.from_json("value", "array<string>"))
    items = {c: F.get(F.col("fields"), F.lit(i)) for i, c in enumerate(columns)}
    parsed = fields.select("value", "fields", *[
        (F.from_json(items[c], COUNTS) if c in maps else items[c]).alias(f"field_{c}") for c in columns])
    reason = F.when(F.col("fields").isNull(), "json").when(F.size("fields") != len(columns), "fields")
    for c in maps:
        got = F.col(f"field_{c}")
        reason = reason.when(items[c].isNotNull() & (got.isNull() | F.exists(F.map_values(got), lambda n: n.isNull())), c)
    empty = F.create_map().cast(COUNTS)
    whole = parsed.withColumn("reason", reason).select(
        "value", "reason", *[(F.coalesce(f"field_{c}", empty) if c in maps else F.col(f"field_{c}")).alias(c) for c in columns])
    entries = sum((F.size(c) for c in maps), F.lit(0))
    stored, counts = _split(whole, folder, entries=F.sum(F.when(F.col("reason").isNull(), entries)))
    return _parts(stored, counts, columns)


def read_category_counted(spark: SparkSession, source, folder: str) -> CountedRead:
    """O03 with ``rows`` (category_id, page_id, name), ``broken`` (value, reason) and the counts lines
    (JSON documents), broken and pages. A path is read one document a file."""
    docs = jsonl.lines_of(spark, source, wholetext=True).withColumn("doc", F.from_json("value", jsonl.CATEGORY_SCHEMA))
    reason = F.when(F.col("doc.id").isNull() | F.col("doc.facebook").isNull(), "json").when(
        F.exists("doc.facebook", lambda p: p["id"].isNull()), "page")
    parsed = docs.withColumn("reason", reason)
    stored, counts = _split(parsed, folder, pages=F.sum(F.when(F.col("reason").isNull(), F.size("doc.facebook"))))
    read = _parts(stored, counts, ["doc"])
    pages = read.rows.select(F.col("doc.id").alias("category_id"), F.explode("doc.facebook").alias("p"))
    return CountedRead(pages.select("category_id", F.col("p.id").alias("page_id"), F.col("p.name").alias("name")), read.broken, counts)
