"""JSON inputs of the upstream stages.

* category: one JSON object ``{"id": …, "facebook": [{"id": …, "name": …}, …]}``
* user activity: one JSON **array** per line, fields in a fixed column order
  (user id, gender, then four page → count maps).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the input formats (field names and column order must match the files).
# Category file fields: id, facebook (list of objects with id and name).
# Activity line: a JSON array in the order user_id, gender, page_like, page_comment, post_like, post_comment.
ACTIVITY_COLUMNS = ("user_id", "gender", "page_like", "page_comment", "post_like", "post_comment")
# Malformed text fails the job.
FAIL = {"mode": "FAILFAST"}
MAP_COLUMNS = frozenset({"page_like", "page_comment", "post_like", "post_comment"})

CATEGORY_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField(
            "facebook",
            T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])),
        ),
    ]
)


def lines_of(spark: SparkSession, source, wholetext: bool = False) -> DataFrame:
    if isinstance(source, DataFrame):
        return source.select(F.col(source.columns[0]).alias("value"))
    return spark.read.text(source, wholetext=wholetext)


def read_category(spark: SparkSession, source) -> DataFrame:
    """(category_id, page_id, name), one row per page of the category; malformed JSON fails.

    ``source`` is a path (read with ``multiLine``) or a frame of JSON strings.
    """
    if isinstance(source, DataFrame):
        parsed = lines_of(spark, source).select(F.from_json("value", CATEGORY_SCHEMA, FAIL).alias("c")).select("c.*")
    else:
        parsed = spark.read.schema(CATEGORY_SCHEMA).options(multiLine=True, **FAIL).json(source)
    return parsed.select(F.col("id").alias("category_id"), F.explode("facebook").alias("p")).select(
        "category_id", F.col("p.id").alias("page_id"), F.col("p.name").alias("name")
    )


def read_user_activity(spark: SparkSession, source, columns: Sequence[str] = ACTIVITY_COLUMNS) -> DataFrame:
    """One JSON array per line → typed columns in the given order.

    Map fields become ``map<string,bigint>``; the rest stay strings. Malformed JSON fails.
    """
    arr = lines_of(spark, source).select(F.from_json("value", "array<string>", FAIL).alias("a"))
    cols = []
    for i, name in enumerate(columns):
        item = F.get(F.col("a"), i)
        if name in MAP_COLUMNS:
            cols.append(F.coalesce(F.from_json(item, "map<string,bigint>", FAIL), F.create_map().cast("map<string,bigint>")).alias(name))
        else:
            cols.append(item.alias(name))
    return arr.select(*cols)


def activity_line(columns: Sequence[str] = ACTIVITY_COLUMNS) -> F.Column:
    """Inverse of ``read_user_activity``: the JSON array text of one row."""
    parts = []
    for name in columns:
        if name in MAP_COLUMNS:
            parts.append(F.to_json(F.col(name)))
        else:
            parts.append(F.col(name).cast("string"))
    return F.to_json(F.array(*parts))
