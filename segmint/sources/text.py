"""Line-oriented text inputs (O01, O02) and their writers.

* ``inputs.txt``: one point per line, ``index:value`` pairs separated by one
  space. Line n is row n.
* ``users.txt``, ``pages.txt``, ``names.txt``: line n names row / dimension n.

Row numbers come from file order (files by name, then by place). ``index_rows``
numbers rows without leaving the JVM: the rows are stored with their partition
(or file block) and position, the sizes are counted from the stored rows, and
each row's number is its block's offset plus its position. Counting from
anything but the stored rows would not do: a sorted frame that runs twice may
be cut into other partitions the second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from segmint.session import materialize


def _numbered(tagged: DataFrame, block: list[str], index_col: str) -> DataFrame:
    """Number rows that carry ``block`` columns and ``_pos`` (rising inside a block), blocks in column order."""
    return number_stored(materialize(tagged), block, index_col)


def number_stored(stored: DataFrame, block: list[str], index_col: str) -> DataFrame:
    """``_numbered`` for rows that are stored already."""
    sizes = stored.groupBy(*block).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    # one row per partition or file block
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*block, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"))
    plain = [c for c in stored.columns if c not in (*block, "_pos")]
    return stored.join(offsets, block).select(*plain, (F.col("_offset") + F.col("_pos")).cast("bigint").alias(index_col))


def index_rows(df: DataFrame, index_col: str = "row_id") -> DataFrame:
    """Number rows 0..n-1 in the frame's current order (partition order, then row order)."""
    tagged = df.withColumn("_pid", F.spark_partition_id()).withColumn("_pos", F.monotonically_increasing_id())
    return _numbered(tagged, ["_pid"], index_col)


def tagged_lines(spark: SparkSession, source) -> tuple[DataFrame, list[str]]:
    """``value`` of a line frame, a file or a folder of files, with its block's columns (named beside) and ``_pos``."""
    if isinstance(source, DataFrame):
        lines = source.select(F.col(source.columns[0]).alias("value"), F.spark_partition_id().alias("_pid"))
        block = ["_pid"]
    else:
        lines = spark.read.text(source).select(
            "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")
        )
        block = ["_file", "_start"]
    return lines.withColumn("_pos", F.monotonically_increasing_id()), block


def _index_lines(spark: SparkSession, source, index_col: str) -> DataFrame:
    """(index, value) of a line frame, a file or a folder of files (in name order)."""
    lines, block = tagged_lines(spark, source)
    return _numbered(lines, block, index_col)


def parse_points(value: Column) -> Column:
    """``"i:v i:v …"`` → ``map<int,double>``; a bad token fails the job (ANSI cast)."""
    tokens = F.split(F.trim(value), " ")
    pairs = F.transform(
        F.filter(tokens, lambda t: t != ""),
        lambda t: F.struct(
            F.split(t, ":")[0].cast("int").alias("key"),
            F.split(t, ":")[1].cast("double").alias("value"),
        ),
    )
    return F.map_from_entries(pairs)


def read_points(spark: SparkSession, source) -> DataFrame:
    """``(row_id bigint, features map<int,double>)`` from an ``inputs.txt`` path or a line frame."""
    lines = _index_lines(spark, source, "row_id")
    return lines.select("row_id", parse_points(F.col("value")).alias("features"))


def spread(entries: Column, key: str, q: int) -> Column:
    """Structs sorted by the int field ``key``, from −1 to q − 1 at most → q + 1 structs, null where a key is missing.

    Each entry is followed by as many nulls as keys are missing after it: linear in q.
    """
    after = F.concat(F.slice(F.transform(entries, lambda e: e[key]), F.lit(2), F.size(entries)), F.array(F.lit(q)))
    return F.flatten(F.transform(
        F.arrays_zip(entries.alias("e"), after.alias("next")),
        lambda z: F.concat(F.array(z["e"]), F.array_repeat(F.when(F.lit(False), z["e"]), (z["next"] - z["e"][key] - 1).cast("int"))),
    ))


def dense_from_map(m, q: int) -> Column:
    """``map<int,double>`` → dense ``array<double>`` of width q (missing indices are 0)."""
    m = F.col(m) if isinstance(m, str) else m
    first = F.array(F.struct(F.lit(-1).alias("key"), F.lit(None).cast("double").alias("value")))
    known = F.filter(F.map_entries(m), lambda e: (e["key"] >= 0) & (e["key"] < q))
    values = F.transform(spread(F.concat(first, F.array_sort(known)), "key", q), lambda e: F.coalesce(e["value"], F.lit(0.0)))
    return F.when(m.isNotNull(), F.slice(values, 2, q))


def read_lookup(spark: SparkSession, source, index_col: str = "row_id", value_col: str = "user_id") -> DataFrame:
    """N-th line names the n-th row (users.txt) or dimension (pages.txt, names.txt)."""
    lines = _index_lines(spark, source, index_col)
    return lines.select(F.col(index_col), F.col("value").alias(value_col))


def format_points(features) -> Column:
    """Inverse of ``parse_points`` for dense arrays: non-zero entries as ``i:v``."""
    features = F.col(features) if isinstance(features, str) else features
    entries = F.filter(
        F.transform(features, lambda v, i: F.struct(i.alias("i"), v.alias("v"))),
        lambda e: e["v"] != 0,
    )
    return F.concat_ws(" ", F.transform(entries, lambda e: F.concat(e["i"].cast("string"), F.lit(":"), e["v"].cast("string"))))
