"""Feature building (O05–O08) and the three input frames used across the engine.

Activity → per (user, page) counts → optional category filter and scaling →
one dense ``array<double>`` per user, plus the dimension table
``(dim, dimension_id, dimension_name)``.

No per-user step ever sees a user's raw activity: narrow vectors are one
``groupBy(user)`` of conditional sums whose partial aggregation runs
map-side (one row per user per input partition reaches the shuffle), and
the map and sparse forms pre-aggregate on (user, page) first, so a user with
a third of all events still arrives as at most Q entries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmint.sources.tables import table
from segmint.sources.text import dense_from_map, index_rows

# Frames are broadcast only up to this many bytes (as JSON text).
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# A category (page list) is broadcast only below this many rows.
MAX_BROADCAST_CATEGORY = 5_000_000
# Vectors up to this width are assembled with one conditional sum per dimension.
PIVOT_MAX_Q = 256


def action_counts(events: DataFrame, user_col: str, page_col: str, by: Sequence[str] = ()) -> DataFrame:
    """(by…, user, page, n): actions per user and page, zero-count rows impossible."""
    return events.groupBy(*by, user_col, page_col).agg(F.count(F.lit(1)).alias("n"))


def group_by_user(
    events: DataFrame,
    user_col: str = "user_id",
    page_col: str = "page_id",
    kind_col: str | None = None,
    kinds: Sequence[str] = (),
) -> DataFrame:
    """One row per user with a page → count map per action kind.

    Without ``kind_col`` the single map column is ``actions``. With it, one
    map column per value in ``kinds`` (e.g. page_like, page_comment, …).
    """
    keys = [user_col, page_col] + ([kind_col] if kind_col else [])
    counts = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    entry = F.struct(F.col(page_col).cast("string").alias("key"), F.col("n").alias("value"))
    if not kind_col:
        # At most Q entries per user after the (user, page) pre-aggregation.
        return counts.groupBy(user_col).agg(F.map_from_entries(F.collect_list(entry)).alias("actions"))
    if not kinds:
        raise ValueError("name the action kinds to build one map per kind")
    aggs = [
        F.map_from_entries(F.collect_list(F.when(F.col(kind_col) == k, entry))).alias(k.replace("-", "_"))
        for k in kinds
    ]
    return counts.groupBy(user_col).agg(*aggs)


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only after the rows' number and bytes are proven small; else the planner decides."""
    n, size = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))).first()
    return F.broadcast(df) if n <= max_rows and (size or 0) <= MAX_BROADCAST_BYTES else df


def filter_to_category(
    counts: DataFrame,
    category: DataFrame,
    page_col: str,
    category_page_col: str = "page_id",
    category_col: str | None = None,
) -> DataFrame:
    """Keep actions on the category's pages, drop zero counts.

    With ``category_col`` the page list holds several categories: every kept
    row is tagged with its category (a page in two categories counts in both).
    """
    if category_col is None:
        cat = category.select(F.col(category_page_col).alias(page_col)).distinct()
        how = "left_semi"
    else:
        cat = category.select(F.col(category_col), F.col(category_page_col).alias(page_col)).distinct()
        how = "inner"
    cat = checked_broadcast(cat, MAX_BROADCAST_CATEGORY)
    return counts.join(cat, page_col, how).where(F.col("n") > 0)


def scaling_factor(counts: DataFrame, value_col: str = "n") -> float:
    """1 / (1 + largest count): maps every count into 0 < x < 1. One global aggregate."""
    top = counts.agg(F.max(value_col)).first()[0]
    return 1.0 / (1.0 + float(top or 0))


def scale_actions(
    counts: DataFrame, factor: float | None = None, value_col: str = "n", by: Sequence[str] = ()
) -> DataFrame:
    """Multiply counts by a factor (``factor=1`` keeps raw counts, as the test does).

    Without a factor: 1 / (1 + largest count), of the whole input or of each
    ``by`` group (e.g. each category), so every value lands in 0 < x < 1.
    """
    value = F.col(value_col).cast("double")
    if factor is not None or not by:
        f = scaling_factor(counts, value_col) if factor is None else float(factor)
        return counts.withColumn(value_col, value * F.lit(f))
    tops = counts.groupBy(*by).agg(F.max(value_col).cast("double").alias("_top"))
    tops = checked_broadcast(tops, MAX_BROADCAST_CATEGORY)  # one row per group
    scaled = counts.join(tops, list(by)).withColumn(value_col, value * (F.lit(1.0) / (F.lit(1.0) + F.col("_top"))))
    return scaled.drop("_top")


def dimension_table(
    pages: DataFrame,
    page_col: str,
    names: DataFrame | None = None,
    name_col: str = "name",
) -> DataFrame:
    """(dim, dimension_id, dimension_name): distinct pages in ascending order, numbered from 0.

    Names come from ``names`` (page → name) when given; a page without a name
    keeps its id as the name.
    """
    distinct = pages.select(F.col(page_col).cast("string").alias("dimension_id")).distinct()
    dims = index_rows(distinct.orderBy("dimension_id"), "dim").withColumn("dim", F.col("dim").cast("int"))
    if names is not None:
        labels = names.select(
            F.col(page_col).cast("string").alias("dimension_id"), F.col(name_col).alias("_name")
        ).dropDuplicates(["dimension_id"])
        dims = dims.join(labels, "dimension_id", "left").withColumn(
            "dimension_name", F.coalesce(F.col("_name"), F.col("dimension_id"))
        )
    else:
        dims = dims.withColumn("dimension_name", F.col("dimension_id"))
    return dims.select("dim", "dimension_id", "dimension_name")


def assemble_vectors(
    counts: DataFrame,
    dims: DataFrame,
    user_col: str,
    page_col: str,
    q: int | None = None,
    value_col: str | None = "n",
    by: Sequence[str] = (),
    method: str = "auto",
) -> DataFrame:
    """(by…, user, features array<double>) with features[dim] = value, 0 elsewhere.

    ``value_col=None`` counts rows (raw activity in, no pre-aggregation needed).

    Up to ``PIVOT_MAX_Q`` dimensions, one ``groupBy(user)`` with one
    conditional sum per dimension (partial aggregation map-side, one
    shuffle). Wider: join the dimension index, collect at most Q entries
    per user into a map and expand it.
    """
    value = F.lit(1.0) if value_col is None else F.col(value_col).cast("double")
    page = F.col(page_col).cast("string")
    # One job: at most PIVOT_MAX_Q + 1 labels reach the driver, which is also the width check.
    head = [r[0] for r in dims.orderBy("dim").select("dimension_id").limit(PIVOT_MAX_Q + 1).collect()]
    if q is None and len(head) <= PIVOT_MAX_Q:
        q = len(head)
    if q is None:
        q = dims.count()
    if method == "auto":
        method = "pivot" if q <= PIVOT_MAX_Q else "map"
    if method == "pivot":
        if q > PIVOT_MAX_Q:
            raise ValueError(f"pivot assembly is for at most {PIVOT_MAX_Q} dimensions")
        ids = head[:q]
        sums = [F.sum(F.when(page == F.lit(p), value).otherwise(F.lit(0.0))) for p in ids]
        known = counts.where(page.isin(ids))
        return known.groupBy(*by, user_col).agg(F.array(*sums).alias("features"))
    d = dims.select(F.col("dimension_id").alias("_page"), "dim")
    keyed = counts.join(d, page == F.col("_page"), "inner")
    per_user = keyed.groupBy(*by, user_col, "dim").agg(F.sum(value).alias("_v"))
    per_user = per_user.groupBy(*by, user_col).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("dim"), F.col("_v")))).alias("_m")
    )
    return per_user.select(*by, user_col, dense_from_map("_m", q).alias("features"))


# ---- the engine's three standard inputs ---------------------------------------------------


def user_actions(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """events → (user_id, features) with one dimension per event type, and the dimension table."""
    events = table(spark, root, "events", ["user_id", "event_type"])
    dims = dimension_table(events, "event_type")
    return assemble_vectors(events, dims, "user_id", "event_type", value_col=None), dims


def embedding_points(spark: SparkSession, root: str) -> DataFrame:
    """(vec_id, label, features array<double>) from the float embeddings."""
    emb = table(spark, root, "embeddings", ["vec_id", "embedding", "label"])
    return emb.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("features"))


def month_range(month: str) -> tuple[str, str]:
    """'199601' → ('1996-01-01 00:00:00', '1996-02-01 00:00:00'), a half-open range."""
    y, m = int(month[:4]), int(month[4:6])
    ny, nm = (y + 1, 1) if m == 12 else (y, m + 1)
    return f"{y:04d}-{m:02d}-01 00:00:00", f"{ny:04d}-{nm:02d}-01 00:00:00"


def customer_brand_counts(
    spark: SparkSession, root: str, by_month: bool = False, months: Sequence[str] | None = None
) -> DataFrame:
    """orders ⋈ lineitem ⋈ part, line count per (customer, brand) [and order month].

    ``months`` become timestamp ranges on ``o_orderdate``, so the filter
    reaches the orders scan (and prunes the join) instead of running after it.
    """
    li = table(spark, root, "lineitem", ["l_orderkey", "l_partkey"])
    cols = ["o_orderkey", "o_custkey"] + (["o_orderdate"] if by_month or months else [])
    orders = table(spark, root, "orders", cols)
    if months:
        cond = None
        for lo, hi in (month_range(m) for m in months):
            c = (F.col("o_orderdate") >= F.lit(lo).cast("timestamp")) & (F.col("o_orderdate") < F.lit(hi).cast("timestamp"))
            cond = c if cond is None else cond | c
        orders = orders.where(cond)
    part = table(spark, root, "part", ["p_partkey", "p_brand"])
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey).join(part, li.l_partkey == part.p_partkey)
    keys = ["o_custkey", "p_brand"]
    if by_month:
        joined = joined.withColumn("month", F.date_format("o_orderdate", "yyyyMM"))
        keys = ["month", *keys]
    return joined.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
