"""Parquet tables with explicit column lists (so scans read only what they need)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def table(spark: SparkSession, root: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read ``<root>/<name>.parquet``; ``columns`` prunes the scan's read schema."""
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
