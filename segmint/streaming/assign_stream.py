"""Assignment of a streaming frame to the centres of a trained model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.operators.assign import assign


def assign_stream(stream: DataFrame, centers, features: str = "features") -> DataFrame:
    """Streaming frame + (cluster, d2, dist); stateless, so any output mode works."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame; use operators.assign.assign for batches")
    return assign(stream, centers, features)


def cluster_sizes_stream(assigned: DataFrame) -> DataFrame:
    """Running member count per cluster (write with output mode ``complete`` or ``update``)."""
    return assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("member_count"))
