"""Streaming use of a trained model.

The reference has no streams: every input is a bounded file. The one
streaming need of a segmentation job is to place newly arriving users into
existing segments; ``assign_stream`` applies the batch ``assign`` operator
(a projection, or Arrow batches with a broadcast centre matrix) to a
streaming frame unchanged, and ``cluster_sizes_stream`` keeps running
segment sizes with a streaming aggregation.
"""

from segmint.streaming.assign_stream import assign_stream, cluster_sizes_stream

__all__ = ["assign_stream", "cluster_sizes_stream"]
