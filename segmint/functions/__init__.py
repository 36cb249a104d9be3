from segmint.functions.curve_math import midpoint, slope
from segmint.functions.keys import cluster_id, consistent_hash
from segmint.functions.vector import (
    euclidean_distance,
    nearest_center,
    sq_distance,
    sq_norm,
    square,
    to_double_array,
    vector_diff,
    vector_norm,
)

__all__ = [
    "cluster_id",
    "consistent_hash",
    "euclidean_distance",
    "midpoint",
    "nearest_center",
    "slope",
    "sq_distance",
    "sq_norm",
    "square",
    "to_double_array",
    "vector_diff",
    "vector_norm",
]
