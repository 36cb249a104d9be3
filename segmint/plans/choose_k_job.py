"""Entry B: choose k for a segmentation input folder.

Only the iteration count of the params string is used (init and epsilon are
ignored, as in the reference's k selection).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from segmint.operators.select import select_k
from segmint.operators.train import parse_params
from segmint.operators.sparse import sparse_scorer
from segmint.plans.kmeans_job import _is_sparse, load_inputs
from segmint.session import materialize


def choose_k_job(
    spark: SparkSession, input_dir: str, params: str = "kmeans||,20,0.0001", ks=None, representation="auto", **kw
) -> int:
    _, iterations, _ = parse_params(params)
    sparse = _is_sparse(spark, input_dir, representation)
    points, _, q = load_inputs(spark, input_dir, sparse)
    if sparse:
        points = materialize(points.select("idx", "val"))
        best = select_k(points, ks=ks, scorer=sparse_scorer(points, q, iterations), **kw)
    else:
        best = select_k(points.select("features"), ks=ks, max_iter=iterations, **kw)
    return best.k
