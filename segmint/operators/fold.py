"""A user's own reduce per cluster (O22): a Python function of two vectors, folded in a tree.

``cluster_fold`` first folds every partition's rows to one vector a cluster (Arrow batches,
no rows cross the network), then combines the partial vectors of ``FAN_IN`` partitions
at a time until one is left. A task of the tree reads at most ``FAN_IN`` vectors of a
cluster, so a cluster that holds all rows meets nowhere whole, and the number of rounds is the
logarithm of the partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from segmint.session import materialize

FAN_IN = 32
#: vectors' bytes a task holds before it passes its partial results on
HELD_BYTES = 64 << 20

Reduce = Callable[[np.ndarray, np.ndarray], np.ndarray]


def fold_rows(rows: Sequence[np.ndarray], f: Reduce, elementwise: bool = False) -> np.ndarray:
    """f over all rows; ``elementwise`` functions take whole matrices, half against half."""
    if elementwise and len(rows) > 2 and len({len(r) for r in rows}) == 1:
        m = np.stack(rows)
        while len(m) > 1:
            half = len(m) // 2
            folded = f(m[:half], m[half : 2 * half])
            m = np.concatenate([folded, m[2 * half :]]) if len(m) % 2 else folded
        return m[0]
    out = rows[0]
    for r in rows[1:]:
        out = f(out, r)
    return out


def _fold(keys: int, f: Reduce, elementwise: bool, schema: pa.Schema, in_order: bool):
    """One vector a key. Rows that come ``in_order`` of their keys give each key once; others may give a
    key again after ``HELD_BYTES``, which a later round puts together."""
    def run(batches):
        held: dict[tuple, np.ndarray] = {}
        size = 0

        def table():
            cols = [pa.array([k[i] for k in held], schema.field(i).type) for i in range(keys)]
            # a user's function may change the width, so each vector is its own list
            cols.append(pa.array([np.asarray(v, dtype=np.float64) for v in held.values()], schema.field(keys).type))
            return pa.RecordBatch.from_arrays(cols, schema=schema)

        for batch in batches:
            batch = batch.filter(batch.column(keys).is_valid())
            if not len(batch):
                continue
            values = batch.column(keys)
            flat, ends = values.flatten().to_numpy(zero_copy_only=False), values.offsets.to_numpy() - values.offsets[0].as_py()
            mine: dict[tuple, list] = {}
            for k, (lo, hi) in zip(zip(*(batch.column(i).to_pylist() for i in range(keys)), strict=True), zip(ends, ends[1:]), strict=True):
                mine.setdefault(k, []).append(flat[lo:hi])
            for k, rows in mine.items():
                got = fold_rows(([held[k]] if k in held else []) + rows, f, elementwise)
                if k not in held:
                    size += got.nbytes + 200
                held[k] = np.array(got, dtype=np.float64)
            if in_order and len(held) > 1:
                last = next(reversed(mine))
                rest = held.pop(last)
                yield table()
                held = {last: rest}
            elif not in_order and size > HELD_BYTES:
                yield table()
                held, size = {}, 0
        if held:
            yield table()

    return run


def cluster_fold(assigned: DataFrame, f: Reduce, value: str = "features", by: Sequence[str] = (), elementwise: bool = False, fan_in: int = FAN_IN) -> DataFrame:
    """O22 with a function: one row per (``by``…, cluster) with ``value`` folded by ``f`` over all its rows.

    ``f(x, y)`` takes two vectors (1-D arrays) and returns one; it must be associative and
    commutative, as the order of rows isn't fixed. Null vectors are skipped (a cluster of nulls alone has no row);
    vectors may differ in width if ``f`` allows it. ``elementwise`` promises that ``f`` works row by row on
    matrices, which saves a Python call a row. No rows, no clusters.
    """
    if fan_in < 2:
        raise ValueError("fan_in must be at least 2")
    keys = [*by, "cluster"]
    rows = assigned.select(*keys, F.spark_partition_id().alias("_part"), F.col(value).cast("array<double>").alias(value))
    keyed = [*keys, "_part"]
    arrow = to_arrow_schema(rows.schema)
    step = lambda in_order: _fold(len(keyed), f, elementwise, arrow, in_order)
    partial = materialize(rows.mapInArrow(step(False), rows.schema))
    parts = partial.agg(F.coalesce(F.max("_part"), F.lit(0)) + 1).first()[0]
    while True:
        # the vectors of fan_in partitions meet, each cluster's by itself
        parts = -(-parts // fan_in)
        met = partial.withColumn("_part", F.floor(F.col("_part") / fan_in).cast("int")).repartition(*keyed).sortWithinPartitions(*keyed)
        partial = met.mapInArrow(step(True), rows.schema)
        if parts == 1:
            return partial.drop("_part")
        partial = materialize(partial)
