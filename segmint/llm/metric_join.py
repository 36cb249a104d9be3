"""Near-duplicate vectors by an exact metric range join.

On vectors of length one a cosine of at least c is a distance of at most
r = sqrt(2 - 2c). Pivots of each label part its vectors into cells by the nearest pivot.
If x in cell i and y in cell j are within r, the triangle inequality gives
d(y, p_i) <= d(y, p_j) + 2r, so a vector is copied into every cell whose pivot is at most
2r farther than its own: then each cell holds all partners of the vectors at home in it,
and cells join independently. Links are counted at home only, so a copy adds none.

Equal vectors are one class with a weight. A label has about sqrt(n) pivots at most, no two
of them within 2r, so a tight group lies in few cells; they are the only thing sent to every
task. A cell is joined in tiles: a part of about ``PART`` vectors at home against a part of
about ``PART`` of all that are there, so no task holds a whole cell. Links are summed over a
vector's tiles, and every tile gives the edges it found.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.llm.common import components, prepare, store
from segmint.llm.vectors import cosines, matrix, unit, usable

CELL = 2000
PART = 4096
BLOCK = 512
SLACK = 1e-6


def _deal(pivots: dict, radius: float):
    """Rows of each vector at home and wherever it may have a partner."""

    def run(batches):
        for batch in batches:
            pdf = batch.to_pandas()
            for (label, dim), rows in pdf.groupby(["label", "dim"], sort=False):
                x = matrix(batch.column(batch.schema.get_field_index("vec")).take(pa.array(rows.index.to_numpy())))
                p = pivots[label, dim]
                far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (unit(x) @ p.T)))
                home = far.argmin(axis=1)
                row, cell = np.nonzero(far <= far.min(axis=1, keepdims=True) + 2 * radius + SLACK)
                at = rows.index.to_numpy()[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), label, np.int64)), pa.array(np.full(len(row), dim, np.int32)), pa.array(cell.astype(np.int32)), pa.array(cell == home[row]),
                     pa.array(pdf["h"].to_numpy()[at]), pa.array(pdf["w"].to_numpy()[at]), batch.column(batch.schema.get_field_index("vec")).take(pa.array(at))],
                    names=["label", "dim", "cell", "home", "h", "w", "vec"])

    return run


def join_labels(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of a[i] and b[i] in ``parent`` (index of a smaller or equal member), in place."""
    while True:
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up
        x, y = parent[a], parent[b]
        if (x == y).all():
            return
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))


def apart(u: np.ndarray, least: float) -> np.ndarray:
    """Rows of unit vectors ``u``, each with a cosine of less than ``least`` to those taken before it."""
    kept = np.empty_like(u)
    n = 0
    for x in u:
        if not n or (kept[:n] @ x).max() < least:
            kept[n] = x
            n += 1
    return kept[:n]


def join_tile(pdf: pd.DataFrame, least: float) -> pd.DataFrame:
    """h, links (of the ``here`` rows with the ``there`` rows) and the smallest row they hang together with."""
    pdf = pdf.sort_values("h", kind="stable").reset_index(drop=True)
    x = np.array(pdf["vec"].tolist(), dtype=np.float64)
    u, w = unit(x), pdf["w"].to_numpy()
    here, there = np.flatnonzero(pdf["here"].to_numpy()), np.flatnonzero(pdf["there"].to_numpy())
    links, parent = np.zeros(len(pdf), np.int64), np.arange(len(pdf))
    for lo in range(0, len(here), BLOCK):
        rows = here[lo : lo + BLOCK]
        p, q = np.nonzero(u[rows] @ u[there].T >= least - SLACK)
        p, q = rows[p], there[q]
        keep = p != q
        p, q = p[keep], q[keep]
        keep = np.concatenate([cosines(x[p[k : k + 100_000]], x[q[k : k + 100_000]]) for k in range(0, len(p), 100_000)] or [np.zeros(0)]) >= least
        p, q = p[keep], q[keep]
        np.add.at(links, p, w[q])
        if len(p):
            join_labels(parent, p, q)
    h = pdf["h"].to_numpy()
    out = pd.DataFrame({"h": h, "links": links, "root": h[parent]})
    return out[(out["links"] > 0) | (out["h"] != out["root"])]


def near_duplicates(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    cell: int = CELL, part: int = PART) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept.

    Vectors are compared only under equal labels that aren't null and equal lengths.
    Vectors that are null, empty, zero or hold null or non-finite numbers, and rows
    without an id or label, link with nothing: no links, their own id, kept (a null id:
    null and not kept). Equal vectors link; a row repeated under its id counts as another
    vector. An empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    prepare(spark)
    radius = math.sqrt(2 - 2 * least)
    ok = store(usable(vectors.where(F.col(label_col).isNotNull()).select(F.col(id_col), F.col(vec_col), F.col(label_col).cast("long").alias("label")),
                      id_col, vec_col, "label"))
    classes = store(ok.groupBy("h", "label", "dim").agg(F.count("*").alias("w"), F.min("id").alias("low")))
    distinct = store(ok.join(classes.select("h", "w", F.col("low").alias("id")), ["h", "id"]).dropDuplicates(["h"]).select("h", "label", "dim", "w", "vec"))
    sizes = distinct.groupBy("label", "dim").agg(F.count("*").alias("n"), F.min("h").alias("low"))
    # about min(n / cell, sqrt n) pivots of each label, and at least one
    every = F.greatest(F.lit(1.0), F.least(F.col("n") / F.lit(1.0 * cell), F.sqrt("n")))
    picked = (distinct.join(sizes, ["label", "dim"])
              .where((F.col("h") == F.col("low")) | (F.pmod(F.xxhash64("h"), F.lit(1 << 40)) < F.lit(1 << 40) * (every - 1) / F.col("n")))
              .select("label", "dim", "vec", "h").orderBy("h"))
    pivots: dict = {}
    for row in picked.toLocalIterator():
        pivots.setdefault((row.label, row.dim), []).append(row.vec)
    pivots = {k: apart(unit(np.array(v, dtype=np.float64)), 1 - 2 * radius**2) for k, v in pivots.items()}
    dealt = store(distinct.mapInArrow(_deal(pivots, radius), "label long, dim int, cell int, home boolean, h long, w long, vec array<double>"))
    key = ["label", "dim", "cell"]
    parts = dealt.groupBy(*key).agg(F.ceil(F.count(F.when(F.col("home"), 1)) / part).cast("int").alias("is"), F.ceil(F.count("*") / part).cast("int").alias("js"))
    tile = lambda i, j, here, there: F.struct(i.alias("i"), j.alias("j"), here.alias("here"), there.alias("there"))
    i, j = F.col("i"), F.col("j")
    # a vector at home meets every part of its cell, and every vector there every part at home; in the tile that is both it is one row
    at_home = F.when(F.col("home"), F.transform(F.sequence(F.lit(0), F.col("js") - 1), lambda k: tile(i, k, F.lit(True), k == j)))
    met = F.transform(F.filter(F.sequence(F.lit(0), F.col("is") - 1), lambda k: ~F.col("home") | (k != i)), lambda k: tile(k, j, F.lit(False), F.lit(True)))
    rows = (dealt.join(parts, key).where(F.col("is") > 0).withColumn("i", F.pmod(F.col("h"), F.col("is")).cast("int")).withColumn("j", F.pmod(F.col("h"), F.col("js")).cast("int"))
            .select(*key, F.explode(F.when(F.col("home"), F.concat(at_home, met)).otherwise(met)).alias("t"), "h", "w", "vec").select(*key, "t.*", "h", "w", "vec"))
    found = store(rows.groupBy(*key, "i", "j").applyInPandas(lambda pdf: join_tile(pdf, least), "h long, links long, root long"))
    links = found.groupBy("h").agg(F.sum("links").alias("links"))
    joined = components(found.where("h <> root").select(F.col("h").alias("a"), F.col("root").alias("b")).distinct())
    lows = joined.join(classes.select(F.col("h").alias("node"), "low"), "node")
    smallest = lows.groupBy("component").agg(F.min("low").alias("component_id"))
    by_class = (classes.join(links, "h", "left").join(lows.join(smallest, "component").select(F.col("node").alias("h"), "component_id"), "h", "left")
                .select("h", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component_id", "low").alias("component_id")))
    # rows of one id are told apart by their vector's key
    by_row = ok.select("id", "h").distinct().join(by_class, "h")
    keyed = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.xxhash64(
        F.transform(F.col(vec_col).cast("array<double>"), lambda x: x + F.lit(0.0)), F.col(label_col).cast("long")).alias("h"))
    return keyed.join(by_row.withColumnRenamed("id", "vec_id"), ["vec_id", "h"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"))
