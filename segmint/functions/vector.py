"""Vector maths as Spark column expressions (O52a–d, O14).

Vectors are ``array<double>`` columns. When the width ``size`` is known and
small and the inputs are named columns, expressions are written out term by
term as one SQL expression (parsed once in the JVM, compiled by whole-stage
codegen); otherwise the higher-order-function form is used. Sums always run
left to right from the first element, so results equal a sequential fold
(and the SQL oracle's ``list_reduce``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Widest vector written out element by element inside one expression.
UNROLL_WIDTH = 128


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def dlit(x: float) -> str:
    """A double literal in Spark SQL text."""
    x = float(x)
    if math.isnan(x):
        return "CAST('NaN' AS DOUBLE)"
    if math.isinf(x):
        return "CAST('Infinity' AS DOUBLE)" if x > 0 else "CAST('-Infinity' AS DOUBLE)"
    return f"({x!r}D)"


def square(x) -> Column:
    """x²."""
    x = _col(x)
    return x * x


def vector_diff(a, b) -> Column:
    """Element-wise a − b. Unequal sizes give nulls (never silent truncation)."""
    return F.zip_with(_col(a), _col(b), lambda x, y: x - y)


def sq_norm(a, size: int | None = None) -> Column:
    if isinstance(a, str) and size is not None and 0 < size <= UNROLL_WIDTH:
        n = _q(a)
        return F.expr(" + ".join(f"({n}[{i}] * {n}[{i}])" for i in range(size)))
    return F.aggregate(_col(a), F.lit(0.0).cast("double"), lambda s, x: s + x * x)


def vector_norm(a, size: int | None = None) -> Column:
    """Euclidean norm. A bare number is treated as a 1-vector."""
    return F.sqrt(sq_norm(a, size))


def sq_distance_sql(a: str, b, size: int | None = None) -> str:
    """Σ (aᵢ − bᵢ)² as Spark SQL text; ``b`` is a column name or a list of floats."""
    n = _q(a)
    if isinstance(b, (list, tuple)):
        terms = [f"(({n}[{i}] - {dlit(c)}) * ({n}[{i}] - {dlit(c)}))" for i, c in enumerate(b)]
    else:
        m = _q(b)
        terms = [f"(({n}[{i}] - {m}[{i}]) * ({n}[{i}] - {m}[{i}]))" for i in range(size)]
    return " + ".join(terms)


def sq_distance(a, b, size: int | None = None) -> Column:
    """Σ (aᵢ − bᵢ)². ``b`` may be a column or a Python list of floats (a fixed centre)."""
    if isinstance(a, str) and isinstance(b, (list, tuple)):
        return F.expr(sq_distance_sql(a, list(b)))
    if isinstance(a, str) and isinstance(b, str) and size is not None and 0 < size <= UNROLL_WIDTH:
        return F.expr(sq_distance_sql(a, b, size))
    if isinstance(b, (list, tuple)):
        b = F.array(*[F.lit(float(v)) for v in b])
    return F.aggregate(
        F.zip_with(_col(a), _col(b), lambda x, y: (x - y) * (x - y)),
        F.lit(0.0).cast("double"),
        lambda s, v: s + v,
    )


def euclidean_distance(a, b, size: int | None = None) -> Column:
    """O52d / O14: Euclidean distance."""
    return F.sqrt(sq_distance(a, b, size))


def nearest_center(x, centers) -> Column:
    """struct(d2, cluster) of the nearest centre in an ``array<array<double>>`` column.

    For per-row centre lists (several runs in one job). Ties go to the lowest
    index, as Spark ML's assignment does.
    """
    x = _col(x)
    centers = _col(centers)
    scored = F.transform(
        centers,
        lambda c, j: F.struct(
            F.aggregate(
                F.zip_with(x, c, lambda p, q: (p - q) * (p - q)),
                F.lit(0.0).cast("double"),
                lambda s, v: s + v,
            ).alias("d2"),
            j.alias("cluster"),
        ),
    )
    return F.array_min(scored)


def to_double_array(c) -> Column:
    """Cast an array of any numeric type to ``array<double>``."""
    return _col(c).cast("array<double>")
