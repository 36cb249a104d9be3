"""Choosing k.

Control stays on the driver; every step is a distributed fit over the
persisted points. The sweep fits its candidates concurrently and scores
them all in one pass (``sweep_models``); each bisection step is one fit plus
one scoring aggregation. A scorer maps k to a ``ScoredModel`` and is
memoised, so a k is never fitted twice (fits are seeded, so a refit would
give the same model anyway).
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmint.operators.curve import best_k_range_bic
from segmint.operators.together import Together
from segmint.operators.train import DEFAULT_SEED, DEFAULT_TOL, ScoredModel, train_kmeans_default
from segmint.session import materialize

log = logging.getLogger(__name__)

# Fixed values of the reference's candidate rule.
MAX_K = 1000          # cap on k when there are more than LIMIT points
LIMIT = 100_000       # point count above which the sweep starts at 16 and stops at MAX_K
MIN_K_LARGE = 16

Scorer = Callable[[int], ScoredModel]


def candidate_ks(n: int, limit: int = LIMIT, max_k: int = MAX_K, min_k: int = MIN_K_LARGE) -> list[int]:
    """Powers of two from 2 up to N; above ``limit`` points from ``min_k`` up to ``max_k``.

    The defaults are the reference's rule. One point has no candidates.
    """
    top = max_k if n > limit else n
    k = min_k if n > limit else 2
    out = []
    while k <= top:
        out.append(k)
        k *= 2
    return out


def candidate_ks_frame(points: DataFrame, limit: int = LIMIT, max_k: int = MAX_K, min_k: int = MIN_K_LARGE) -> DataFrame:
    """O27 as a frame: (k) rows, from the point count, computed by Spark; ``min_k`` must be a power of two."""
    if min_k < 2 or min_k & (min_k - 1):
        raise ValueError("min_k must be a power of two from 2 on")
    n = F.count(F.lit(1))
    top = F.when(n > limit, F.lit(max_k)).otherwise(n)
    start_exp = F.when(n > limit, F.lit(min_k.bit_length() - 1)).otherwise(F.lit(1))
    # exponents start..floor(log2(top)); empty when top < 2^start
    last_exp = F.floor(F.log2(F.greatest(top, F.lit(1)).cast("double"))).cast("int")
    exps = F.when(last_exp >= start_exp, F.sequence(start_exp, last_exp)).otherwise(F.array().cast("array<int>"))
    return points.agg(exps.alias("e")).select(F.explode(F.transform("e", lambda i: F.pow(F.lit(2), i).cast("int"))).alias("k"))


def next_binsearch_value(k1: int, k2: int) -> int:
    """Midpoint rounded half up: k1 + round((k2 − k1)/2)."""
    return k1 + (k2 - k1 + 1) // 2


class MemoScorer:
    """Wrap a scorer so each k is fitted and scored once."""

    def __init__(self, fn: Scorer, owned: DataFrame | None = None):
        self.fn = fn
        self.owned = owned  # a frame this scorer cached for itself
        self.cache: dict[int, ScoredModel] = {}
        self._locks: dict[int, threading.Lock] = {}
        self._guard = threading.Lock()

    def release(self) -> None:
        """Unpersist the frame the scorer cached (scores already computed stay)."""
        if self.owned is not None:
            self.owned.unpersist()
            self.owned = None

    def __call__(self, k: int) -> ScoredModel:
        with self._guard:
            lock = self._locks.setdefault(k, threading.Lock())
        with lock:  # concurrent sweeps never fit the same k twice
            if k not in self.cache:
                s = self.fn(k)
                self.cache[k] = s
                log.info("k=%d wssse=%s avg_diameter=%s bic=%s", k, s.wssse, s.avg_diameter, s.bic)
        return self.cache[k]


def default_scorer(points: DataFrame, max_iter: int, features: str = "features", seed: int = DEFAULT_SEED) -> MemoScorer:
    return MemoScorer(lambda k: train_kmeans_default(points, k, max_iter, features, seed))


def fixed_center_scorer(points: DataFrame, order_by: str, features: str = "features") -> MemoScorer:
    """Deterministic stand-in for training: the k-centre model is the first k rows by ``order_by``.

    Same scoring job as a real fit; used to check the search logic exactly.
    """
    from segmint.operators.assign import first_rows_as_centers
    from segmint.operators.score import score_model

    pts = materialize(points.select(order_by, features))  # read by every candidate
    prefix: dict[str, object] = {"rows": None}
    guard = threading.Lock()

    def centres(k: int):
        with guard:  # one fetch of the longest prefix asked for so far
            rows = prefix["rows"]
            if rows is None or len(rows) < k:
                rows = first_rows_as_centers(pts, max(k, 32), order_by, features)
                prefix["rows"] = rows
        return rows[:k]

    return MemoScorer(lambda k: score_model(pts, centres(k), features), owned=pts)


CURVE_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("k", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("wssse", T.DoubleType()),
        T.StructField("avg_diameter", T.DoubleType()),
        T.StructField("aic", T.DoubleType()),
        T.StructField("bic", T.DoubleType()),
    ]
)


def curve_frame(spark, scored: Sequence[ScoredModel], run_id: str = "run") -> DataFrame:
    """The sweep's scores as a ``k_curve`` frame (one row per fitted k)."""
    rows = [(run_id, s.k, s.n, s.wssse, s.avg_diameter, s.aic, s.bic) for s in scored]
    return spark.createDataFrame(rows, CURVE_SCHEMA)


def sweep(scorer: Scorer, ks: Sequence[int], parallelism: int = 1, max_k: int | None = None) -> list[ScoredModel]:
    """Fit and score every candidate, in ascending k.

    ``parallelism`` > 1 submits several fits at once to the same session
    (each is an independent set of Spark jobs), as ``CrossValidator`` does; one
    that fails cancels the others.
    """
    ks = [int(k) for k in ks]
    if max_k is not None:
        ks = [k for k in ks if k <= max_k]
    if parallelism <= 1 or len(ks) <= 1:
        return [scorer(k) for k in ks]
    # Largest k first: the longest fits start earliest.
    with Together(scorer, parallelism) as fits:
        done = fits.all(sorted(ks, reverse=True))
    return [done[k] for k in ks]


def sweep_models(
    points: DataFrame,
    ks: Sequence[int],
    max_iter: int = 20,
    parallelism: int = 4,
    features: str = "features",
    seed: int = DEFAULT_SEED,
    max_k: int | None = None,
) -> list[ScoredModel]:
    """O28 with one scoring pass: fit every candidate (concurrently), then score all in one job."""
    from segmint.operators.score import score_many
    from segmint.operators.train import centers_of, train_kmeans

    ks = sorted(int(k) for k in ks if max_k is None or k <= max_k)
    fit = lambda k: train_kmeans(points, k, "k-means||", max_iter, DEFAULT_TOL, seed, features)
    if parallelism <= 1 or len(ks) <= 1:
        models = {k: fit(k) for k in ks}
    else:
        with Together(fit, parallelism) as fits:
            models = fits.all(sorted(ks, reverse=True))
    rows = {r["k"]: r for r in score_many(points, {k: centers_of(m) for k, m in models.items()}, features).collect()}
    q = len(centers_of(models[ks[0]])[0]) if ks else 0
    return [
        ScoredModel(
            k=k,
            wssse=float(rows[k]["wssse"]),
            avg_diameter=float(rows[k]["avg_diameter"]),
            model=models[k],
            n=int(rows[k]["n"]),
            q=q,
            bic=None if rows[k]["bic"] is None else float(rows[k]["bic"]),
            aic=None if rows[k]["aic"] is None else float(rows[k]["aic"]),
        )
        for k in ks
    ]


@contextmanager
def _looking_ahead(scorer: Scorer, parallelism: int):
    """A function of (k1, mid, k2) that scores ``mid`` while both possible next middles are fitted ahead.

    The search's decisions do not change: as soon as the middle is scored the next one is
    known, its fit goes on, and the one that lost is cancelled.
    """
    if parallelism <= 1:
        yield lambda k1, mid, k2: scorer(mid)
        return
    with Together(scorer, parallelism) as fits:
        def score(k1: int, mid: int, k2: int) -> ScoredModel:
            fits.keep([mid])
            now = fits.start(mid)
            for low, high in ((k1, mid), (mid, k2)):
                if high - low > 1 and next_binsearch_value(low, high) not in getattr(scorer, "cache", {}):
                    fits.start(next_binsearch_value(low, high))
            return now.result()

        yield score


def binsearch_bic(
    scorer: Scorer, lo: tuple[int, float], hi: tuple[int, float], final: str = "lower", parallelism: int = 1
) -> tuple[int, float]:
    """Bisect on BIC between (k1, b1) and (k2, b2).

    Fit the middle k; keep the half whose end is farther in BIC from the
    middle (left when |b1 − b| > |b − b2|). Adjacent ends: the lower BIC wins
    (``final="lower"``, the reference's rule) or the higher. With
    ``parallelism`` > 1 (and a memoised scorer) the next middles are fitted
    ahead, concurrently; the result is the same.
    """
    (k1, b1), (k2, b2) = lo, hi
    with _looking_ahead(scorer, parallelism) as score:
        while True:
            if k2 <= k1:
                return k1, b1
            if k2 - k1 == 1:
                if b1 is None or b2 is None:  # an end without variance has no BIC: the other one, or the smaller k
                    return (k2, b2) if b1 is None and b2 is not None else (k1, b1)
                if final == "lower":
                    return (k1, b1) if b1 < b2 else (k2, b2)
                return (k1, b1) if b1 > b2 else (k2, b2)
            mid = next_binsearch_value(k1, k2)
            b = score(k1, mid, k2).bic
            if b is None:  # no variance at mid, so none above it either: skipped, the search goes on below
                log.warning("skipping k = %d: zero variance", mid)
                k2, b2 = mid, None
            elif b1 is None or b2 is None:
                k1, b1 = mid, b
            elif abs(b1 - b) > abs(b - b2):
                k2, b2 = mid, b
            else:
                k1, b1 = mid, b


def binsearch_diameter(
    scorer: Scorer, lo: tuple[int, float], hi: tuple[int, float], parallelism: int = 1
) -> tuple[int, float]:
    """Bisect on average diameter; left when d1 − d > d − d2; adjacent ends: the upper k."""
    (k1, d1), (k2, d2) = lo, hi
    with _looking_ahead(scorer, parallelism) as score:
        while True:
            if k2 <= k1:
                return k1, d1
            if k2 - k1 == 1:
                return k2, d2
            mid = next_binsearch_value(k1, k2)
            d = score(k1, mid, k2).avg_diameter
            if (d1 - d) > (d - d2):
                k2, d2 = mid, d
            else:
                k1, d1 = mid, d


def linear_bic(scorer: Scorer, k1: int, k2: int) -> tuple[int, float]:
    """Every second k in [k1, k2) plus k2; the highest BIC (earliest on ties), k1 if none has one."""
    cands = list(range(k1, k2, 2)) + [k2]
    best = None
    for k in cands:
        b = scorer(k).bic
        if b is None:
            log.warning("skipping k = %d: zero variance", k)
        elif best is None or b > best[1]:
            best = (k, b)
    return best or (k1, None)


def _best_range(spark, scored: list[ScoredModel]) -> tuple[tuple[int, float], tuple[int, float]]:
    usable = [s for s in scored if s.bic is not None]
    if len(usable) < len(scored):
        log.warning("skipping %d candidate(s) with zero variance", len(scored) - len(usable))
    if not usable:  # every candidate fits without error: the smallest will do
        s = min(scored, key=lambda s: s.k)
        return (s.k, None), (s.k, None)
    if len(usable) == 1:
        s = usable[0]
        return (s.k, s.bic), (s.k, s.bic)
    row = best_k_range_bic(curve_frame(spark, usable)).first()
    return (int(row["k1"]), float(row["b1"])), (int(row["k2"]), float(row["b2"]))


def select_k(
    points: DataFrame,
    ks: Sequence[int] | None = None,
    max_iter: int = 20,
    strategy: str = "bisect",
    final: str = "lower",
    scorer: Scorer | None = None,
    parallelism: int = 4,
    features: str = "features",
    limit: int = LIMIT,
    max_k: int = MAX_K,
    min_k: int = MIN_K_LARGE,
) -> ScoredModel:
    """Sweep → largest BIC gap (O39b) → bisection (O40) or linear scan (O41) → model at the chosen k.

    Without ``ks`` the candidates are ``candidate_ks(n, limit, max_k, min_k)``, which needs
    two points (callers with one point fit k = 1).
    """
    if ks is None:
        n = points.count()
        if n < 2:
            raise ValueError("k selection needs at least two points")
        ks = candidate_ks(n, limit, max_k, min_k)
    if scorer is not None:
        return _select_k(points, ks, max_iter, strategy, final, scorer, parallelism, features, own_scorer=False)
    # our own cached copy of the points, released when the choice is made
    points = materialize(points.select(features))
    try:
        own = default_scorer(points, max_iter, features)
        return _select_k(points, ks, max_iter, strategy, final, own, parallelism, features, own_scorer=True)
    finally:
        points.unpersist()


def _select_k(
    points: DataFrame,
    ks: Sequence[int],
    max_iter: int,
    strategy: str,
    final: str,
    scorer: Scorer,
    parallelism: int,
    features: str,
    own_scorer: bool,
) -> ScoredModel:
    spark = points.sparkSession
    if not ks:
        raise ValueError("no candidate k")
    if own_scorer:
        # fits run concurrently, all candidates are scored in one pass; bisection reuses them
        scored = sweep_models(points, ks, max_iter, parallelism, features)
        scorer.cache.update({s.k: s for s in scored})
    else:
        scored = sweep(scorer, sorted(ks), parallelism)
    lo, hi = _best_range(spark, scored)
    if strategy == "bisect":
        k, _ = binsearch_bic(scorer, lo, hi, final, parallelism if isinstance(scorer, MemoScorer) else 1)
    elif strategy == "linear":
        k, _ = linear_bic(scorer, lo[0], hi[0])
    elif strategy == "diameter":
        k, _ = binsearch_diameter(
            scorer,
            (lo[0], scorer(lo[0]).avg_diameter),
            (hi[0], scorer(hi[0]).avg_diameter),
            parallelism if isinstance(scorer, MemoScorer) else 1,
        )
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return scorer(k)


def run_kmeans(points: DataFrame, k=None, max_iter: int = 20, features: str = "features", **kw) -> ScoredModel:
    """An int k fits once; a list of ks selects among them; None sweeps powers of two (``limit``, ``max_k``, ``min_k`` as in ``select_k``)."""
    if isinstance(k, int):
        return train_kmeans_default(points, k, max_iter, features)
    return select_k(points, ks=k, max_iter=max_iter, features=features, **kw)
