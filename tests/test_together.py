"""Concurrent fits: job groups, a failure ends its siblings, look-ahead fits that lost are cancelled."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from segmint.operators import select as S
from segmint.operators.together import POOL, Together
from segmint.operators.train import ScoredModel


def _sleep(spark, seconds):
    spark.range(1).select(F.reflect(F.lit("java.lang.Thread"), F.lit("sleep"), F.lit(int(seconds * 1000)).cast("long")).alias("s")).collect()


def _scored(k, bic=0.0):
    return ScoredModel(k=k, wssse=1.0, avg_diameter=1.0, model=None, n=100, q=2, bic=bic)


def _no_job_within(spark, seconds):
    until = time.time() + seconds
    while spark.sparkContext.statusTracker().getActiveJobsIds() and time.time() < until:
        time.sleep(0.1)
    return not spark.sparkContext.statusTracker().getActiveJobsIds()


def test_a_failing_candidate_cancels_its_siblings(spark):
    _sleep(spark, 0)
    jobs = []

    def fit(k):
        if k == 4:
            time.sleep(1)
            raise ValueError("no fit for k = 4")
        for _ in range(30):  # a fit is many jobs
            _sleep(spark, 1)
            jobs.append(k)
        return _scored(k)

    begun = time.time()
    with pytest.raises(ValueError, match="k = 4"):
        S.sweep(fit, [2, 4, 8, 16], parallelism=3)
    assert time.time() - begun < 15 and _no_job_within(spark, 10)
    ran = len(jobs)
    time.sleep(1.5)
    assert len(jobs) == ran and 2 not in jobs  # nothing goes on, the queued one never began


def test_each_fit_has_its_group_and_the_callers_pool(spark):
    sc = spark.sparkContext
    seen = {}
    lock = threading.Lock()

    def fit(k):
        with lock:
            seen[k] = (sc.getLocalProperty("spark.jobGroup.id"), sc.getLocalProperty(POOL), sc.getLocalProperty("segmint.test"))
        return k * k

    sc.setLocalProperty("segmint.test", "caller")
    try:
        with Together(fit, 2) as fits:
            assert fits.all([1, 2, 3]) == {1: 1, 2: 4, 3: 9}
        assert len({g for g, _, _ in seen.values()}) == 3 and {p for _, p, _ in seen.values()} == {"fit-1", "fit-2", "fit-3"}
        assert {t for _, _, t in seen.values()} == {"caller"}
        sc.setLocalProperty(POOL, "mine")
        with Together(fit, 2) as fits:
            fits.all([4])
        assert seen[4][1] == "mine" and sc.getLocalProperty("spark.jobGroup.id") is None
    finally:
        sc.setLocalProperty(POOL, None)
        sc.setLocalProperty("segmint.test", None)


def test_lost_lookahead_is_cancelled(spark):
    """Of the fits ahead, the one not chosen would take a minute; the search doesn't wait for it."""
    f = lambda k: -float((k - 11) ** 2)
    path = []
    S.binsearch_bic(lambda k: path.append(k) or _scored(k, f(k)), (4, f(4)), (32, f(32)))
    begun_fits = set()

    def fit(k):
        begun_fits.add(k)
        for _ in range(1 if k in path else 60):
            _sleep(spark, 0.3 if k in path else 1)
        return _scored(k, f(k))

    begun = time.time()
    got = S.binsearch_bic(S.MemoScorer(fit), (4, f(4)), (32, f(32)), parallelism=3)
    assert time.time() - begun < 25 and _no_job_within(spark, 10)
    assert got == S.binsearch_bic(lambda k: _scored(k, f(k)), (4, f(4)), (32, f(32)))
    assert begun_fits > set(path)
