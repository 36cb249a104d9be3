"""Several fits at once over one session, each in a job group of its own.

Every fit runs in a thread that inherits the caller's local properties (user, tags,
scheduler pool), under its own job group, so it can be told apart and ended by itself; a
caller without a scheduler pool gets one pool a fit, which a FAIR scheduler serves in
turn (FIFO ignores it). When one fit fails, its siblings' running and coming jobs are
cancelled and its error is raised; a fit that is no longer wanted is cancelled likewise.
Fits that use no Spark (stubs) are simply not started, or left to end.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_EXCEPTION, Future, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

POOL = "spark.scheduler.pool"


class Together:
    """``fit(k)`` for several k at a time, at most ``parallelism``; a context manager that leaves no fit running."""

    def __init__(self, fit: Callable, parallelism: int):
        self.fit = fit
        self.name = f"fits-{uuid.uuid4().hex}"
        self.spark = SparkSession.getActiveSession()
        self.sc = None if self.spark is None else self.spark.sparkContext
        self.pool = ThreadPoolExecutor(max_workers=parallelism)
        self.futures: dict[object, Future] = {}

    def __enter__(self) -> Together:
        return self

    def __exit__(self, *_) -> None:
        self.keep(())
        self.pool.shutdown(wait=True)

    def _group(self, k) -> str:
        return f"{self.name}-{k}"

    def _run(self, k):
        if self.sc is not None:
            self.sc.setJobGroup(self._group(k), f"fit for k = {k}")
            if self.sc.getLocalProperty(POOL) is None:
                self.sc.setLocalProperty(POOL, f"fit-{k}")
        return self.fit(k)

    def start(self, k) -> Future:
        if k not in self.futures:
            run = self._run if self.sc is None else inheritable_thread_target(self.spark)(self._run)
            self.futures[k] = self.pool.submit(run, k)
        return self.futures[k]

    def keep(self, wanted: Iterable) -> None:
        """Cancel every unfinished fit but the wanted ones."""
        wanted = set(wanted)
        for k, future in list(self.futures.items()):
            if k not in wanted and not future.done():
                if not future.cancel() and self.sc is not None:
                    log.info("cancelling the fit for k = %s", k)
                    # a fit is many jobs: those it would start next are refused as well
                    self.sc._jsc.sc().cancelJobGroupAndFutureJobs(self._group(k))
                del self.futures[k]

    def all(self, ks: Iterable) -> dict:
        """All results by k; the first failure cancels the others and is raised."""
        futures = {k: self.start(k) for k in ks}
        done, _ = wait(futures.values(), return_when=FIRST_EXCEPTION)
        for future in done:
            if future.exception() is not None:
                self.keep(())
                raise future.exception()
        return {k: f.result() for k, f in futures.items()}
