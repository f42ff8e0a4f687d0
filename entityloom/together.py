"""Independent Spark jobs at the same time."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """The results of ``jobs`` in order; the driver only waits for them.

    Each thread takes over the caller's job group, tags and scheduler pool.  If one job
    fails, what the others run is cancelled, and the failure is raised.
    """
    if not jobs:
        return []
    context, tag = spark.sparkContext, f"together-{uuid.uuid4().hex}"

    def tagged(job: Callable[[], object]) -> Callable[[], object]:
        def run() -> object:
            context.addJobTag(tag)
            return job()

        return _as_caller(spark, run)

    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(tagged(job)) for job in jobs]
        done, _ = wait(running, return_when=FIRST_EXCEPTION)
        failed = [f for f in running if f in done and f.exception() is not None]
        if failed:
            context.cancelJobsWithTag(tag)
            raise failed[0].exception()
        return [f.result() for f in running]


def _as_caller(spark: SparkSession, job: Callable[[], object]) -> Callable[[], object]:
    inherit = inheritable_thread_target(spark)  # one copy of the properties per job
    return job if inherit is spark else inherit(job)
