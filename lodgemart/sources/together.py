"""Independent jobs at the same time."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def side_by_side(jobs: Sequence[Callable[[], Any]], parallel: int) -> list[Any]:
    """Results of ``jobs`` in order, up to ``parallel`` submitted to Spark at a time.

    While the last tasks of one job run, the next job already uses the free executors.
    A failing job raises here once the others have ended.
    """
    in_session = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max(1, parallel)) as pool:
        running = [pool.submit(in_session(job)) for job in jobs]
        return [future.result() for future in running]
