"""Jobs that don't wait for one another."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def at_once(spark: SparkSession, *steps: Callable) -> list:
    """The results of steps that each run jobs of their own, side by side, with the caller's job group and local properties.

    The first error is raised when all have ended.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [r.result() for r in running]
