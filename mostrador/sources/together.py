"""Independent jobs of one session, several at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

AT_ONCE = 4
POOL = "spark.scheduler.pool"
Item, Result = TypeVar("Item"), TypeVar("Result")


def together(
    spark: SparkSession,
    work: Callable[[Item], Result],
    items: Iterable[Item],
    at_once: int = AT_ONCE,
) -> list[Result]:
    """The results of ``work`` for each item, in order, at most ``at_once`` jobs running.

    Every item has a scheduler pool of its own: under Spark's fair scheduling the jobs share
    the cores evenly, under the default one later jobs fill the cores that earlier ones
    leave. Job groups, tags and other local properties of the caller hold for all of them.
    """
    if at_once < 1:
        raise ValueError("at least one job has to run")

    def alone(numbered: tuple[int, Item]) -> Result:
        spark.sparkContext.setLocalProperty(POOL, f"mostrador-{numbered[0] % at_once}")
        return work(numbered[1])

    with ThreadPoolExecutor(at_once) as threads:
        # each call gets the caller's properties anew, whichever thread it runs on
        calls = [(inheritable_thread_target(spark)(alone), numbered) for numbered in enumerate(items)]
        return list(threads.map(lambda call: call[0](call[1]), calls))
