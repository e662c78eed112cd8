"""Independent tables of one layer, worked on at the same time."""

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item, Result = TypeVar("Item"), TypeVar("Result")


def side_by_side(
    spark: SparkSession, work: Callable[[Item], Result], items: Iterable[Item]
) -> list[Result]:
    """Submit the Spark jobs of all items together and give the results in order.

    Spark fills the slots a job leaves idle in its last tasks with the next one.
    Job descriptions and pools set by the caller apply.  If an item fails, the
    others finish and the first failure is raised.
    """
    items = list(items)
    with ThreadPoolExecutor(max_workers=max(1, len(items))) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(work), item) for item in items]
    return [job.result() for job in started]
