"""Independent steps at the same time, so that a small table does not wait for a large one."""

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

Result = TypeVar("Result")


def together(spark: SparkSession, steps: Iterable[Callable[[], Result]]) -> list[Result]:
    """Results of the steps, in their order; waits for all of them, then raises the first failure if there is one."""
    steps = [inheritable_thread_target(spark)(step) for step in steps]
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(step) for step in steps]
    return [step.result() for step in running]
