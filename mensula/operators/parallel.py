"""Several independent pieces of Spark work at a time, from a bounded pool of driver threads."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Hashable, Mapping
from concurrent.futures import FIRST_EXCEPTION, CancelledError, ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

K, V = TypeVar("K", bound=Hashable), TypeVar("V")
AT_ONCE = 6


def at_once(spark: SparkSession, tasks: Mapping[K, Callable[[], V]], most: int = AT_ONCE) -> dict[K, V]:
    """Results of the tasks by name, at most `most` running together.

    Threads inherit the caller's local properties, so the jobs belong to the caller's job group, and each task has a scheduler
    pool of its own, which shares the executors fairly where `spark.scheduler.mode` is FAIR. When a task fails, tasks
    that have not begun are dropped, the jobs of the others are cancelled by their tag, and the first error is raised after all have
    ended; what a task had written by then stays.
    """
    if not tasks:
        return {}
    sc, tag, stop = spark.sparkContext, f"mensula-{uuid.uuid4().hex}", threading.Event()

    def run(number: int, task: Callable[[], V]) -> V:
        if stop.is_set():
            raise CancelledError
        sc.addJobTag(tag)
        sc.setLocalProperty("spark.scheduler.pool", f"{tag}-{number}")
        try:
            return task()
        except BaseException:
            stop.set()
            raise

    with ThreadPoolExecutor(min(most, len(tasks))) as pool:
        futures = {name: pool.submit(inheritable_thread_target(spark)(run), i, task) for i, (name, task) in enumerate(tasks.items())}
        done, running = wait(futures.values(), return_when=FIRST_EXCEPTION)
        failed = next((f for f in futures.values() if f in done and f.exception() and not isinstance(f.exception(), CancelledError)), None)
        if failed is not None:
            running = {f for f in running if not f.cancel()}
            while running:
                # A task that is between two jobs starts another one before it hears of it.
                sc.cancelJobsWithTag(tag)
                _, running = wait(running, timeout=0.2)
            raise failed.exception()
    return {name: f.result() for name, f in futures.items()}
