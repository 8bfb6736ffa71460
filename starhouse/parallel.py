"""How work is dealt out: independent jobs side by side, and a table over as many tasks as its rows need."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

#: Rows that one task sorts or groups, about.
ROWS_A_TASK = 500_000


def run_together(spark: SparkSession, actions: Sequence[Callable[[], object]]) -> None:
    """Run every action; the first failure is raised once all of them have ended."""
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        # Job groups and other thread-local settings of the caller apply to every job.
        futures = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
    for future in futures:
        future.result()


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` by hash of ``keys`` over one task for each ``ROWS_A_TASK`` of ``rows``.

    What a task holds then stays the same as tables grow, whatever ``spark.sql.shuffle.partitions``
    says and adaptive execution merges. Where the session's cores are as many as these tasks,
    Spark deals as it does.
    """
    tasks = -(-rows // ROWS_A_TASK)
    if tasks <= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(tasks, *keys)
