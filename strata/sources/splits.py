"""More and smaller tasks while layers are built."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Tasks per core that files and shuffles are split into, where they are large enough.
TASKS_PER_CORE = 4
#: By default Spark makes one task a core of these, and the rest of the division is
#: one or two tasks more, for which all other cores wait.
LEAST_TASKS = ("spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.minPartitionNum")


@contextmanager
def fine_tasks(spark: SparkSession, per_core: int = TASKS_PER_CORE) -> Iterator[None]:
    """Plan reads and shuffles with ``per_core`` tasks a core at least. Spark's own
    least sizes (``openCostInBytes``, ``minPartitionSize``) hold, so small inputs
    stay whole; a session's own settings are left alone, and the others are unset
    at the end."""
    least = per_core * spark.sparkContext.defaultParallelism
    ours = [name for name in LEAST_TASKS if spark.conf.get(name, None) is None]
    for name in ours:
        spark.conf.set(name, least)
    try:
        yield
    finally:
        for name in ours:
            spark.conf.unset(name)
