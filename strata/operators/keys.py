"""Dense surrogate keys 1..n in a global order, without a single-partition window.

``row_number() OVER (ORDER BY ...)`` with no partitioning moves every row
into one task. ``dense_key`` gives the same numbering in parallel:

1. range-partition the rows on the order columns. Spark's range partitioner
   samples the bounds. A row hash and a row sequence number end the sort key,
   so even a long run of equal order values, or of identical rows, splits
   across partitions;
2. sort each partition and number its rows locally (partition id plus a
   position that grows inside the partition);
3. checkpoint that result to ``spark.checkpoint.dir``. The per-partition row
   counts and the final numbering both read the same checkpointed rows, so
   they always agree. Two independent range shuffles could sample different
   bounds;
4. add the number of rows in all earlier partitions. The per-partition
   counts are one row per partition, a size fixed by the partition count,
   so that small table is broadcast.

Rows that are written to a table anyway need no checkpoint: ``range_numbered``
gives the rows of step 2 to write, and ``numbered`` does step 4 on read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.names import unused_names
from strata.sources.checkpoints import checkpoint_root

# Range partitions are sized so none holds much more than this many rows, and
# where the number of rows is known, so that none is made for far fewer.
ROWS_PER_PARTITION = 2_000_000
LEAST_ROWS_PER_PARTITION = 50_000
_ROW_BITS = 33  # monotonically_increasing_id keeps the in-partition position in the low 33 bits


def _sort_exprs(order: Sequence[str]) -> list[Column]:
    return [F.asc_nulls_first(f"`{c}`") for c in order]


def dense_key(df: DataFrame, order: Sequence[str], key: str = "key", *,
              num_partitions: int | None = None, rows: int | None = None, start: int = 1,
              rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """``df`` plus ``key`` (LONG): ``start..`` in ascending ``order``, NULLs first.

    Equal to ``row_number() OVER (ORDER BY order ASC NULLS FIRST)``; rows tied
    on ``order`` are ordered by a row hash (tied rows that are identical get
    interchangeable keys). Every column of ``df`` is shuffled and checkpointed,
    so pass a narrow frame. ``num_partitions`` defaults to
    ``spark.sql.shuffle.partitions``. Where the caller knows the number of
    ``rows`` it is raised, so that no range partition holds much more than
    ``rows_per_partition`` of them, and lowered where there are few.
    """
    spark = df.sparkSession
    cols = [F.col(f"`{c}`") for c in df.columns]
    part, pos, before = unused_names(3, df)
    checkpoint_root(spark)  # make sure a checkpoint directory is set
    fixed = range_numbered(df, order, part, pos, num_partitions=num_partitions, rows=rows,
                           rows_per_partition=rows_per_partition).checkpoint(eager=True)
    offsets = _offsets(fixed, part, before)
    return fixed.join(F.broadcast(offsets), part).select(
        *cols, (F.col(before) + F.col(pos) + F.lit(start)).cast("long").alias(key))


def range_numbered(df: DataFrame, order: Sequence[str], part: str, pos: str, *,
                   num_partitions: int | None = None, rows: int | None = None,
                   rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """``df`` in range partitions of ``order``, each sorted, plus ``part`` (INT, the
    partition) and ``pos`` (LONG, the place in it from 0). Written once, its
    numbers are fixed; :func:`numbered` turns them into keys on read."""
    sort = _sort_exprs(order)
    cols = [F.col(f"`{c}`") for c in df.columns]
    tie, seq = unused_names(2, df)
    n = num_partitions or _partitions(df.sparkSession, rows, rows_per_partition)
    place = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), _ROW_BITS)
    return (
        df.select(*cols, F.xxhash64(*cols).alias(tie), F.monotonically_increasing_id().alias(seq))
        .repartitionByRange(n, *sort, F.col(tie), F.col(seq))
        .sortWithinPartitions(*sort, F.col(tie), F.col(seq))
        .select(*cols, F.spark_partition_id().alias(part), place.alias(pos))
    )


def _partitions(spark: SparkSession, rows: int | None, rows_per_partition: int) -> int:
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if rows is None:
        return default
    least = min(LEAST_ROWS_PER_PARTITION, rows_per_partition)
    return max(1, -(-rows // rows_per_partition), min(default, -(-rows // least)))


def numbered(table: str, part: str, pos: str, key: str, columns: Sequence[str], start: int = 1) -> str:
    """SQL that reads a table of :func:`range_numbered` rows with their dense key.
    The rows of each partition are counted from the table itself, one row per
    partition, so only that many are broadcast."""
    cols = ", ".join(f"r.`{c}`" for c in columns)
    return f"""
SELECT /*+ BROADCAST(o) */ CAST(o.`before` + r.`{pos}` + {start} AS BIGINT) AS `{key}`, {cols}
FROM {table} r JOIN (
  SELECT `{part}`, coalesce(sum(n) OVER (ORDER BY `{part}` ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS `before`
  FROM (SELECT `{part}`, count(*) AS n FROM {table} GROUP BY `{part}`)
) o ON r.`{part}` = o.`{part}`"""


def _offsets(rows: DataFrame, part: str, before: str) -> DataFrame:
    """(part, rows of all earlier parts), one row per part."""
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(part).agg(F.count(F.lit(1)).alias(before))
    return counts.select(part, F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before))
