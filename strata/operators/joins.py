"""Dimension joins.

No side is broadcast by hint for its size: Spark picks the strategy from byte
sizes, and adaptive execution corrects it (and splits skewed partitions) from
what it measures. Where a key is known to be hot, ``rows_per_task`` takes its
rows out of the shuffle:

* the fact's key frequencies are counted once (or handed in, where they are
  known) and kept: keys with more than ``rows_per_task`` rows are hot;
* hot keys are few, at most rows / ``rows_per_task`` and never more than
  ``HOT_KEYS``, so they and their dimension rows are broadcast: the fact's hot
  rows meet them where they are read and are not shuffled;
* every other row is joined as is.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.names import unused_names
from strata.sources.checkpoints import checkpoint_root

#: At most so many keys are hot: the bound of what is broadcast for them.
HOT_KEYS = 100_000


def key_hash(keys: Sequence[str]) -> Column:
    """A 64-bit hash of the key values, NULL parts included (NULL-safe equal keys hash equal)."""
    parts = []
    for k in keys:
        parts += [F.col(f"`{k}`"), F.col(f"`{k}`").isNull()]
    return F.xxhash64(*parts)


def key_counts(fact: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    """(keys..., ``count``): the rows of each key, NULL parts compared as equal."""
    return fact.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(count))


def hot_keys(counts: DataFrame, rows_per_task: int, count: str = "n", most: int = HOT_KEYS) -> DataFrame:
    """Those of ``counts`` with more than ``rows_per_task`` rows. If that were more
    than ``most`` keys, only those above the hot keys' rows / ``most``, which are
    fewer than ``most``."""
    return _hot(counts, rows_per_task, count, most)[0]


def _hot(counts: DataFrame, rows_per_task: int, count: str = "n", most: int = HOT_KEYS) -> tuple[DataFrame, int]:
    hot = counts.where(F.col(f"`{count}`") > F.lit(rows_per_task))
    keys, rows = hot.agg(F.count(F.lit(1)), F.sum(f"`{count}`")).first()
    return (hot if keys <= most else hot.where(F.col(f"`{count}`") > F.lit(rows // most))), keys


def left_join_dim(fact: DataFrame, dim: DataFrame, left_keys: Sequence[str],
                  right_keys: Sequence[str] | None = None, *, null_safe: bool = False,
                  rows_per_task: int | None = None, counts: DataFrame | None = None) -> DataFrame:
    """``fact LEFT JOIN dim``; the dimension's key columns are dropped.

    ``dim`` must be unique on its keys (one match at most, so no fan-out).
    ``rows_per_task`` keeps keys that hold more fact rows than that out of the
    shuffle. ``counts`` are the fact's :func:`key_counts` (columns ``left_keys``
    and ``n``), a table or checkpoint, where they are known; without, they are
    counted and the hot ones checkpointed here.
    """
    left_keys = list(left_keys)
    right_keys = list(right_keys or left_keys)
    payload = [c for c in dim.columns if c not in right_keys]
    packed, mark = unused_names(2, fact, dim)
    d = dim.select(F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(right_keys)]).alias(packed),
                   *[F.col(f"`{c}`") for c in payload])

    def on(left: DataFrame, right: DataFrame, safe: bool) -> Column:
        pairs = [(left[f"`{k}`"], right[packed][f"k{i}"]) for i, k in enumerate(left_keys)]
        return functools.reduce(lambda a, b: a & b, [x.eqNullSafe(y) if safe else x == y for x, y in pairs])

    if rows_per_task is None:
        return fact.join(d, on(fact, d, null_safe), "left").drop(packed)
    if counts is None:
        checkpoint_root(fact.sparkSession)
        counts = key_counts(fact, left_keys).where(F.col("n") > rows_per_task).checkpoint(eager=True)
    hot, number = _hot(counts, rows_per_task)
    if not number:
        return fact.join(d, on(fact, d, null_safe), "left").drop(packed)
    hot = F.broadcast(hot.select(
        F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(left_keys)]).alias(packed)))
    hot_dim = d.withColumnRenamed(packed, mark)
    hot_dim = hot_dim.join(hot, hot_dim[mark].eqNullSafe(hot[packed]), "left_semi").withColumnRenamed(mark, packed)
    among = fact.join(hot, on(fact, hot, True), "left_semi")
    rest = fact.join(hot, on(fact, hot, True), "left_anti")
    return (among.join(F.broadcast(hot_dim), on(among, hot_dim, null_safe), "left")
            .unionByName(rest.join(d, on(rest, d, null_safe), "left")).drop(packed))
