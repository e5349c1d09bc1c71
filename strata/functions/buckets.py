"""Labelled value ranges: the price-bucket ladder and its dimension rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bucket:
    key: int
    label: str
    min_value: float
    max_value: float


# The price buckets of the source pipeline. Lower bounds are
# inclusive; the ladder tests the upper bound of each bucket in order and
# everything else (including NULL and NaN) falls into the last one.
PRICE_BUCKETS: tuple[Bucket, ...] = (
    Bucket(1, "Budget", 0.0, 500.0),
    Bucket(2, "Mid-Range", 500.0, 2000.0),
    Bucket(3, "Premium", 2000.0, 10000.0),
    Bucket(4, "Luxury", 10000.0, 999999.0),
)


def bucketize(col: Column | str, buckets: Sequence[Bucket] = PRICE_BUCKETS) -> Column:
    """``CASE WHEN c < max1 THEN label1 WHEN c < max2 ... ELSE last`` label."""
    c = F.col(col) if isinstance(col, str) else col
    *ladder, last = buckets
    if not ladder:
        return F.lit(last.label)
    expr = F.when(c < F.lit(ladder[0].max_value), F.lit(ladder[0].label))
    for b in ladder[1:]:
        expr = expr.when(c < F.lit(b.max_value), F.lit(b.label))
    return expr.otherwise(F.lit(last.label))
