"""Keyed de-duplication with a deterministic survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.names import unused_names

# Survivor order for products: the listing with most ratings wins, then the
# higher rating, then the cheaper prices; the other columns break what is left.
PRODUCT_SURVIVOR_ORDER = (
    ("no_of_ratings", "desc"),
    ("ratings", "desc"),
    ("discount_price", "asc"),
    ("actual_price", "asc"),
)

OrderItem = Column | str | tuple[str, str]


def sort_column(item: OrderItem) -> Column:
    """A sort expression from a Column, a name (ascending) or ``(name, "asc"|"desc")``.

    Ascending puts NULLs first and descending puts them last (Spark's defaults).
    """
    if isinstance(item, Column):
        return item
    name, direction = (item, "asc") if isinstance(item, str) else item
    if direction == "asc":
        return F.asc_nulls_first(f"`{name}`")
    if direction == "desc":
        return F.desc_nulls_last(f"`{name}`")
    raise ValueError(f"unknown sort direction {direction!r}")


def dedup_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[OrderItem] = (), *,
                 total_order: bool = True) -> DataFrame:
    """Keep exactly one row per key (NULL key parts compare equal).

    The survivor is the first row in ``order``; with ``total_order`` every
    remaining column is appended (ascending, NULLs first) so the choice never
    depends on data placement. Spark plans ``row_number() == 1`` with a partial
    window group limit before the shuffle, so each map task forwards at most
    one row per key: a hot key costs one row per map task, not its row count.
    """
    by_name = {o if isinstance(o, str) else o[0] for o in order if not isinstance(o, Column)}
    order = [sort_column(o) for o in order]
    if total_order:
        named = {str(c) for c in keys} | by_name
        order += [F.asc_nulls_first(f"`{c}`") for c in df.columns if c not in named]
    if not order:
        order = [F.asc_nulls_first(f"`{keys[0]}`")]
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    (place,) = unused_names(1, df)
    return df.withColumn(place, F.row_number().over(w)).where(F.col(place) == 1).drop(place)
