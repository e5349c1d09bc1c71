"""Catalog/wide-table sources mapped onto the product columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import SOURCE_COLUMNS

# How the wide scraped-listing table maps onto product columns
# in the source pipeline (target column -> source column). Targets that are
# not listed (main_category, sub_category, image, link) become NULL.
LISTING_COLUMN_MAP: dict[str, str] = {
    "name": "title",
    "ratings": "rating_stars",
    "no_of_ratings": "rating_count",
    "discount_price": "price_value",
    "actual_price": "list_price",
}


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table by name."""
    return spark.read.table(name)


def map_columns(df: DataFrame, mapping: Mapping[str, str],
                targets: Sequence[str] = SOURCE_COLUMNS) -> DataFrame:
    """One projection onto ``targets`` as text.

    A target takes its mapped source column (cast to string) when the frame
    has it, otherwise a typed NULL. The decision is made on the schema at
    plan time, so a source missing optional columns still loads.
    """
    present = {c.lower(): c for c in df.columns}
    cols = []
    for target in targets:
        source = mapping.get(target)
        if source is not None and source.lower() in present:
            cols.append(F.col(f"`{present[source.lower()]}`").cast("string").alias(target))
        else:
            cols.append(F.lit(None).cast("string").alias(target))
    return df.select(*cols)
