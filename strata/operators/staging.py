"""Clean -> derive -> validate: bronze text rows become typed staged rows.

All three are single projections (no shuffle, no action) and work unchanged
on streaming frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.cleaning import clean_label, clean_text, to_double, to_price
from strata.functions.rules import MALFORMED_LINE, PRODUCT_RULES, Rule, error_text
from strata.schemas import CHANGED_COLUMNS, RAW_LINE, RAW_PREFIX, STAGING, STAGING_RAW


def clean(bronze: DataFrame, *, keep_raw: bool = False) -> DataFrame:
    """Trim text, lower-case categories, safely cast the numeric text.

    With ``keep_raw`` the original text of every column changed here is kept
    as ``raw_<column>`` so quarantine can show what was actually received.
    """
    cols = [
        clean_text("name").alias("name"),
        clean_label("main_category").alias("main_category"),
        clean_label("sub_category").alias("sub_category"),
        F.col("image"),
        F.col("link"),
        to_double("ratings").alias("ratings"),
        to_double("no_of_ratings").alias("no_of_ratings"),
        to_price("discount_price").alias("discount_price"),
        to_price("actual_price").alias("actual_price"),
        F.col("source_file"),
        F.col("batch_id"),
        F.col("ingestion_date").cast("timestamp").alias("ingestion_date"),
    ]
    if keep_raw:
        cols += [F.col(c).alias(RAW_PREFIX + c) for c in CHANGED_COLUMNS]
    if RAW_LINE in bronze.columns:
        cols.append(F.col(RAW_LINE))
    return bronze.select(*cols)


def derive(df: DataFrame) -> DataFrame:
    """Add ``discount_amount`` and ``discount_pct`` (2 decimals, HALF_UP).

    Both are NULL when a price is NULL; the percentage is also NULL when the
    actual price is not positive. A discount above the actual price gives a
    negative amount and percentage.
    """
    actual, disc = F.col("actual_price"), F.col("discount_price")
    both = actual.isNotNull() & disc.isNotNull()
    return df.withColumns({
        "discount_amount": F.when(both, F.round(actual - disc, 2)),
        "discount_pct": F.when(both & (actual > 0), F.round((actual - disc) / actual * 100, 2)),
    })


def validate(df: DataFrame, rules: Sequence[Rule] = PRODUCT_RULES) -> DataFrame:
    """Add ``validation_errors`` (every failed rule's message) and ``is_valid``. Of
    a malformed source line (``raw_line`` given) only that is said."""
    errors = error_text(rules)
    if RAW_LINE in df.columns:
        errors = F.when(F.col(RAW_LINE).isNotNull(), F.lit(MALFORMED_LINE)).otherwise(errors)
    return df.withColumn("validation_errors", errors).withColumn(
        "is_valid", F.col("validation_errors") == F.lit(""))


def stage(bronze: DataFrame, rules: Sequence[Rule] = PRODUCT_RULES, *,
          keep_raw: bool = False) -> DataFrame:
    """The staging projection in declared column order, ``raw_line`` last where the
    bronze rows have one."""
    out = validate(derive(clean(bronze, keep_raw=keep_raw)), rules)
    line = [RAW_LINE] if RAW_LINE in bronze.columns else []
    return out.select(*(STAGING_RAW if keep_raw else STAGING).fieldNames(), *line)


def split_valid(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows). ``is_valid`` is never NULL."""
    return staged.where(F.col("is_valid")), staged.where(~F.col("is_valid"))
