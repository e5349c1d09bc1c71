"""Declared table schemas and the schema-enforcing projection.

Every layer table has a fixed schema. Writers call :func:`enforce_schema`
so a frame with a missing or unexpected column fails before anything is
written, and every column is cast to its declared type.

Fixed values: the table and column names and types below are those of the
source pipeline's tables (plus ``batch_rows`` in the audit log and the silver
key hash, both ours).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


from strata.functions.names import quoted


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


S, D, L, B = StringType(), DoubleType(), LongType(), BooleanType()

# Columns every product source is mapped onto (all text at this point).
SOURCE_COLUMNS = (
    "name",
    "main_category",
    "sub_category",
    "image",
    "link",
    "ratings",
    "no_of_ratings",
    "discount_price",
    "actual_price",
)
NUMERIC_COLUMNS = ("ratings", "no_of_ratings", "discount_price", "actual_price")
PRODUCT_KEY = ("name", "main_category", "sub_category")

RAW_SOURCE = _schema(*[(c, S) for c in SOURCE_COLUMNS])

BRONZE = _schema(
    *[(c, S) for c in SOURCE_COLUMNS],
    ("source_file", S),
    ("batch_id", S),
    ("ingestion_date", DateType()),
)

# A malformed source line, whole; NULL in rows of well-formed lines.
RAW_LINE = "raw_line"

_STAGED_HEAD = (
    ("name", S),
    ("main_category", S),
    ("sub_category", S),
    ("image", S),
    ("link", S),
    ("ratings", D),
    ("no_of_ratings", D),
    ("discount_price", D),
    ("actual_price", D),
    ("discount_amount", D),
    ("discount_pct", D),
    ("is_valid", B),
)
_LINEAGE = (("source_file", S), ("batch_id", S), ("ingestion_date", TimestampType()))

STAGING = _schema(*_STAGED_HEAD, ("validation_errors", S), *_LINEAGE)
SILVER = _schema(*_STAGED_HEAD, *_LINEAGE)
# Silver as stored: plus a hash of the product key, the bucket column of the
# table, so merges read it bucket by bucket instead of shuffling it.
KEY_HASH = "_key_hash"
SILVER_STORED = _schema(*_STAGED_HEAD, *_LINEAGE, (KEY_HASH, L))
# The part of the table that a row is in, from its main category.
PART = "_part"
SILVER_PARTED = _schema(*_STAGED_HEAD, *_LINEAGE, (KEY_HASH, L), (PART, IntegerType()))

DIM_CATEGORY = _schema(("category_key", L), ("main_category", S), ("sub_category", S))
DIM_PRICE_BUCKET = _schema(
    ("price_bucket_key", L), ("bucket_label", S), ("min_price", D), ("max_price", D)
)
FACT_PRODUCT_METRICS = _schema(
    ("product_key", L),
    ("name", S),
    ("category_key", L),
    ("price_bucket_key", L),
    ("ratings", D),
    ("no_of_ratings", D),
    ("discount_price", D),
    ("actual_price", D),
    ("discount_pct", D),
    ("is_valid", B),
)
# Tables with a dense key as written: numbered within their range partitions, keyed on read.
ROW_PART, ROW_POS = "_part", "_pos"
_NUMBERS = [StructField(ROW_PART, IntegerType()), StructField(ROW_POS, L)]
DIM_CATEGORY_ROWS = StructType([*DIM_CATEGORY.fields[1:], *_NUMBERS])
FACT_ROWS = StructType([*FACT_PRODUCT_METRICS.fields[1:], *_NUMBERS])
# Counts and sums that the gold summaries and the category dimension come from.
SUMMED_COLUMNS = ("ratings", "discount_price", "actual_price", "discount_pct")
GOLD_ROLLUP = _schema(
    ("main_category", S), ("sub_category", S), ("price_bucket", S), ("n", L), ("odd", L),
    *[field for c in SUMMED_COLUMNS for field in ((f"{c}_n", L), (f"{c}_sum", DecimalType(38, 10)))],
)
# What one merge changes of them, and of silver's NULL counts.
GOLD_DELTA = StructType([*GOLD_ROLLUP.fields, *[StructField(f"nulls_{i}", L) for i in range(len(SILVER.fields))]])
AGG_CATEGORY_SUMMARY = _schema(
    ("main_category", S),
    ("product_count", L),
    ("avg_rating", D),
    ("avg_discount_price", D),
    ("avg_actual_price", D),
    ("avg_discount_pct", D),
)
AGG_PRICE_BUCKET_SUMMARY = _schema(
    ("price_bucket", S), ("product_count", L), ("avg_rating", D), ("avg_discount_pct", D)
)
DEAD_LETTER = _schema(
    *[(c, S) for c in SOURCE_COLUMNS],
    ("validation_errors", S),
    ("batch_id", S),
    ("failed_at", TimestampType()),
)
# Columns that cleaning changes, kept as received under this prefix on request.
RAW_PREFIX = "raw_"
CHANGED_COLUMNS = ("name", "main_category", "sub_category", *NUMERIC_COLUMNS)
_RAW = [StructField(RAW_PREFIX + c, S, True) for c in CHANGED_COLUMNS]
STAGING_RAW = StructType([*STAGING.fields, *_RAW])
DEAD_LETTER_RAW = StructType([*DEAD_LETTER.fields, *_RAW])
RAW_COLUMNS = frozenset([*[f.name for f in _RAW], RAW_LINE])
# As stored: with the text received and malformed lines, NULL where not kept.
_LINE = StructField(RAW_LINE, S, True)
BRONZE_STORED = StructType([*BRONZE.fields, _LINE])
STAGING_STORED = StructType([*STAGING_RAW.fields, _LINE])
DEAD_LETTER_STORED = StructType([*DEAD_LETTER_RAW.fields, _LINE])
CHECKPOINTS = _schema(
    ("batch_id", S),
    ("layer_name", S),
    ("status", S),
    ("record_count", L),
    ("executed_at", TimestampType()),
    ("error_message", S),
    ("batch_rows", L),
)
RUN_SUMMARY = _schema(
    ("batch_id", S),
    ("executed_at", TimestampType()),
    ("bronze_rows", L),
    ("silver_rows", L),
    ("valid_rows", L),
    ("invalid_rows", L),
    ("dead_lettered_rows", L),
    ("fact_rows", L),
    ("overall_status", S),
)

TABLES: dict[str, StructType] = {
    "bronze": BRONZE,
    "staging": STAGING,
    "silver": SILVER,
    "dim_category": DIM_CATEGORY,
    "dim_price_bucket": DIM_PRICE_BUCKET,
    "fact_product_metrics": FACT_PRODUCT_METRICS,
    "agg_category_summary": AGG_CATEGORY_SUMMARY,
    "agg_price_bucket_summary": AGG_PRICE_BUCKET_SUMMARY,
    "dead_letter": DEAD_LETTER,
    "checkpoints": CHECKPOINTS,
}


class SchemaMismatch(ValueError):
    """Raised when a frame does not carry exactly the declared columns."""


def typed_null(dtype) -> Column:
    return F.lit(None).cast(dtype)


def enforce_schema(df: DataFrame, schema: StructType, *, allow_extra: bool = False) -> DataFrame:
    """Project ``df`` onto ``schema``: declared order, declared types.

    Missing columns always fail. Extra columns fail unless ``allow_extra``,
    in which case they are dropped. Casts are ANSI casts, so a value that
    cannot be represented raises instead of silently turning into NULL.
    """
    have = {c.lower(): c for c in df.columns}
    want = [f.name for f in schema.fields]
    missing = [c for c in want if c.lower() not in have]
    extra = sorted(set(have) - {c.lower() for c in want})
    if missing or (extra and not allow_extra):
        raise SchemaMismatch(f"missing columns {missing}, unexpected columns {extra}")
    if [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in schema.fields]:
        return df
    current = dict((f.name.lower(), f.dataType) for f in df.schema.fields)
    return df.selectExpr(*[
        f"{quoted(have[f.name.lower()])} AS {quoted(f.name)}" if current[f.name.lower()] == f.dataType
        else f"CAST({quoted(have[f.name.lower()])} AS {f.dataType.simpleString()}) AS {quoted(f.name)}"
        for f in schema.fields
    ])
