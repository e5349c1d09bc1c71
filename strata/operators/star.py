"""Star schema: category and price-bucket dimensions and the product fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.buckets import PRICE_BUCKETS, Bucket, bucketize
from strata.operators.joins import left_join_dim
from strata.operators.keys import dense_key, range_numbered
from strata.schemas import DIM_PRICE_BUCKET, FACT_ROWS, PRODUCT_KEY, ROW_PART, ROW_POS

CATEGORY_COLUMNS = ("main_category", "sub_category")


def dim_category(silver: DataFrame, *, num_partitions: int | None = None) -> DataFrame:
    """Distinct (main, sub) pairs with a non-NULL main category, keyed 1..n.

    Keys follow (main_category, sub_category) ascending, NULLs first.
    """
    return dense_key(_pairs(silver), CATEGORY_COLUMNS, "category_key", num_partitions=num_partitions).select(
        "category_key", *CATEGORY_COLUMNS)


def category_rows(silver: DataFrame, *, num_partitions: int | None = None, rows: int | None = None) -> DataFrame:
    """The rows of :func:`dim_category` to be written once and keyed on read
    (:func:`strata.operators.keys.numbered`)."""
    return range_numbered(_pairs(silver), CATEGORY_COLUMNS, ROW_PART, ROW_POS, num_partitions=num_partitions,
                          rows=rows)


def _pairs(silver: DataFrame) -> DataFrame:
    return silver.select(*CATEGORY_COLUMNS).distinct().where(F.col("main_category").isNotNull())


def dim_price_bucket(spark: SparkSession, buckets: Sequence[Bucket] = PRICE_BUCKETS) -> DataFrame:
    """The static bucket dimension (key, label, bounds)."""
    rows = [(b.key, b.label, float(b.min_value), float(b.max_value)) for b in buckets]
    return spark.createDataFrame(rows, DIM_PRICE_BUCKET)


def with_price_bucket(df: DataFrame, price: str = "actual_price",
                      buckets: Sequence[Bucket] = PRICE_BUCKETS) -> DataFrame:
    return df.withColumn("price_bucket", bucketize(price, buckets))


def attach_category_key(df: DataFrame, dim_cat: DataFrame, *, null_safe: bool = False,
                        rows_per_task: int | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Left join on (main, sub). With SQL ``=`` (the default, as in the source
    pipeline) a NULL sub-category never matches and gets a NULL key."""
    return left_join_dim(df, dim_cat.select("category_key", *CATEGORY_COLUMNS), CATEGORY_COLUMNS,
                         null_safe=null_safe, rows_per_task=rows_per_task, counts=counts)


def attach_price_bucket_key(df: DataFrame, dim_pb: DataFrame) -> DataFrame:
    """Left join of the bucket label onto the dimension's label."""
    return left_join_dim(df, dim_pb.select("bucket_label", "price_bucket_key"), ["price_bucket"],
                         ["bucket_label"])


def enrich(silver: DataFrame, dim_cat: DataFrame, dim_pb: DataFrame, *, null_safe_category: bool = False,
           rows_per_task: int | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Valid silver rows with category key, bucket label and bucket key.
    ``rows_per_task`` and ``counts`` as in :func:`left_join_dim`, for categories."""
    out = attach_category_key(silver.where(F.col("is_valid")), dim_cat, null_safe=null_safe_category,
                              rows_per_task=rows_per_task, counts=counts)
    return attach_price_bucket_key(with_price_bucket(out), dim_pb)


def fact_rows(enriched: DataFrame, *, order: Sequence[str] = PRODUCT_KEY,
              num_partitions: int | None = None, rows: int | None = None) -> DataFrame:
    """Fact rows in range partitions of ``order`` (name, then category, NULLs
    first), numbered within them: to be written once and keyed on read
    (:func:`strata.operators.keys.numbered`). Only the fact's columns and the
    order columns are shuffled."""
    needed = [f.name for f in FACT_ROWS.fields if f.name not in (ROW_PART, ROW_POS)]
    narrow = enriched.select(*needed, *[c for c in order if c not in needed])
    return range_numbered(narrow, order, ROW_PART, ROW_POS, num_partitions=num_partitions,
                          rows=rows).select(*FACT_ROWS.fieldNames())
