"""Named queries over the supplied test tables, one per operator family.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the whole supplied tables (through :mod:`strata.plans.testdata`). Computed
columns carry the same names as in the oracle SQL of
:mod:`strata.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.operators.dedup import PRODUCT_SURVIVOR_ORDER, dedup_by_key
from strata.operators.keys import dense_key
from strata.operators.merge import upsert
from strata.operators.quality import describe_layer, distinct_count, layer_counts, quality_report, sample_rows
from strata.operators.quarantine import dead_letter_review, dead_letter_summary
from strata.operators.staging import clean, derive, split_valid, stage
from strata.operators.star import attach_category_key, attach_price_bucket_key, with_price_bucket
from strata.plans.layers import SILVER_UPDATE_COLUMNS, RunParams, bronze_frame
from strata.plans.runner import RUN_SUMMARY, latest_checkpoints
from strata.plans.tables import describe_tables, silver_layout
from strata.plans.testdata import FULL_AS_OF, FULL_BATCH_ID, LISTINGS_LABEL, testdata_runs
from strata.sources.files import read_csv_source
from strata.sources.lineage import with_lineage
from strata.sources.tables import LISTING_COLUMN_MAP, map_columns, read_table

Query = Callable[[SparkSession, str], DataFrame]

LISTINGS_VIEW = "strata_listings"
SILVER_COLUMNS = [f.name for f in schemas.SILVER.fields]


def _full(spark: SparkSession, sf_dir: str):
    runs = testdata_runs(spark, sf_dir)
    runs.full()
    return runs, runs.full_store


def _history(spark: SparkSession, sf_dir: str):
    runs = testdata_runs(spark, sf_dir)
    runs.history()
    return runs, runs.history_store


def _valid_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, store = _full(spark, sf_dir)
    return store.read("silver", schema=schemas.SILVER).where(F.col("is_valid"))


# -- sources and bronze -------------------------------------------------------
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files with different column orders, one with an extra column."""
    return read_csv_source(spark, testdata_runs(spark, sf_dir).products_csv_split())


def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    testdata_runs(spark, sf_dir).listings().createOrReplaceTempView(LISTINGS_VIEW)
    return read_table(spark, LISTINGS_VIEW)


def bronze_map_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings = testdata_runs(spark, sf_dir).listings()
    return with_lineage(map_columns(listings, LISTING_COLUMN_MAP), LISTINGS_LABEL, FULL_BATCH_ID,
                        FULL_AS_OF)


def bronze_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = testdata_runs(spark, sf_dir).sources("all")
    return bronze_frame(sources, RunParams(FULL_BATCH_ID, FULL_AS_OF)).select(*schemas.BRONZE.fieldNames())


def write_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after two runs: the second batch replaced the first (published read back)."""
    _, store = _history(spark, sf_dir)
    return store.read("bronze", schema=schemas.BRONZE)


# -- silver ----------------------------------------------------------------------
def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full(spark, sf_dir)[1].read("bronze", schema=schemas.BRONZE)


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full(spark, sf_dir)[1].read("staging", schema=schemas.STAGING)


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(_bronze(spark, sf_dir))


def silver_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(clean(_bronze(spark, sf_dir)))


def silver_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(_bronze(spark, sf_dir))


def valid_invalid_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of the split, named."""
    valid, invalid = split_valid(_staged(spark, sf_dir))
    return valid.withColumn("side", F.lit("valid")).unionByName(invalid.withColumn("side", F.lit("invalid")))


def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full(spark, sf_dir)[1].read("dead_letter", schema=schemas.DEAD_LETTER)


def dead_letter_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine of both batches, with every changed column as it was received."""
    _, store = _history(spark, sf_dir)
    return store.read("dead_letter", schema=schemas.DEAD_LETTER_RAW)


def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each row of a file with malformed lines went: those lines whole to the
    quarantine, with the reason; of the others the name, to silver or quarantine."""
    runs = testdata_runs(spark, sf_dir)
    runs.faulty()
    store = runs.faulty_store
    dead = store.read("dead_letter").select(F.lit("dead_letter").alias("layer"), "name", "raw_line", "validation_errors")
    return dead.unionByName(store.read("silver").select(
        F.lit("silver").alias("layer"), "name", F.lit(None).cast("string").alias("raw_line"),
        F.lit("").alias("validation_errors")))


def dead_letter_review_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dead_letter_review(dead_letter(spark, sf_dir))


def quality_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(_staged(spark, sf_dir))


def distinct_category_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_count(_staged(spark, sf_dir), ["main_category", "sub_category"])


def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = split_valid(_staged(spark, sf_dir))[0].select(*SILVER_COLUMNS)
    return dedup_by_key(valid, schemas.PRODUCT_KEY, PRODUCT_SURVIVOR_ORDER)


def dead_letter_summary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dead_letter_summary(dead_letter(spark, sf_dir))


def dead_letter_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review preview: 10 quarantined rows, first in a total order over all columns."""
    dead = dead_letter(spark, sf_dir)
    return sample_rows(dead, 10, [F.asc_nulls_first(c) for c in dead.columns])


def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, store = _history(spark, sf_dir)
    return store.read("silver", schema=schemas.SILVER)


def silver_upsert_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the second batch again to the merged table: nothing changes."""
    _, store = _history(spark, sf_dir)
    merged = store.read(silver_layout(store).table, schema=schemas.SILVER_STORED)
    batch = store.read("silver_batch", schema=schemas.SILVER_STORED)
    again = upsert(merged, batch, schemas.PRODUCT_KEY, SILVER_UPDATE_COLUMNS,
                   hash_column=schemas.KEY_HASH)
    return again.select(*SILVER_COLUMNS)


def table_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and its quarantine, as a SQL user reads them: by their catalog names."""
    _, store = _full(spark, sf_dir)
    return spark.sql(f"""
        SELECT 'silver' AS layer, name, main_category, batch_id FROM {store.database}.silver
        UNION ALL SELECT 'dead_letter', name, main_category, batch_id FROM {store.database}.dead_letter""")


# -- gold ------------------------------------------------------------------------
def dim_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full(spark, sf_dir)[1].read("dim_category", schema=schemas.DIM_CATEGORY)


def price_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_price_bucket(_valid_silver(spark, sf_dir)).select(
        "name", "main_category", "sub_category", "actual_price", "price_bucket")


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow = _valid_silver(spark, sf_dir).select(*schemas.PRODUCT_KEY)
    return dense_key(narrow, schemas.PRODUCT_KEY, "product_key").select("product_key", *schemas.PRODUCT_KEY)


def fact_join_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, store = _full(spark, sf_dir)
    dim = store.read("dim_category", schema=schemas.DIM_CATEGORY)
    return attach_category_key(_valid_silver(spark, sf_dir), dim)


def fact_join_category_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join with hot categories (of more than 50 rows) kept out of the shuffle."""
    _, store = _full(spark, sf_dir)
    dim = store.read("dim_category", schema=schemas.DIM_CATEGORY)
    return attach_category_key(_valid_silver(spark, sf_dir), dim, rows_per_task=50)


def fact_join_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, store = _full(spark, sf_dir)
    dim = store.read("dim_price_bucket", schema=schemas.DIM_PRICE_BUCKET)
    joined = attach_price_bucket_key(with_price_bucket(_valid_silver(spark, sf_dir)), dim)
    return joined.select("name", "main_category", "sub_category", "actual_price", "price_bucket",
                         "price_bucket_key")


def fact_product_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full(spark, sf_dir)[1].read("fact_product_metrics", schema=schemas.FACT_PRODUCT_METRICS)


def agg_category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _full(spark, sf_dir)[1].read("agg_category_summary", schema=schemas.AGG_CATEGORY_SUMMARY)
    return out.orderBy(F.desc("product_count"), F.asc_nulls_first("main_category"))


def agg_price_bucket_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _full(spark, sf_dir)[1].read("agg_price_bucket_summary", schema=schemas.AGG_PRICE_BUCKET_SUMMARY)
    return out.orderBy("price_bucket")


# -- verification and audit ------------------------------------------------------
LAYER_TABLES = ("bronze", "staging", "silver", "dead_letter", "dim_category", "dim_price_bucket",
                "fact_product_metrics", "agg_category_summary", "agg_price_bucket_summary")


def layer_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, store = _full(spark, sf_dir)
    return layer_counts({t: store.read(t, schema=schemas.TABLES[t]) for t in LAYER_TABLES})


def describe_layer_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, store = _full(spark, sf_dir)
    return describe_layer(store.read("silver", schema=schemas.SILVER), "silver")


def describe_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of all ten tables, from what their writes observed."""
    return describe_tables(_full(spark, sf_dir)[1])


def gold_after_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category summary after the second batch, which gold summed up from the
    merge's changed rows alone."""
    _, store = _history(spark, sf_dir)
    return store.read("agg_category_summary", schema=schemas.AGG_CATEGORY_SUMMARY)


def checkpoint_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, store = _history(spark, sf_dir)
    return store.read("checkpoints", schema=schemas.CHECKPOINTS)


def checkpoint_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_checkpoints(checkpoint_log(spark, sf_dir), 10)


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, store = _history(spark, sf_dir)
    return store.read("run_summaries", schema=RUN_SUMMARY)


QUERIES: dict[str, Query] = {
    "scan_csv": scan_csv,
    "scan_table": scan_table,
    "bronze_map_columns": bronze_map_columns,
    "bronze_union": bronze_union,
    "write_overwrite": write_overwrite,
    "silver_clean": silver_clean,
    "silver_derive": silver_derive,
    "silver_validate": silver_validate,
    "valid_invalid_split": valid_invalid_split,
    "dead_letter": dead_letter,
    "dead_letter_raw": dead_letter_raw,
    "malformed_lines": malformed_lines,
    "dead_letter_review": dead_letter_review_q,
    "quality_report": quality_report_q,
    "distinct_category_pairs": distinct_category_pairs,
    "silver_dedup": silver_dedup,
    "dead_letter_summary": dead_letter_summary_q,
    "dead_letter_sample": dead_letter_sample,
    "silver_upsert": silver_upsert,
    "silver_upsert_twice": silver_upsert_twice,
    "table_by_name": table_by_name,
    "dim_category": dim_category,
    "price_bucket": price_bucket,
    "surrogate_key": surrogate_key,
    "fact_join_category": fact_join_category,
    "fact_join_category_salted": fact_join_category_salted,
    "fact_join_bucket": fact_join_bucket,
    "fact_product_metrics": fact_product_metrics,
    "agg_category_summary": agg_category_summary,
    "agg_price_bucket_summary": agg_price_bucket_summary,
    "gold_after_change": gold_after_change,
    "layer_counts": layer_counts_q,
    "describe_layer": describe_layer_q,
    "describe_layers": describe_layers,
    "checkpoint_log": checkpoint_log,
    "checkpoint_latest": checkpoint_latest,
    "run_summary": run_summary,
}
