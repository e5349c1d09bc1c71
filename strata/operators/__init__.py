"""DataFrame -> DataFrame operators (no actions unless documented)."""

from strata.operators.dedup import PRODUCT_SURVIVOR_ORDER, dedup_by_key
from strata.operators.joins import hot_keys, key_counts, key_hash, left_join_dim
from strata.operators.keys import dense_key, numbered, range_numbered
from strata.operators.merge import DuplicateKeyError, assert_unique, changes, upsert
from strata.operators.quality import (
    CRITICAL_COLUMNS,
    describe_layer,
    distinct_count,
    layer_counts,
    quality_count_exprs,
    quality_report,
    sample_rows,
)
from strata.operators.quarantine import dead_letter, dead_letter_review, dead_letter_summary
from strata.operators.staging import clean, derive, split_valid, stage, validate
from strata.operators.star import (
    attach_category_key,
    attach_price_bucket_key,
    category_rows,
    dim_category,
    dim_price_bucket,
    enrich,
    fact_rows,
    with_price_bucket,
)
from strata.operators.summaries import (
    apply_delta,
    category_summary,
    category_summary_of,
    price_bucket_summary,
    price_bucket_summary_of,
    rollup,
    rollup_delta,
)

__all__ = [
    "CRITICAL_COLUMNS",
    "DuplicateKeyError",
    "PRODUCT_SURVIVOR_ORDER",
    "apply_delta",
    "assert_unique",
    "attach_category_key",
    "attach_price_bucket_key",
    "category_rows",
    "category_summary",
    "category_summary_of",
    "changes",
    "clean",
    "dead_letter",
    "dead_letter_review",
    "dead_letter_summary",
    "dedup_by_key",
    "dense_key",
    "derive",
    "describe_layer",
    "distinct_count",
    "dim_category",
    "dim_price_bucket",
    "enrich",
    "fact_rows",
    "hot_keys",
    "key_counts",
    "key_hash",
    "layer_counts",
    "left_join_dim",
    "numbered",
    "price_bucket_summary",
    "price_bucket_summary_of",
    "quality_count_exprs",
    "quality_report",
    "range_numbered",
    "rollup",
    "rollup_delta",
    "sample_rows",
    "split_valid",
    "stage",
    "upsert",
    "validate",
    "with_price_bucket",
]
