"""Layer plans (bronze, silver, gold), the audited runner and test-data runs."""

from strata.plans.layers import (
    RunParams,
    Source,
    bronze_frame,
    merge_into_silver,
    run_bronze,
    run_gold,
    run_silver,
    write_batch,
)
from strata.plans.runner import RunResult, latest_checkpoints, run_layers
from strata.plans.tables import LAYER_TABLES, SilverLayout, describe_tables, ensure_tables, silver_layout

__all__ = [
    "LAYER_TABLES",
    "RunParams",
    "RunResult",
    "SilverLayout",
    "Source",
    "bronze_frame",
    "describe_tables",
    "ensure_tables",
    "latest_checkpoints",
    "merge_into_silver",
    "run_bronze",
    "run_gold",
    "run_layers",
    "run_silver",
    "silver_layout",
    "write_batch",
]
