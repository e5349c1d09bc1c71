"""Run the layers in order with an audit trail.

Every layer ends with a checkpoint row (SUCCESS with its record count, or
FAILED with the error text and count 0), stamped when the layer ends. A
layer whose upstream did not succeed is not attempted and is logged as
SKIPPED, so a failed bronze load never feeds silver or gold. The checkpoint
rows are appended to the ``checkpoints`` table, a one-row summary of the
run to ``run_summaries``, and what the writes observed to ``layer_metrics``. The
tables are made first, so they are there to read even if the first run fails.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from strata import schemas
from strata.functions.rules import PRODUCT_RULES, Rule
from strata.plans.layers import (
    BY_CHANGE_SHARE,
    BronzeResult,
    GoldResult,
    RunParams,
    SilverResult,
    Source,
    run_bronze,
    run_gold,
    run_silver,
)
from strata.plans.tables import ensure_tables
from strata.sources.splits import fine_tasks
from strata.sources.store import TableStore

# The layer names and the statuses SUCCESS, FAILED and PARTIAL FAILURE
# are those of the source pipeline's audit log; SKIPPED is ours.
SUCCESS, FAILED, SKIPPED = "SUCCESS", "FAILED", "SKIPPED"
LAYERS = ("BRONZE", "SILVER", "GOLD")

RUN_SUMMARY = schemas.RUN_SUMMARY

_TS_FORMAT = "%Y-%m-%d %H:%M:%S.%f"


@dataclass
class RunResult:
    run: RunParams
    checkpoints: list[tuple]
    bronze: BronzeResult | None
    silver: SilverResult | None
    gold: GoldResult | None

    @property
    def succeeded(self) -> bool:
        return all(row[2] == SUCCESS for row in self.checkpoints)

    @property
    def overall_status(self) -> str:
        return SUCCESS if self.succeeded else "PARTIAL FAILURE"


def _frame_with_timestamps(spark: SparkSession, rows: list[tuple], schema: StructType,
                           ts_fields: Sequence[str]) -> DataFrame:
    """Build a small frame whose timestamps are wall-clock text in the session zone."""
    text_schema = StructType([
        StructField(f.name, schemas.S if f.name in ts_fields else f.dataType, True) for f in schema.fields
    ])
    names = [f.name for f in schema.fields]
    idx = [names.index(n) for n in ts_fields]
    text_rows = [
        tuple(v.strftime(_TS_FORMAT) if i in idx and v is not None else v for i, v in enumerate(r))
        for r in rows
    ]
    df = spark.createDataFrame(text_rows, text_schema)
    return df.select(*[F.col(n).cast("timestamp").alias(n) if n in ts_fields else F.col(n) for n in names])


def checkpoint_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return _frame_with_timestamps(spark, rows, schemas.CHECKPOINTS, ["executed_at"])


def run_layers(store: TableStore, sources: Sequence[Source], run: RunParams, *,
               rules: Sequence[Rule] = PRODUCT_RULES, keep_raw: bool = False,
               null_safe_merge: bool = True, dead_letter_mode: str = "overwrite",
               silver_buckets: int | None = None, silver_parts: int | None = None,
               bronze_mode: str = "overwrite", by_change_share: float = BY_CHANGE_SHARE) -> RunResult:
    spark = store.spark
    ensure_tables(store, silver_buckets=silver_buckets, silver_parts=silver_parts)
    rows: list[tuple] = []
    results: dict[str, object] = {}

    def record(layer: str, status: str, count: int, error: str | None, batch_rows: int) -> None:
        rows.append((run.batch_id, layer, status, int(count), run.clock(), error, int(batch_rows)))

    steps = {
        "BRONZE": lambda: run_bronze(store, sources, run, mode=bronze_mode),
        "SILVER": lambda: run_silver(store, results["BRONZE"].bronze, run, rules=rules,
                                     keep_raw=keep_raw, null_safe_merge=null_safe_merge,
                                     dead_letter_mode=dead_letter_mode,
                                     silver_buckets=silver_buckets, silver_parts=silver_parts,
                                     by_change_share=by_change_share),
        "GOLD": lambda: run_gold(store, silver_rows=results["SILVER"].silver_rows),
    }
    upstream_ok = True
    for layer in LAYERS:
        if not upstream_ok:
            record(layer, SKIPPED, 0, "not run: an upstream layer did not succeed", 0)
            continue
        try:
            with fine_tasks(spark):
                res = steps[layer]()
        except Exception as exc:  # noqa: BLE001 - the audit log records any failure
            record(layer, FAILED, 0, f"{type(exc).__name__}: {exc}", 0)
            upstream_ok = False
            continue
        results[layer] = res
        if layer == "BRONZE":
            record(layer, SUCCESS, res.rows, None, res.rows)
        elif layer == "SILVER":
            record(layer, SUCCESS, res.silver_rows, None, res.batch_rows)
        else:
            record(layer, SUCCESS, res.fact_rows, None, res.fact_rows)

    result = RunResult(run, rows, results.get("BRONZE"), results.get("SILVER"), results.get("GOLD"))
    store.append("checkpoints", checkpoint_frame(spark, rows).coalesce(1))
    store.append("run_summaries", run_summary_frame(spark, result).coalesce(1))
    store.flush_metrics(run.batch_id)
    return result


def run_summary_frame(spark: SparkSession, result: RunResult) -> DataFrame:
    b, s, g = result.bronze, result.silver, result.gold
    row = (
        result.run.batch_id,
        result.run.as_of,
        b.rows if b else None,
        s.silver_rows if s else None,
        s.valid_rows if s else None,
        s.invalid_rows if s else None,
        s.dead_letter_rows if s else None,
        g.fact_rows if g else None,
        result.overall_status,
    )
    return _frame_with_timestamps(spark, [row], RUN_SUMMARY, ["executed_at"])


def latest_checkpoints(checkpoints: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most recent checkpoint rows (a top-n report)."""
    return checkpoints.orderBy(F.desc("executed_at"), F.desc("batch_id"), F.asc("layer_name")).limit(n)
