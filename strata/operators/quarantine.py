"""Dead-letter rows and their per-rule summary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.rules import MESSAGE_SEPARATOR
from strata.schemas import CHANGED_COLUMNS, RAW_LINE, RAW_PREFIX, SOURCE_COLUMNS
from strata.sources.lineage import timestamp_lit


def dead_letter(staged: DataFrame, failed_at: dt.datetime | str, *,
                batch_id: str | None = None, keep_raw: bool = False) -> DataFrame:
    """Invalid staged rows in quarantine form.

    The four numeric columns hold the cleaned values cast back to text, as
    in the source pipeline. ``keep_raw`` (needs ``stage(keep_raw=True)``)
    adds the text that was received, so nothing of the original row is lost. A
    malformed source line is kept whole where staging has ``raw_line``.
    ``batch_id`` defaults to each row's own batch.
    """
    cols = [F.col(c).cast("string").alias(c) for c in SOURCE_COLUMNS]
    cols += [
        F.col("validation_errors"),
        (F.lit(batch_id) if batch_id is not None else F.col("batch_id")).alias("batch_id"),
        timestamp_lit(failed_at).alias("failed_at"),
    ]
    if keep_raw:
        cols += [F.col(RAW_PREFIX + c) for c in CHANGED_COLUMNS]
    if RAW_LINE in staged.columns:
        cols.append(F.col(RAW_LINE))
    return staged.where(~F.col("is_valid")).select(*cols)


def dead_letter_review(dead: DataFrame) -> DataFrame:
    """What a reviewer of quarantined rows looks at: which row, what failed, when."""
    return dead.select("name", "main_category", "validation_errors", "batch_id", "failed_at")


def dead_letter_summary(dead: DataFrame) -> DataFrame:
    """Rows per failed rule message (a row failing three rules counts three times)."""
    msg = F.explode(F.split(F.col("validation_errors"), MESSAGE_SEPARATOR)).alias("validation_error")
    return (
        dead.select(msg)
        .where(F.col("validation_error") != F.lit(""))
        .groupBy("validation_error")
        .agg(F.count(F.lit(1)).alias("error_count"))
    )
