"""Lineage columns stamped on every bronze row, from run parameters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def timestamp_lit(value: dt.datetime | str) -> Column:
    """A TIMESTAMP literal from a wall-clock value in the session time zone."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp")


def date_lit(value: dt.date | dt.datetime | str) -> Column:
    if isinstance(value, dt.datetime):
        value = value.date()
    if isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(value).cast("date")


def with_lineage(df: DataFrame, source_file: str, batch_id: str,
                 ingestion_date: dt.date | dt.datetime | str) -> DataFrame:
    """Append ``source_file``, ``batch_id`` and ``ingestion_date`` (DATE)."""
    return df.select(
        "*",
        F.lit(source_file).alias("source_file"),
        F.lit(batch_id).alias("batch_id"),
        date_lit(ingestion_date).alias("ingestion_date"),
    )
