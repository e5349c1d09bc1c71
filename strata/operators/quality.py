"""Data-quality and verification reports, each a single aggregate pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.names import unused_names

# The columns whose NULL counts the source pipeline reports.
CRITICAL_COLUMNS = ("name", "main_category", "ratings", "no_of_ratings",
                    "discount_price", "actual_price")


def quality_count_exprs(columns: Sequence[str] = CRITICAL_COLUMNS) -> list[Column]:
    """Plain count aggregates; usable with ``DataFrame.observe`` on a write."""
    return [
        F.count(F.lit(1)).alias("total_staged"),
        F.count_if(F.col("is_valid")).alias("valid_count"),
        F.count_if(~F.col("is_valid")).alias("invalid_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    ]


def valid_rate(valid: Column, total: Column) -> Column:
    """valid / total * 100 rounded to 2 decimals; 0 for an empty input."""
    return F.when(total > 0, F.round(valid / total * 100, 2)).otherwise(F.lit(0.0))


def distinct_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``row_count`` and ``distinct_count`` of the combinations of ``keys``
    (NULL parts compare equal). Rows are counted per key before the shuffle."""
    (n,) = unused_names(1, df)
    per_key = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(n))
    return per_key.agg(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("row_count"),
                       F.count(F.lit(1)).alias("distinct_count"))


def quality_report(staged: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    """One row: total, valid, invalid, valid rate and NULL count per column."""
    counts = staged.agg(*quality_count_exprs(columns))
    names = counts.columns
    rate = valid_rate(F.col("valid_count"), F.col("total_staged")).alias("valid_rate")
    return counts.select(*names[:3], rate, *names[3:])


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(layer, row_count) for every named table, in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("layer"), "row_count") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def describe_layer(df: DataFrame, layer: str) -> DataFrame:
    """Per-column profile: ordinal, name, type, row and NULL counts (one scan)."""
    fields = df.schema.fields
    agg = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"_n{i}") for i, f in enumerate(fields)],
    )
    entries = F.array(*[
        F.struct(
            F.lit(i + 1).alias("ordinal"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"_n{i}").alias("null_count"),
        )
        for i, f in enumerate(fields)
    ])
    return agg.select(F.col("_rows").alias("row_count"), F.explode(entries).alias("e")).select(
        F.lit(layer).alias("layer"),
        "e.ordinal",
        "e.column_name",
        "e.data_type",
        "row_count",
        "e.null_count",
    )


def sample_rows(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """A stable preview: the first ``n`` rows in ``order_by`` order."""
    return df.orderBy(*order_by).limit(n)
