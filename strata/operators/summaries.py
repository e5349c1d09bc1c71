"""Gold summaries: per category and per price bucket.

``category_summary`` and ``price_bucket_summary`` aggregate products. Where the
products change by batches, ``rollup`` keeps counts and sums per category pair
and bucket instead, ``apply_delta`` brings them up to date from the changed
rows alone, and the ``..._of`` functions read the summaries from them. Sums are
decimals of ten places, so that taking a row out gives back what putting it in
gave. Values beyond those (not finite, or of more than 18 digits before the
point) are only counted, as ``odd``; summaries of a rollup with odd values must
be aggregated from the products.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.schemas import GOLD_DELTA, GOLD_ROLLUP, SILVER, SUMMED_COLUMNS

ROLLUP_KEYS = ("main_category", "sub_category", "price_bucket")


def _avg2(col: str) -> Column:
    return F.round(F.avg(col), 2)


def category_summary(products: DataFrame) -> DataFrame:
    """Count and rounded averages per main category, in no order: sort on read."""
    return (
        products.groupBy("main_category")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            _avg2("ratings").alias("avg_rating"),
            _avg2("discount_price").alias("avg_discount_price"),
            _avg2("actual_price").alias("avg_actual_price"),
            _avg2("discount_pct").alias("avg_discount_pct"),
        )
    )


def price_bucket_summary(products: DataFrame) -> DataFrame:
    """Count and rounded averages per price bucket, in no order: sort on read."""
    return (
        products.groupBy("price_bucket")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            _avg2("ratings").alias("avg_rating"),
            _avg2("discount_pct").alias("avg_discount_pct"),
        )
    )


def _measures(sign: str) -> list[str]:
    """Signed counts and sums of rows that hold the summed columns."""
    cols, odd = [f"sum({sign}) AS n"], []
    for c in SUMMED_COLUMNS:
        value = f"try_cast({c} AS DECIMAL(28, 10))"
        odd.append(f"int({c} IS NOT NULL AND {value} IS NULL)")
        cols += [f"sum(CASE WHEN {value} IS NOT NULL THEN {sign} ELSE 0 END) AS {c}_n",
                 f"sum(coalesce({value}, 0) * CAST({sign} AS DECIMAL(1, 0))) AS {c}_sum"]
    return [*cols, f"sum(({' + '.join(odd)}) * {sign}) AS odd"]


def _grouped(rows: DataFrame, aggregates: list[str], schema: StructType) -> DataFrame:
    grouped = rows.groupBy(*ROLLUP_KEYS).agg(*[F.expr(a) for a in aggregates])
    return grouped.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields])


def rollup(products: DataFrame) -> DataFrame:
    """Counts and sums per (main, sub, price bucket); needs ``price_bucket``."""
    return _grouped(products, _measures("1"), GOLD_ROLLUP)


def rollup_delta(signed: DataFrame, sign: str) -> DataFrame:
    """The same from rows that come in (``sign`` 1) and go out (-1), with the NULLs
    that they bring to each silver column."""
    nulls = [f"sum(CASE WHEN {f.name} IS NULL THEN {sign} ELSE 0 END) AS nulls_{i}" for i, f in enumerate(SILVER.fields)]
    return _grouped(signed, _measures(sign) + nulls, GOLD_DELTA)


def apply_delta(kept: DataFrame, delta: DataFrame) -> DataFrame:
    """A rollup brought up to date; groups without rows are gone."""
    values = [f.name for f in GOLD_ROLLUP.fields if f.name not in ROLLUP_KEYS]
    both = kept.unionByName(delta.select(*kept.columns))
    return _grouped(both, [f"sum({c}) AS {c}" for c in values], GOLD_ROLLUP).where("n <> 0")


def _avg2_of(col: str) -> Column:
    n = F.sum(f"{col}_n")
    return F.round(F.when(n > 0, F.sum(f"{col}_sum").cast("double") / n), 2)


def category_summary_of(kept: DataFrame) -> DataFrame:
    """:func:`category_summary` of the products behind a rollup."""
    return kept.groupBy("main_category").agg(
        F.sum("n").alias("product_count"),
        _avg2_of("ratings").alias("avg_rating"),
        _avg2_of("discount_price").alias("avg_discount_price"),
        _avg2_of("actual_price").alias("avg_actual_price"),
        _avg2_of("discount_pct").alias("avg_discount_pct"),
    )


def price_bucket_summary_of(kept: DataFrame) -> DataFrame:
    """:func:`price_bucket_summary` of the products behind a rollup."""
    return kept.groupBy("price_bucket").agg(
        F.sum("n").alias("product_count"),
        _avg2_of("ratings").alias("avg_rating"),
        _avg2_of("discount_pct").alias("avg_discount_pct"),
    )
