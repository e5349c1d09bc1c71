"""Product sources derived from the supplied TPC-H-style tables.

The supplied tables are clean, while the layers exist to handle scraped,
messy text. ``messy_products`` turns every ``lineitem`` row (joined to its
``part``) into one product listing with the faults a scraper produces:
padded names, upper-case and blank categories, NULLs, thousands separators,
a currency sign, non-numeric and out-of-range ratings, negative prices.
Faults are a deterministic function of the row, so a SQL engine can build the
identical input, and every row of ``lineitem`` is kept.

``listing_table`` is the second, wide source: one row per ``part`` with its
own column names, mapped onto product columns by the table source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import SOURCE_COLUMNS

# Fixed values of the fault-injection rule (a product is faulty when its
# order key is a multiple of one of these moduli, or by line number).
NULL_NAME_EVERY = 97
BLANK_CATEGORY_EVERY = 89
NULL_SUB_CATEGORY_EVERY = 83
NEGATIVE_PRICE_EVERY = 79
NON_NUMERIC_RATING_LINE = 7
OUT_OF_RANGE_RATING_LINE = 6
# Lines of the faulty file that lack their last two fields, have two more, open
# their last field with a quote that never closes, or hold a quoted name in
# which quotes are doubled (well-formed).
SHORT_LINE_EVERY = 101
LONG_LINE_EVERY = 103
OPEN_QUOTE_EVERY = 107
QUOTED_NAME_EVERY = 109
# A category of spaces only: empty after trimming. (CSV cannot tell an empty
# string from NULL when read with default options, so the blank is spaces.)
BLANK_CATEGORY = "   "


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def messy_products(spark: SparkSession, sf_dir: str, *, with_ship_date: bool = False,
                   with_order_key: bool = False) -> DataFrame:
    """All-text product rows, one per lineitem row (whole table, no sampling)."""
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    # What depends on the part alone is made once per part.
    part = _table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("p_name"),
        F.concat("p_brand", F.lit(" ")).alias("p_brand"), F.upper("p_type").alias("p_type"))
    rows = li.join(part, li.l_partkey == part.p_partkey, "inner")
    ok, pk = F.col("l_orderkey"), F.col("l_partkey").cast("string")
    cols = [
        F.when(ok % NULL_NAME_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.col("p_name")).alias("name"),
        F.when(ok % BLANK_CATEGORY_EVERY == 0, F.lit(BLANK_CATEGORY))
        .otherwise(F.col("p_type")).alias("main_category"),
        F.when(ok % NULL_SUB_CATEGORY_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.col("p_brand")).alias("sub_category"),
        F.concat(F.lit("img/"), pk, F.lit(".jpg")).alias("image"),
        F.concat(F.lit("item/"), pk).alias("link"),
        F.when(F.col("l_linenumber") == NON_NUMERIC_RATING_LINE, F.lit("not_a_number"))
        .when(F.col("l_linenumber") == OUT_OF_RANGE_RATING_LINE, F.lit("7.5"))
        .otherwise(F.expr("CAST(CAST(l_partkey % 51 AS DECIMAL(3, 0)) * 0.1 AS STRING)")).alias("ratings"),
        F.format_number(ok, 0).alias("no_of_ratings"),
        F.when(ok % NEGATIVE_PRICE_EVERY == 0, F.lit("-50"))
        .otherwise(F.concat(F.lit("₹"), F.format_number(F.col("l_extendedprice") * F.lit(0.1), 2)))
        .alias("discount_price"),
        F.format_number(F.col("l_extendedprice") * F.lit(0.125), 2).alias("actual_price"),
    ]
    if with_ship_date:
        cols.append(F.col("l_shipdate"))
    if with_order_key:
        cols.append(F.col("l_orderkey"))
    return rows.select(*cols)


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every product as one CSV line, all fields quoted, in a column named like the
    header line; some lines are malformed."""
    rows = messy_products(spark, sf_dir, with_order_key=True)
    key = F.col("l_orderkey")

    def field(name: str) -> Column:
        value = F.coalesce(F.col(name), F.lit(""))
        if name == "name":
            value = F.when(key % QUOTED_NAME_EVERY == 0, F.concat(F.lit('""'), value, F.lit('"", new'))).otherwise(value)
        return F.concat(F.lit('"'), value, F.lit('"'))

    fields = [field(c) for c in SOURCE_COLUMNS]
    whole = F.concat_ws(",", *fields)
    line = (
        F.when(key % SHORT_LINE_EVERY == 0, F.concat_ws(",", *fields[:-2]))
        .when(key % LONG_LINE_EVERY == 0, F.concat(whole, F.lit(',"more","still more"')))
        .when(key % OPEN_QUOTE_EVERY == 0, F.concat(
            F.concat_ws(",", *fields[:-2]), F.lit(',"'), F.concat_ws(",", *SOURCE_COLUMNS[-2:])))
        .otherwise(whole)
    )
    return rows.select(line.alias(",".join(SOURCE_COLUMNS)))


def listing_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide scraped-listing table with its own naming (one row per part)."""
    part = _table(spark, sf_dir, "part")
    return part.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("asin"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("brand_name"),
        (F.col("p_size").cast("double") / F.lit(10.0)).alias("rating_stars"),
        (F.col("p_partkey") * 3 + 7).alias("rating_count"),
        F.floor("p_retailprice").cast("double").alias("price_value"),
        F.col("p_retailprice").alias("list_price"),
        F.when(F.col("p_size") > 25, F.lit("In Stock")).otherwise(F.lit("Limited")).alias("availability"),
    )
