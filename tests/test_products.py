"""The product operators over the small shop of ``conftest.py``."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import as_bronze
from strata.functions import PRODUCT_RULES, to_double, to_price
from strata.operators import (
    PRODUCT_SURVIVOR_ORDER,
    clean,
    dead_letter,
    dedup_by_key,
    derive,
    split_valid,
    stage,
    validate,
)
from strata.operators.summaries import category_summary
from strata.schemas import PRODUCT_KEY
from strata.sources.files import read_csv_source, write_csv
from strata.sources.products import messy_products


@pytest.fixture()
def shop(mock_df):
    return stage(as_bronze(mock_df))


def test_price_text_becomes_numbers(spark, mock_df):
    got = {tuple(r) for r in mock_df.where("name like '%Kettle' or name like '%Shelf%'").select(
        F.trim("name"), to_price("discount_price"), to_price("actual_price"), to_double("no_of_ratings")).collect()}
    assert got == {("Oak Shelf", 3480.0, 4350.0, 2005.0), ("Copper Kettle", 1150.0, 1600.0, 312.0),
                   ("Copper Kettle", 1100.0, 1600.0, 97.0)}
    odd = spark.createDataFrame([("four",), ("",), (None,), ("4,5",)], "x string")
    assert [r[0] for r in odd.select(to_double("x")).collect()] == [None, None, None, 45.0]


def test_cleaning_trims_names_and_lowers_categories(mock_df):
    names = {(r["name"], r["main_category"]) for r in clean(as_bronze(mock_df)).collect()}
    assert ("Oak Shelf", "furniture") in names and ("Copper Kettle", "kitchen") in names


@pytest.mark.parametrize("name, message", [
    ("Linen Apron", "ratings out of range"),
    ("Garden Hose", "ratings out of range"),
    ("Desk Lamp", "discount_price < 0"),
    (None, "name is null/empty"),
])
def test_each_broken_rule_is_named(shop, name, message):
    row = shop.where(F.col("name").eqNullSafe(F.lit(name))).first()
    assert not row["is_valid"] and message in row["validation_errors"]


def test_discounts(mock_df):
    rows = {(r["name"], r["no_of_ratings"]): (r["discount_amount"], r["discount_pct"])
            for r in derive(clean(as_bronze(mock_df))).collect()}
    assert rows["Copper Kettle", 312.0] == (450.0, 28.13)
    assert rows["Wool Blanket", 48.0] == (204.5, 19.95)
    assert rows["Oak Shelf", 2005.0] == (870.0, 20.0)
    assert rows["Clay Pot", 150.0] == (33.0, 25.0)
    assert rows["Desk Lamp", 61.0] == (87.0, 116.0)
    assert rows["Gift Card", 5.0] == (0.0, None)


def test_the_kettle_with_most_ratings_survives(shop):
    valid, invalid = split_valid(shop)
    assert (valid.count(), invalid.count()) == (5, 5)
    left = dedup_by_key(valid, PRODUCT_KEY, PRODUCT_SURVIVOR_ORDER)
    kettle = left.where("name = 'Copper Kettle'").collect()
    assert [(r["ratings"], r["discount_price"]) for r in kettle] == [(4.1, 1150.0)]
    assert sorted(r["name"] for r in left.collect()) == ["Clay Pot", "Copper Kettle", "Oak Shelf", "Wool Blanket"]
    assert shop.select("main_category", "sub_category").distinct().count() == 9


def test_quarantine_with_fewer_rules(mock_df):
    some = [r for r in PRODUCT_RULES if r.name in ("name_present", "discount_price_non_negative")]
    dead = dead_letter(validate(derive(clean(as_bronze(mock_df))), some), "2024-01-01 06:00:00")
    assert {r["name"]: r["validation_errors"] != "" for r in dead.collect()} == {"Desk Lamp": True, None: True}


def test_quarantine_keeps_the_text_received(mock_df):
    dead = dead_letter(stage(as_bronze(mock_df), keep_raw=True), "2024-01-01 06:00:00", keep_raw=True)
    lamp = dead.where("name = 'Desk Lamp'").first()
    assert (lamp["raw_main_category"], lamp["raw_discount_price"], lamp["main_category"]) == ("Furniture", "-12", "furniture")


def test_category_summary_of_the_shop(shop):
    rows = {r["main_category"]: (r["product_count"], r["avg_actual_price"]) for r in category_summary(shop).collect()}
    assert rows["kitchen"] == (3, 1166.67) and rows["garden"] == (3, 250.67)


def test_compressed_inputs_read_back_in_bounded_files(spark, scratch_dir):
    rows = spark.createDataFrame([(f" n{i}", '"q", x' if i % 3 else None) for i in range(250)], "name string, link string")
    write_csv(rows.coalesce(1), f"{scratch_dir}/c", compression="lz4", rows_per_file=100)
    files = [f for f in os.listdir(f"{scratch_dir}/c") if f.startswith("part-")]
    assert len(files) == 3 and all(f.endswith(".lz4") for f in files)
    back = read_csv_source(spark, f"{scratch_dir}/c", ["name", "link"], raw_line=True)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(((*r, None) for r in rows.collect()), key=str)


def test_products_of_odd_part_keys(spark, scratch_dir):
    """Ratings and part columns as the rule says, for negative keys and NULLs too."""
    keys = [*range(-60, 60), 10**12 + 7]
    part = spark.createDataFrame([(k, None if k % 7 == 0 else f"n{k}", None if k % 5 == 0 else "b", "Type x") for k in keys],
                                 "p_partkey long, p_name string, p_brand string, p_type string")
    lines = spark.createDataFrame([(i + 1, k, 1, 100.0 * i) for i, k in enumerate(keys)],
                                  "l_orderkey long, l_partkey long, l_linenumber int, l_extendedprice double")
    part.write.parquet(f"{scratch_dir}/part.parquet")
    lines.withColumn("l_shipdate", F.lit("1995-01-01").cast("timestamp")).write.parquet(f"{scratch_dir}/lineitem.parquet")
    got = {r.link: r for r in messy_products(spark, scratch_dir).collect()}
    want = spark.createDataFrame([(k,) for k in keys], "k long").selectExpr("k", "CAST(round((k % 51) / 10.0, 1) AS STRING) AS r")
    assert {r.k: r.r for r in want.collect()} == {k: got[f"item/{k}"].ratings for k in keys}
    row = got["item/3"]
    assert (row.name, row.main_category, row.sub_category) == ("  n3 ", "TYPE X", "b ")
    assert got["item/7"].name is None and got["item/5"].sub_category is None
