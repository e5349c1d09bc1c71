"""Edge cases and properties of the operators."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from conftest import as_bronze
from strata.functions import PRICE_BUCKETS, bucketize, to_double, to_price
from strata.operators import (
    DuplicateKeyError,
    PRODUCT_SURVIVOR_ORDER,
    assert_unique,
    clean,
    dead_letter_summary,
    dedup_by_key,
    dense_key,
    describe_layer,
    dim_category,
    layer_counts,
    left_join_dim,
    quality_report,
    split_valid,
    stage,
    upsert,
)
from strata.operators.joins import hot_keys, key_counts
from strata.operators.quarantine import dead_letter
from strata.schemas import PRODUCT_KEY, SILVER, SchemaMismatch, enforce_schema
from strata.sources.tables import LISTING_COLUMN_MAP, map_columns

TEXT = StructType([StructField("v", StringType(), True)])


def _texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], TEXT)


def test_cast_grammar(spark):
    values = ["1e3", " 12 ", "\t7\t", "NaN", "inf", "1d", "1_000", "abc", "", None, " 5"]
    got = [r["c"] for r in _texts(spark, values).select(to_double("v").alias("c")).collect()]
    assert got[0] == 1000.0 and got[1] == 12.0 and got[2] == 7.0
    assert math.isnan(got[3]) and got[4] == math.inf
    assert got[5] == 1.0          # Spark accepts a type suffix
    assert got[6:10] == [None, None, None, None]
    assert got[10] is None        # a no-break space is not trimmed


def test_price_symbols_and_separators(spark):
    got = [r["c"] for r in _texts(spark, ["₹1,299.50", "1,00,000", "₹₹5", "-₹3"]).select(
        to_price("v").alias("c")).collect()]
    assert got == [1299.5, 100000.0, 5.0, -3.0]


def test_trim_only_spaces(spark):
    df = spark.createDataFrame([("  a  ", " B\t", " c")], "name string, main_category string, "
                               "sub_category string")
    row = clean(as_bronze(df)).first()
    assert row["name"] == "a"
    assert row["main_category"] == "b\t"
    assert row["sub_category"] == " c"


def _staged(spark, rows):
    schema = ("name string, main_category string, sub_category string, ratings string, "
              "no_of_ratings string, discount_price string, actual_price string")
    return stage(as_bronze(spark.createDataFrame(rows, schema)))


def test_rules_nan_and_blank(spark):
    staged = _staged(spark, [
        ("   ", "x", "s", "4", "1", "1", "2"),        # blank name after trim
        ("n1", "x", "s", "NaN", "1", "1", "2"),       # NaN rating is out of range
        ("n2", "x", "s", "4", "1", "1", "NaN"),       # NaN price passes (NaN <= 0 is false)
        ("n3", "x", "s", "4", "1", "200", "100"),     # discount above actual is allowed
        ("n4", None, "s", None, "-1", "-1", "0"),     # every numeric rule fails
    ])
    rows = {r["name"]: r for r in staged.collect()}
    assert rows[""]["validation_errors"] == "name is null/empty; "
    assert rows["n1"]["validation_errors"] == "ratings out of range [0-5]; "
    assert rows["n2"]["is_valid"]
    assert rows["n3"]["is_valid"] and rows["n3"]["discount_pct"] == -100.0
    assert rows["n4"]["validation_errors"] == (
        "main_category is null/empty; ratings out of range [0-5]; no_of_ratings < 0; "
        "discount_price < 0; actual_price <= 0; ")
    summary = {r["validation_error"]: r["error_count"]
               for r in dead_letter_summary(dead_letter(staged, "2024-01-01 00:00:00")).collect()}
    assert summary["ratings out of range [0-5]"] == 2
    assert summary["name is null/empty"] == 1
    assert sum(summary.values()) == 7


def test_bucket_boundaries(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 499.99, 500.0, 1999.0, 2000.0, 9999.99, 10000.0,
                                               float("nan"), None)], "p double")
    got = [r["b"] for r in df.select(bucketize("p", PRICE_BUCKETS).alias("b")).collect()]
    assert got == ["Budget", "Budget", "Mid-Range", "Mid-Range", "Premium", "Premium", "Luxury",
                   "Luxury", "Luxury"]


def test_quality_report_empty_and_counts(spark):
    empty = _staged(spark, [])
    row = quality_report(empty).first()
    assert (row["total_staged"], row["valid_count"], row["valid_rate"]) == (0, 0, 0.0)
    staged = _staged(spark, [("a", "x", "s", "4", "1", "1", "2"), (None, "x", "s", None, "1", "1", "2"),
                             ("b", "x", "s", "4", "1", "1", "2")])
    row = quality_report(staged).first()
    assert (row["total_staged"], row["valid_count"], row["invalid_count"]) == (3, 2, 1)
    assert row["valid_rate"] == 66.67 and row["null_name"] == 1 and row["null_ratings"] == 1


def test_split_is_a_partition(spark, mock_df):
    staged = stage(as_bronze(mock_df))
    valid, invalid = split_valid(staged)
    assert valid.count() + invalid.count() == staged.count()
    assert valid.where(~F.col("is_valid")).count() == 0
    assert invalid.where(F.col("is_valid")).count() == 0


def test_map_columns_missing_optional(spark):
    wide = spark.createDataFrame([("A1", "brand")], "asin string, brand_name string")
    row = map_columns(wide, LISTING_COLUMN_MAP).first()
    assert all(row[c] is None for c in row.asDict())
    partial = spark.createDataFrame([("t", 4.5, 7)], "title string, rating_stars double, rating_count long")
    row = map_columns(partial, LISTING_COLUMN_MAP).first()
    assert (row["name"], row["ratings"], row["no_of_ratings"], row["actual_price"]) == ("t", "4.5", "7", None)


def test_enforce_schema(spark):
    df = spark.createDataFrame([("x",)], "name string")
    with pytest.raises(SchemaMismatch):
        enforce_schema(df, SILVER)
    full = spark.createDataFrame([], SILVER).withColumn("extra", F.lit(1))
    with pytest.raises(SchemaMismatch):
        enforce_schema(full, SILVER)
    assert enforce_schema(full, SILVER, allow_extra=True).schema == SILVER


# -- dedup -----------------------------------------------------------------------------
def test_dedup_deterministic_and_idempotent(spark):
    rows = [("a", "m", None, 1.0, 10.0), ("a", "m", None, 2.0, 10.0), ("a", "m", None, 2.0, 30.0),
            ("a", "m", "s", 5.0, 1.0), ("b", None, None, 1.0, 1.0), ("b", None, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "name string, main_category string, sub_category string, "
                               "ratings double, no_of_ratings double")
    order = [("no_of_ratings", "desc"), ("ratings", "desc")]
    out = dedup_by_key(df.repartition(4), PRODUCT_KEY, order)
    got = sorted(out.collect(), key=lambda r: (r["name"], str(r["sub_category"])))
    assert [(r["name"], r["sub_category"], r["ratings"], r["no_of_ratings"]) for r in got] == [
        ("a", None, 2.0, 30.0), ("a", "s", 5.0, 1.0), ("b", None, 1.0, 1.0)]
    again = dedup_by_key(out, PRODUCT_KEY, order)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, out.collect()), key=str)


def test_dedup_hot_key(spark):
    # One key holds most rows; the survivor is still the first in order.
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("name"),
        F.lit("m").alias("main_category"), F.lit(None).cast("string").alias("sub_category"),
        (F.col("id") % 997).cast("double").alias("no_of_ratings"), F.col("id").alias("id"))
    out = dedup_by_key(df, PRODUCT_KEY, [("no_of_ratings", "desc"), ("id", "asc")])
    hot = out.where(F.col("name") == "hot").collect()
    assert len(hot) == 1 and hot[0]["no_of_ratings"] == 996.0
    assert hot[0]["id"] == min(i for i in range(0, 20000, 3) if i % 997 == 996)
    assert out.count() == 1 + len([i for i in range(20000) if i % 3])


# -- dense keys ------------------------------------------------------------------------
def _random_rows(n, seed=3):
    rnd = random.Random(seed)
    names = [None, "", "a", "b", "ab", "z", "é", "long name"]
    return [(rnd.choice(names), rnd.choice([None, "x", "y"]), rnd.randint(0, 5)) for _ in range(n)]


@pytest.mark.parametrize("parts,small", [(1, 0), (3, 0), (16, 0), (8, 10**9)])
def test_dense_key_equals_global_row_number(spark, parts, small):
    df = spark.createDataFrame(_random_rows(3000), "a string, b string, c long")
    keyed = dense_key(df, ["a", "b", "c"], "k", num_partitions=parts)
    got = keyed.collect()
    assert sorted(r["k"] for r in got) == list(range(1, 3001))
    ref = df.withColumn("k", F.row_number().over(Window.orderBy(
        F.asc_nulls_first("a"), F.asc_nulls_first("b"), F.asc_nulls_first("c"))))
    # Tied rows are identical, so compare the multiset of (row, key) for unique order values
    # through the key sequence of the sorted rows.
    by_key = [(r["a"], r["b"], r["c"]) for r in sorted(got, key=lambda r: r["k"])]
    by_ref = [(r["a"], r["b"], r["c"]) for r in sorted(ref.collect(), key=lambda r: r["k"])]
    assert by_key == by_ref


def test_dense_key_heavy_ties_spread(spark):
    # One order value for every row, and a third of the rows fully identical.
    df = spark.range(0, 6000).select(
        F.lit("same").alias("a"), F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("id"))
    keyed = dense_key(df, ["a"], "k", num_partitions=8)
    got = keyed.collect()
    assert sorted(r["k"] for r in got) == list(range(1, 6001))
    assert sum(1 for r in got if r["id"] == -1) == 2000


def test_dense_key_empty_and_start(spark):
    empty = spark.createDataFrame([], "a string")
    assert dense_key(empty, ["a"], "k").count() == 0
    df = spark.createDataFrame([("b",), ("a",)], "a string")
    assert [r["k"] for r in dense_key(df, ["a"], "k", start=10).orderBy("a").collect()] == [10, 11]


def test_dim_category_keys(spark):
    silver = spark.createDataFrame(
        [("x", "b"), ("x", None), ("x", "b"), (None, "q"), ("a", "z")], "main_category string, sub_category string")
    got = [tuple(r) for r in dim_category(silver).orderBy("category_key").collect()]
    assert got == [(1, "a", "z"), (2, "x", None), (3, "x", "b")]


# -- joins -------------------------------------------------------------------------------
def test_left_join_dim_with_hot_keys_equals_plain(spark):
    fact = spark.range(0, 3000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("k"),
        F.col("id"))
    dim = spark.createDataFrame([(str(i), i * 10) for i in range(5)] + [("hot", -1)], "k string, v long")
    small = left_join_dim(fact, dim, ["k"])
    big = left_join_dim(fact, dim, ["k"], rows_per_task=300)
    known = left_join_dim(fact, dim, ["k"], rows_per_task=300, counts=key_counts(fact, ["k"]))
    none_hot = left_join_dim(fact, dim, ["k"], rows_per_task=3000)
    a = sorted(map(tuple, small.select("id", "k", "v").collect()))
    for other in (big, known, none_hot):
        assert sorted(map(tuple, other.select("id", "k", "v").collect())) == a and len(a) == 3000
    # Only the hot key is hot; of too many, those of the largest share.
    counts = key_counts(fact, ["k"])
    assert [tuple(r) for r in hot_keys(counts, 300).collect()] == [("hot", 1500)]
    assert [tuple(r) for r in hot_keys(counts, 10, most=3).collect()] == [("hot", 1500)]
    assert hot_keys(counts, 10).count() == 8


def test_hot_keys_are_counted_once_and_not_shuffled(spark, scratch_dir):
    spark.range(0, 20_000, numPartitions=8).select(F.lit("hot").alias("k"), F.col("id")).write.parquet(f"{scratch_dir}/fact")
    fact = spark.read.parquet(f"{scratch_dir}/fact")
    dim = spark.createDataFrame([("hot", 1)], "k string, v long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = left_join_dim(fact, dim, ["k"], rows_per_task=1000)
        per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # No task holds more of the key than was read by one, and the plan counts nothing again.
    assert sum(per_task) == 20_000 and max(per_task) <= 5000
    hot_side = plan.split("SortMergeJoin")[0]
    assert "HashAggregate" not in plan and "hashpartitioning" not in hot_side


def test_left_join_dim_salted_null_keys(spark):
    fact = spark.createDataFrame([("m", None)] * 50 + [("m", "s")] * 5, "a string, b string")
    dim = spark.createDataFrame([("m", None, 1), ("m", "s", 2)], "a string, b string, v long")
    for null_safe, expect in ((False, {None: None, "s": 2}), (True, {None: 1, "s": 2})):
        out = left_join_dim(fact, dim, ["a", "b"], null_safe=null_safe,
                            rows_per_task=10).collect()
        assert len(out) == 55
        assert {r["b"]: r["v"] for r in out} == expect


def test_null_key_join_semantics(spark):
    fact = spark.createDataFrame([("m", None), ("m", "s")], "main_category string, sub_category string")
    dim = spark.createDataFrame([(1, "m", None), (2, "m", "s")],
                                "category_key long, main_category string, sub_category string")
    plain = {r["sub_category"]: r["category_key"] for r in
             left_join_dim(fact, dim, ["main_category", "sub_category"]).collect()}
    safe = {r["sub_category"]: r["category_key"] for r in
            left_join_dim(fact, dim, ["main_category", "sub_category"], null_safe=True).collect()}
    assert plain == {None: None, "s": 2}
    assert safe == {None: 1, "s": 2}


# -- upsert ------------------------------------------------------------------------------
UPS = StructType([StructField("name", StringType()), StructField("main_category", StringType()),
                  StructField("sub_category", StringType()), StructField("image", StringType()),
                  StructField("price", DoubleType()), StructField("batch", LongType())])


def _ups(spark, rows):
    return spark.createDataFrame(rows, UPS)


def _merge(spark, t, s, **kw):
    return upsert(t, s, PRODUCT_KEY, ["price", "batch"], **kw)


def test_upsert_semantics(spark):
    target = _ups(spark, [("a", "m", None, "img-a", 1.0, 1), ("b", "m", "s", "img-b", 2.0, 1),
                          ("c", "m", "s", "img-c", 3.0, 1)])
    source = _ups(spark, [("a", "m", None, "new-a", 10.0, 2), ("b", "m", "s", "new-b", 20.0, 2),
                          ("d", "m", None, "img-d", 40.0, 2)])
    out = {r["name"]: tuple(r) for r in _merge(spark, target, source).collect()}
    assert out == {
        "a": ("a", "m", None, "img-a", 10.0, 2),   # matched through a NULL key part; image kept
        "b": ("b", "m", "s", "img-b", 20.0, 2),
        "c": ("c", "m", "s", "img-c", 3.0, 1),     # untouched
        "d": ("d", "m", None, "img-d", 40.0, 2),   # inserted whole
    }


def test_upsert_idempotent_null_safe(spark):
    target = _ups(spark, [("a", "m", None, "i", 1.0, 1)])
    source = _ups(spark, [("a", "m", None, "j", 2.0, 2), ("e", None, None, "k", 5.0, 2)])
    once = _merge(spark, target, source)
    twice = _merge(spark, once, source)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)
    assert twice.count() == 2


def test_upsert_plain_equality_duplicates_null_keys(spark):
    target = _ups(spark, [("a", "m", None, "i", 1.0, 1)])
    source = _ups(spark, [("a", "m", None, "j", 2.0, 2)])
    once = _merge(spark, target, source, null_safe=False)
    twice = _merge(spark, once, source, null_safe=False)
    assert (once.count(), twice.count()) == (2, 3)


def test_assert_unique(spark):
    with pytest.raises(DuplicateKeyError):
        assert_unique(_ups(spark, [("a", "m", None, "i", 1.0, 1), ("a", "m", None, "j", 1.0, 1)]),
                      PRODUCT_KEY)
    assert_unique(_ups(spark, [("a", "m", None, "i", 1.0, 1), ("a", "m", "s", "j", 1.0, 1)]), PRODUCT_KEY)


# -- reports -----------------------------------------------------------------------------
def test_layer_counts_and_describe(spark, mock_df):
    staged = stage(as_bronze(mock_df))
    counts = {r["layer"]: r["row_count"] for r in layer_counts({"staged": staged, "raw": mock_df}).collect()}
    assert counts == {"staged": 10, "raw": 10}
    prof = {r["column_name"]: (r["data_type"], r["null_count"], r["row_count"])
            for r in describe_layer(staged, "staging").collect()}
    assert prof["ratings"] == ("double", 1, 10)
    assert prof["name"] == ("string", 1, 10)
    assert prof["is_valid"][0] == "boolean"


def test_survivor_order_constant_is_lazy():
    assert PRODUCT_SURVIVOR_ORDER[0] == ("no_of_ratings", "desc")


def test_dedup_plan_limits_before_the_shuffle(spark, scratch_dir):
    # Read from Parquet so the plan has a real shuffle between the two limits.
    spark.createDataFrame([("a", "m", "s", 1.0)], "name string, main_category string, "
                          "sub_category string, no_of_ratings double").write.parquet(f"{scratch_dir}/t")
    df = spark.read.parquet(f"{scratch_dir}/t")
    plan = dedup_by_key(df, PRODUCT_KEY, [("no_of_ratings", "desc")])._jdf.queryExecution() \
        .executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    limits = [i for i in range(len(plan)) if plan.startswith("WindowGroupLimit", i)]
    assert any(i > exchange for i in limits), plan  # a limit below the exchange (map side)
    assert any(i < exchange for i in limits), plan  # and the final one after it


def test_csv_source_matches_header_names(spark, scratch_dir):
    from strata.sources.files import read_csv_source

    path = f"{scratch_dir}/csv"
    import os

    os.makedirs(path)
    with open(f"{path}/part-0.csv", "w", encoding="utf-8") as fh:
        fh.write('Actual_Price,extra,name,main_category,sub_category,image,link,ratings,no_of_ratings,'
                 'discount_price\n')
        fh.write('"1,299",x,"Kettle, steel",home,kitchen,,,4.1,"1,024",₹999\n')
        fh.write(',y,Mug,home,,,,,,\n')
    rows = read_csv_source(spark, path).collect()
    assert [list(r.asDict()) for r in rows][0] == ["name", "main_category", "sub_category", "image", "link",
                                                   "ratings", "no_of_ratings", "discount_price",
                                                   "actual_price"]
    first, second = rows
    assert (first["name"], first["actual_price"], first["no_of_ratings"], first["discount_price"]) == (
        "Kettle, steel", "1,299", "1,024", "₹999")
    assert second["sub_category"] is None and second["actual_price"] is None
    with open(f"{path}/part-0.csv", "w", encoding="utf-8") as fh:
        fh.write("name,main_category\nA,b\n")
    with pytest.raises(ValueError):
        read_csv_source(spark, path)


def test_upsert_refuses_a_source_with_duplicate_keys(spark):
    from strata.operators.merge import DuplicateKeyError

    target = _ups(spark, [("a", "m", "s", "i", 1.0, 1)])
    source = _ups(spark, [("a", "m", "s", "i", 2.0, 2), ("a", "m", "s", "i", 3.0, 2)])
    with pytest.raises(DuplicateKeyError):
        _merge(spark, target, source)


def test_csv_files_with_different_headers(spark, scratch_dir):
    from strata.sources.files import read_csv_source, write_csv

    one = spark.createDataFrame([("n1", "c1", "s1")], "name string, cat string, sub string")
    two = spark.createDataFrame([("x", "c2", "n2", "s2")], "more string, cat string, name string, sub string")
    write_csv(one, f"{scratch_dir}/one")
    write_csv(two, f"{scratch_dir}/two")
    both = read_csv_source(spark, [f"{scratch_dir}/one", f"{scratch_dir}/two"], ("name", "cat", "sub"))
    assert sorted(map(tuple, both.collect())) == [("n1", "c1", "s1"), ("n2", "c2", "s2")]
    with pytest.raises(Exception, match="(?i)header|column"):
        read_csv_source(spark, f"{scratch_dir}/*", ("name", "cat", "sub")).collect()


def test_summaries_are_read_in_order(spark):
    from strata.plans.queries import agg_category_summary, agg_price_bucket_summary

    counts = [(-r["product_count"], r["main_category"] or "") for r in agg_category_summary(
        spark, "/root/testdata/sf0.001").collect()]
    assert counts == sorted(counts)
    labels = [r["price_bucket"] for r in agg_price_bucket_summary(spark, "/root/testdata/sf0.001").collect()]
    assert labels == sorted(labels)


def test_distinct_count_of_pairs(spark):
    from strata.operators.quality import distinct_count

    df = spark.createDataFrame([("a", None), ("a", None), ("a", "x"), (None, "x")], "k string, `l.m` string")
    assert tuple(distinct_count(df, ["k", "l.m"]).first()) == (4, 3)
    assert tuple(distinct_count(df.limit(0), ["k"]).first()) == (0, 0)


def test_malformed_lines_are_kept_whole(spark, scratch_dir):
    import os

    from strata.sources.files import read_csv_source

    lines = ['good,m,s', 'short,m', 'long,m,s,more', '"say ""hi"", ok",m,s', '"never closed,m,s', 'mid"quote,m,s', ',,', '"x" tail,m,s',
             '"two', 'lines",m,s', '  ,m,s', '"",m,s', 'é,日本,s']
    os.makedirs(f"{scratch_dir}/in")
    with open(f"{scratch_dir}/in/a.csv", "w", encoding="utf-8") as fh:
        fh.write("name,main,sub\n" + "\n".join(lines) + "\n\n")
    rows = read_csv_source(spark, f"{scratch_dir}/in", ("name", "main"), raw_line=True).collect()
    assert sorted(r.raw_line for r in rows if r.raw_line) == sorted(
        ["short,m", "long,m,s,more", '"never closed,m,s', '"two'])
    assert all((r.name, r.main) == (None, None) for r in rows if r.raw_line)
    assert {(r.name, r.main) for r in rows if not r.raw_line} == {
        ("good", "m"), ('say "hi", ok', "m"), ('mid"quote', "m"), (None, None), ('"x" tail', "m"), ('lines"', "m"),
        ("  ", "m"), (None, "m"), ("é", "日本")}
    assert len(rows) == len(lines)


def test_a_malformed_line_fails_only_that_rule(spark):
    bronze = as_bronze(spark.createDataFrame([(None,) * 7, ("n", "m", "s", "4", "1", "1", "2")],
                                             ", ".join(f"{c} string" for c in ("name", "main_category", "sub_category", "ratings",
                                                                               "no_of_ratings", "discount_price", "actual_price"))))
    staged = stage(bronze.withColumn("raw_line", F.when(F.col("name").isNull(), "a,b")))
    got = {r.raw_line: (r.is_valid, r.validation_errors) for r in staged.collect()}
    assert got == {"a,b": (False, "malformed line; "), None: (True, "")}
    assert [r.raw_line for r in dead_letter(staged, "2024-01-01 06:00:00").collect()] == ["a,b"]


# Names that operators use inside, or did.
WORKING_NAMES = ("_rn", "_salt", "_salts", "_s", "_t", "_s_k", "_t_k", "_tie", "_seq", "_part", "_pos", "_mono", "_rows", "_offset",
                 "_hk0", "_dk0", "_n", "__w0", "__w1", "__W2", "n", "k0", "row_count", "before", "after", "sign", "count")


@pytest.mark.parametrize("name", ["dedup", "upsert", "upsert_hash", "changes", "join", "join_hot", "dense_key", "distinct"])
def test_callers_columns_survive(spark, name):
    from strata.operators import changes, distinct_count
    from strata.operators.joins import key_hash

    extra = [F.lit(f"own {c}").alias(c) for c in WORKING_NAMES]
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v long").select("k", "v", *extra)
    more = spark.createDataFrame([("b", 30), ("c", 50)], "k string, v long").select("k", "v", *extra)
    hashed, more_hashed = (df.withColumn("h", key_hash(["k"])) for df in (rows.where("v <> 1"), more))
    dim = spark.createDataFrame([("a", "A"), ("b", "B")], "k string, payload string")
    out = {
        "dedup": lambda: dedup_by_key(rows, ["k"], [("v", "desc")]),
        "upsert": lambda: upsert(rows.where("v <> 1"), more, ["k"], ["v"]),
        "upsert_hash": lambda: upsert(hashed, more_hashed, ["k"], ["v"], hash_column="h").drop("h"),
        "changes": lambda: changes(rows.where("v <> 1"), more, ["k"], ["v"]).select("after.*"),
        "join": lambda: left_join_dim(rows, dim, ["k"]),
        "join_hot": lambda: left_join_dim(rows, dim, ["k"], rows_per_task=1),
        "dense_key": lambda: dense_key(rows, ["k", "v"], "key"),
        "distinct": lambda: distinct_count(rows, ["k", "n"]),
    }[name]()
    if name == "distinct":
        assert tuple(out.first()) == (4, 3)
        return
    assert out.columns[:len(rows.columns)] == rows.columns
    got = out.collect()
    assert all(r[c] == f"own {c}" for r in got for c in WORKING_NAMES)
    want = {"dedup": [("a", 2), ("b", 3), (None, 4)], "upsert": [("a", 2), ("b", 30), ("c", 50), (None, 4)],
            "changes": [("b", 30), ("c", 50)]}
    want["upsert_hash"] = want["upsert"]
    assert sorted(map(str, ((r.k, r.v) for r in got))) == sorted(map(str, want.get(name, [(r.k, r.v) for r in rows.collect()])))
    if name.startswith("join"):
        assert {r.v: r.payload for r in got} == {1: "A", 2: "A", 3: "B", 4: None}
    if name == "dense_key":
        assert [r.v for r in sorted(got, key=lambda r: r.key)] == [4, 1, 2, 3]
