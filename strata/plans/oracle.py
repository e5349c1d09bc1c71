"""Independent DuckDB SQL for every query in :mod:`strata.plans.queries`.

The SQL rebuilds each result from the raw supplied tables (``lineitem``,
``part``) without any Spark output. Two dialect differences are bridged:

* Spark rounds a double HALF_UP on its decimal text; DuckDB rounds the
  binary value. ``r2`` rounds the decimal text in DuckDB too.
* DuckDB sorts NULLs last by default; orders here always say where NULLs go.
"""

from __future__ import annotations

from strata.plans.testdata import (
    FAILED_RUNS,
    FAULTY_BATCH_ID,
    FULL_AS_OF,
    FULL_BATCH_ID,
    HISTORY_RUNS,
    HISTORY_SPLIT_SHIPDATE,
    LISTINGS_LABEL,
    MISSING_SOURCE,
    PRODUCTS_LABEL,
)
from strata.schemas import TABLES
from strata.sources.products import LONG_LINE_EVERY, OPEN_QUOTE_EVERY, QUOTED_NAME_EVERY, SHORT_LINE_EVERY

SOURCE_COLS = ("name, main_category, sub_category, image, link, ratings, no_of_ratings, "
               "discount_price, actual_price")
SILVER_COLS = ("name, main_category, sub_category, image, link, ratings, no_of_ratings, "
               "discount_price, actual_price, discount_amount, discount_pct, is_valid, "
               "source_file, batch_id, ingestion_date")
RAW_COLS = ("name", "main_category", "sub_category", "ratings", "no_of_ratings", "discount_price", "actual_price")
DEAD_COLS = ("name", "main_category", "sub_category", "image", "link", "ratings", "no_of_ratings",
             "discount_price", "actual_price", "validation_errors", "batch_id", "failed_at")
STAGED_COLS = ("name, main_category, sub_category, image, link, ratings, no_of_ratings, "
               "discount_price, actual_price, discount_amount, discount_pct, is_valid, "
               "validation_errors, source_file, batch_id, ingestion_date")


def r2(x: str) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,17)), 2) AS DOUBLE)"


def _ts(value) -> str:
    return f"TIMESTAMP '{value.strftime('%Y-%m-%d %H:%M:%S')}'"


PRODUCTS = """
products AS (
  SELECT CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE concat('  ', p_name, ' ') END AS name,
         CASE WHEN l_orderkey % 89 = 0 THEN '   ' ELSE upper(p_type) END AS main_category,
         CASE WHEN l_orderkey % 83 = 0 THEN NULL ELSE concat(p_brand, ' ') END AS sub_category,
         concat('img/', CAST(l_partkey AS VARCHAR), '.jpg') AS image,
         concat('item/', CAST(l_partkey AS VARCHAR)) AS link,
         CASE WHEN l_linenumber = 7 THEN 'not_a_number' WHEN l_linenumber = 6 THEN '7.5'
              ELSE CAST(round((l_partkey % 51) / 10.0, 1) AS VARCHAR) END AS ratings,
         format('{:,}', l_orderkey) AS no_of_ratings,
         CASE WHEN l_orderkey % 79 = 0 THEN '-50'
              ELSE concat('₹', format('{:,.2f}', l_extendedprice * 0.1)) END AS discount_price,
         format('{:,.2f}', l_extendedprice * 0.125) AS actual_price,
         l_shipdate, l_orderkey
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

LISTINGS = """
listings AS (
  SELECT concat('P', CAST(p_partkey AS VARCHAR)) AS asin, p_name AS title, p_brand AS brand_name,
         CAST(p_size AS DOUBLE) / CAST(10.0 AS DOUBLE) AS rating_stars,
         p_partkey * 3 + 7 AS rating_count,
         CAST(floor(p_retailprice) AS DOUBLE) AS price_value,
         p_retailprice AS list_price,
         CASE WHEN p_size > 25 THEN 'In Stock' ELSE 'Limited' END AS availability
  FROM part
)"""


def listing_bronze(batch: str, as_of) -> str:
    return f"""
  SELECT title AS name, CAST(NULL AS VARCHAR) AS main_category, CAST(NULL AS VARCHAR) AS sub_category,
         CAST(NULL AS VARCHAR) AS image, CAST(NULL AS VARCHAR) AS link,
         CAST(rating_stars AS VARCHAR) AS ratings, CAST(rating_count AS VARCHAR) AS no_of_ratings,
         CAST(price_value AS VARCHAR) AS discount_price, CAST(list_price AS VARCHAR) AS actual_price,
         '{LISTINGS_LABEL}' AS source_file, '{batch}' AS batch_id, DATE '{as_of.date().isoformat()}' AS ingestion_date
  FROM listings"""


def layer_ctes(p: str, batch: str, as_of, where: str = "TRUE", raw: bool = False) -> str:
    """bronze, staged, dead letter and deduplicated silver batch, names prefixed ``p``;
    with ``raw`` the dead letter also holds the text as received."""
    received = "".join(f", {p}bronze.{c} AS raw_{c}" for c in RAW_COLS) if raw else ""
    raw_cols = "".join(f", raw_{c}" for c in RAW_COLS) if raw else ""
    return f"""
{p}bronze AS (
  SELECT {SOURCE_COLS}, '{PRODUCTS_LABEL}' AS source_file, '{batch}' AS batch_id,
         DATE '{as_of.date().isoformat()}' AS ingestion_date
  FROM products WHERE {where}
  UNION ALL {listing_bronze(batch, as_of)}
),
{p}cleaned AS (
  SELECT trim(name, ' ') AS name, lower(trim(main_category, ' ')) AS main_category,
         lower(trim(sub_category, ' ')) AS sub_category, image, link,
         TRY_CAST(replace(ratings, ',', '') AS DOUBLE) AS ratings,
         TRY_CAST(replace(no_of_ratings, ',', '') AS DOUBLE) AS no_of_ratings,
         TRY_CAST(replace(replace(discount_price, '₹', ''), ',', '') AS DOUBLE) AS discount_price,
         TRY_CAST(replace(replace(actual_price, '₹', ''), ',', '') AS DOUBLE) AS actual_price,
         source_file, batch_id, CAST(ingestion_date AS TIMESTAMP) AS ingestion_date{received}
  FROM {p}bronze
),
{p}derived AS (
  SELECT *,
    CASE WHEN actual_price IS NOT NULL AND discount_price IS NOT NULL
         THEN {r2('actual_price - discount_price')} END AS discount_amount,
    CASE WHEN actual_price IS NOT NULL AND actual_price > 0 AND discount_price IS NOT NULL
         THEN {r2('(actual_price - discount_price) / actual_price * 100')} END AS discount_pct
  FROM {p}cleaned
),
{p}checked AS (
  SELECT *, concat(
    CASE WHEN name IS NULL OR name = '' THEN 'name is null/empty; ' ELSE '' END,
    CASE WHEN main_category IS NULL OR main_category = '' THEN 'main_category is null/empty; ' ELSE '' END,
    CASE WHEN ratings IS NULL OR ratings < 0 OR ratings > 5 THEN 'ratings out of range [0-5]; ' ELSE '' END,
    CASE WHEN no_of_ratings IS NULL OR no_of_ratings < 0 THEN 'no_of_ratings < 0; ' ELSE '' END,
    CASE WHEN discount_price IS NULL OR discount_price < 0 THEN 'discount_price < 0; ' ELSE '' END,
    CASE WHEN actual_price IS NULL OR actual_price <= 0 THEN 'actual_price <= 0; ' ELSE '' END
  ) AS validation_errors
  FROM {p}derived
),
{p}staged AS (
  SELECT name, main_category, sub_category, image, link, ratings, no_of_ratings, discount_price,
         actual_price, discount_amount, discount_pct, validation_errors = '' AS is_valid,
         validation_errors, source_file, batch_id, ingestion_date{raw_cols}
  FROM {p}checked
),
{p}dead AS (
  SELECT name, main_category, sub_category, image, link,
         CAST(ratings AS VARCHAR) AS ratings, CAST(no_of_ratings AS VARCHAR) AS no_of_ratings,
         CAST(discount_price AS VARCHAR) AS discount_price, CAST(actual_price AS VARCHAR) AS actual_price,
         validation_errors, batch_id, {_ts(as_of)} AS failed_at{raw_cols}
  FROM {p}staged WHERE NOT is_valid
),
{p}silver AS (
  SELECT {SILVER_COLS} FROM (
    SELECT *, row_number() OVER (
      PARTITION BY name, main_category, sub_category
      ORDER BY no_of_ratings DESC NULLS LAST, ratings DESC NULLS LAST,
               discount_price ASC NULLS FIRST, actual_price ASC NULLS FIRST,
               image ASC NULLS FIRST, link ASC NULLS FIRST, ratings ASC NULLS FIRST,
               no_of_ratings ASC NULLS FIRST, discount_price ASC NULLS FIRST,
               actual_price ASC NULLS FIRST, discount_amount ASC NULLS FIRST,
               discount_pct ASC NULLS FIRST, is_valid ASC NULLS FIRST,
               source_file ASC NULLS FIRST, batch_id ASC NULLS FIRST,
               ingestion_date ASC NULLS FIRST) AS rn
    FROM {p}staged WHERE is_valid
  ) WHERE rn = 1
)"""


# The labels and bounds of the price ladder below, and the rule messages
# above, are those of the source pipeline.
BUCKET_CASE = ("CASE WHEN actual_price < 500.0 THEN 'Budget' WHEN actual_price < 2000.0 THEN 'Mid-Range' "
               "WHEN actual_price < 10000.0 THEN 'Premium' ELSE 'Luxury' END")
BUCKET_DIM = """
dim_pb AS (
  SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'Budget', 0.0::DOUBLE, 500.0::DOUBLE),
                        (CAST(2 AS BIGINT), 'Mid-Range', 500.0::DOUBLE, 2000.0::DOUBLE),
                        (CAST(3 AS BIGINT), 'Premium', 2000.0::DOUBLE, 10000.0::DOUBLE),
                        (CAST(4 AS BIGINT), 'Luxury', 10000.0::DOUBLE, 999999.0::DOUBLE))
         AS t(price_bucket_key, bucket_label, min_price, max_price)
)"""
GOLD_CTES = f"""
valid AS (SELECT * FROM silver WHERE is_valid),
dim_cat AS (
  SELECT CAST(row_number() OVER (ORDER BY main_category ASC NULLS FIRST, sub_category ASC NULLS FIRST)
              AS BIGINT) AS category_key, main_category, sub_category
  FROM (SELECT DISTINCT main_category, sub_category FROM valid WHERE main_category IS NOT NULL)
),
{BUCKET_DIM.strip()},
bucketed AS (SELECT *, {BUCKET_CASE} AS price_bucket FROM valid),
fact AS (
  SELECT CAST(row_number() OVER (ORDER BY v.name ASC NULLS FIRST, v.main_category ASC NULLS FIRST,
                                 v.sub_category ASC NULLS FIRST) AS BIGINT) AS product_key,
         v.name, d.category_key, pb.price_bucket_key, v.ratings, v.no_of_ratings, v.discount_price,
         v.actual_price, v.discount_pct, v.is_valid
  FROM bucketed v
  LEFT JOIN dim_cat d ON v.main_category = d.main_category AND v.sub_category = d.sub_category
  LEFT JOIN dim_pb pb ON v.price_bucket = pb.bucket_label
),
agg_cat AS (
  SELECT main_category, count(*) AS product_count, {r2('avg(ratings)')} AS avg_rating,
         {r2('avg(discount_price)')} AS avg_discount_price, {r2('avg(actual_price)')} AS avg_actual_price,
         {r2('avg(discount_pct)')} AS avg_discount_pct
  FROM bucketed GROUP BY main_category
),
agg_pb AS (
  SELECT price_bucket, count(*) AS product_count, {r2('avg(ratings)')} AS avg_rating,
         {r2('avg(discount_pct)')} AS avg_discount_pct
  FROM bucketed GROUP BY price_bucket
)"""


def full_ctes(gold: bool = False) -> str:
    body = f"WITH {PRODUCTS.strip()},\n{LISTINGS.strip()},{layer_ctes('', FULL_BATCH_ID, FULL_AS_OF)}"
    if gold:
        body += "," + GOLD_CTES
    return body


def history_ctes(raw: bool = False) -> str:
    (b1, t1), (b2, t2) = HISTORY_RUNS
    split = f"l_shipdate < TIMESTAMP '{HISTORY_SPLIT_SHIPDATE} 00:00:00'"
    merged_cols = []
    for c in SILVER_COLS.split(", "):
        if c in ("image", "link"):
            merged_cols.append(f"CASE WHEN a._t THEN a.{c} ELSE b.{c} END AS {c}")
        else:
            merged_cols.append(f"CASE WHEN b._s THEN b.{c} ELSE a.{c} END AS {c}")
    failed_summaries = "".join(
        f"UNION ALL SELECT '{b}', {_ts(t)}, NULL, NULL, NULL, NULL, NULL, NULL, 'PARTIAL FAILURE' "
        for b, t in FAILED_RUNS)
    on = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in ("name", "main_category", "sub_category"))
    return (
        f"WITH {PRODUCTS.strip()},\n{LISTINGS.strip()},"
        + layer_ctes("h1_", b1, t1, split, raw) + ","
        + layer_ctes("h2_", b2, t2, f"NOT ({split})", raw) + f""",
merged AS (
  SELECT {', '.join(merged_cols)}
  FROM (SELECT *, TRUE AS _t FROM h1_silver) a
  FULL OUTER JOIN (SELECT *, TRUE AS _s FROM h2_silver) b ON {on}
),
checkpoints AS (
  SELECT '{b1}' AS batch_id, 'BRONZE' AS layer_name, 'SUCCESS' AS status,
         (SELECT count(*) FROM h1_bronze) AS record_count, {_ts(t1)} + INTERVAL 1 SECOND AS executed_at,
         CAST(NULL AS VARCHAR) AS error_message, (SELECT count(*) FROM h1_bronze) AS batch_rows
  UNION ALL SELECT '{b1}', 'SILVER', 'SUCCESS', (SELECT count(*) FROM h1_silver),
         {_ts(t1)} + INTERVAL 2 SECOND, NULL, (SELECT count(*) FROM h1_silver)
  UNION ALL SELECT '{b1}', 'GOLD', 'SUCCESS', (SELECT count(*) FROM h1_silver),
         {_ts(t1)} + INTERVAL 3 SECOND, NULL, (SELECT count(*) FROM h1_silver)
  UNION ALL SELECT '{b2}', 'BRONZE', 'SUCCESS', (SELECT count(*) FROM h2_bronze),
         {_ts(t2)} + INTERVAL 1 SECOND, NULL, (SELECT count(*) FROM h2_bronze)
  UNION ALL SELECT '{b2}', 'SILVER', 'SUCCESS', (SELECT count(*) FROM merged),
         {_ts(t2)} + INTERVAL 2 SECOND, NULL, (SELECT count(*) FROM h2_silver)
  UNION ALL SELECT '{b2}', 'GOLD', 'SUCCESS', (SELECT count(*) FROM merged),
         {_ts(t2)} + INTERVAL 3 SECOND, NULL, (SELECT count(*) FROM merged)
  {_failed_checkpoints()}
),
run_summaries AS (
  SELECT '{b1}' AS batch_id, {_ts(t1)} AS executed_at, (SELECT count(*) FROM h1_bronze) AS bronze_rows,
         (SELECT count(*) FROM h1_silver) AS silver_rows,
         (SELECT count(*) FROM h1_staged WHERE is_valid) AS valid_rows,
         (SELECT count(*) FROM h1_staged WHERE NOT is_valid) AS invalid_rows,
         (SELECT count(*) FROM h1_dead) AS dead_lettered_rows,
         (SELECT count(*) FROM h1_silver) AS fact_rows, 'SUCCESS' AS overall_status
  UNION ALL
  SELECT '{b2}', {_ts(t2)}, (SELECT count(*) FROM h2_bronze), (SELECT count(*) FROM merged),
         (SELECT count(*) FROM h2_staged WHERE is_valid), (SELECT count(*) FROM h2_staged WHERE NOT is_valid),
         (SELECT count(*) FROM h2_dead), (SELECT count(*) FROM merged), 'SUCCESS'
  {failed_summaries}
)"""
    )


def _failed_checkpoints() -> str:
    """The audit rows of the runs whose source is missing."""
    return "".join(
        f"""
  UNION ALL SELECT '{b}', '{layer}', '{status}', 0, {_ts(t)} + INTERVAL {i} SECOND, '{error}', 0"""
        for b, t in FAILED_RUNS
        for i, (layer, status, error) in enumerate((
            ("BRONZE", "FAILED", f"FileNotFoundError: {MISSING_SOURCE}"),
            ("SILVER", "SKIPPED", "not run: an upstream layer did not succeed"),
            ("GOLD", "SKIPPED", "not run: an upstream layer did not succeed")), start=1)
    )


def _describe_silver() -> str:
    cols = [("name", "string"), ("main_category", "string"), ("sub_category", "string"),
            ("image", "string"), ("link", "string"), ("ratings", "double"),
            ("no_of_ratings", "double"), ("discount_price", "double"), ("actual_price", "double"),
            ("discount_amount", "double"), ("discount_pct", "double"), ("is_valid", "boolean"),
            ("source_file", "string"), ("batch_id", "string"), ("ingestion_date", "timestamp")]
    parts = [
        f"SELECT 'silver' AS layer, {i + 1} AS ordinal, '{c}' AS column_name, '{t}' AS data_type, "
        f"count(*) AS row_count, count(*) - count({c}) AS null_count FROM silver"
        for i, (c, t) in enumerate(cols)
    ]
    return full_ctes() + "\n" + "\nUNION ALL\n".join(parts)


def _describe_all() -> str:
    """Every declared table, counted column by column. The audit log is the full run's."""
    ctes = {"staging": "staged", "dead_letter": "dead", "fact_product_metrics": "fact", "dim_category": "dim_cat",
            "dim_price_bucket": "dim_pb", "agg_category_summary": "agg_cat", "agg_price_bucket_summary": "agg_pb"}
    log = f"""
checkpoints AS (
  SELECT '{FULL_BATCH_ID}' AS batch_id, layer_name, 'SUCCESS' AS status, n AS record_count,
         {_ts(FULL_AS_OF)} AS executed_at, CAST(NULL AS VARCHAR) AS error_message, n AS batch_rows
  FROM (SELECT 'BRONZE' AS layer_name, count(*) AS n FROM bronze UNION ALL SELECT 'SILVER', count(*) FROM silver
        UNION ALL SELECT 'GOLD', count(*) FROM fact)
)"""
    parts = [
        f"SELECT '{table}' AS layer, {i} AS ordinal, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type, "
        f"count(*) AS row_count, count(*) - count({f.name}) AS null_count FROM {ctes.get(table, table)}"
        for table, schema in TABLES.items() for i, f in enumerate(schema.fields, 1)
    ]
    return full_ctes(gold=True) + "," + log + "\n" + "\nUNION ALL\n".join(parts)


def _malformed() -> str:
    """The products as quoted lines; what reads back of a well-formed one is the product."""
    def field(c: str) -> str:
        value = f"coalesce({c}, '')"
        if c == "name":
            value = (f"CASE WHEN l_orderkey % {QUOTED_NAME_EVERY} = 0 THEN concat('\"\"', {value}, '\"\", new') "
                     f"ELSE {value} END")
        return f"concat('\"', {value}, '\"')"

    fields = [field(c) for c in SOURCE_COLS.split(", ")]
    whole, short = f"concat_ws(',', {', '.join(fields)})", f"concat_ws(',', {', '.join(fields[:-2])})"
    last = f"concat_ws(',', {', '.join(SOURCE_COLS.split(', ')[-2:])})"
    plain = layer_ctes("f_", FAULTY_BATCH_ID, FULL_AS_OF, f"""NOT (l_orderkey % {SHORT_LINE_EVERY} = 0
      OR l_orderkey % {LONG_LINE_EVERY} = 0 OR l_orderkey % {OPEN_QUOTE_EVERY} = 0)""")
    return f"""WITH clean_products AS (SELECT * FROM ({PRODUCTS.strip().removeprefix('products AS (').removesuffix(')')})),
products AS (
  SELECT * REPLACE (CASE WHEN l_orderkey % {QUOTED_NAME_EVERY} = 0 THEN concat('"', coalesce(name, ''), '", new')
                         ELSE name END AS name) FROM clean_products
),
listings AS (SELECT '' AS title, 0.0 AS rating_stars, 0 AS rating_count, 0.0 AS price_value, 0.0 AS list_price WHERE false),
lines AS (
  SELECT CASE WHEN l_orderkey % {SHORT_LINE_EVERY} = 0 THEN {short}
              WHEN l_orderkey % {LONG_LINE_EVERY} = 0 THEN concat({whole}, ',"more","still more"')
              WHEN l_orderkey % {OPEN_QUOTE_EVERY} = 0 THEN concat({short}, ',"', {last}) END AS raw_line
  FROM clean_products
),{plain}
SELECT 'dead_letter' AS layer, CAST(NULL AS VARCHAR) AS name, raw_line, 'malformed line; ' AS validation_errors
FROM lines WHERE raw_line IS NOT NULL
UNION ALL SELECT 'dead_letter', name, NULL, validation_errors FROM f_dead
UNION ALL SELECT 'silver', name, NULL, '' FROM f_silver"""


def _layer_counts() -> str:
    tables = [("bronze", "bronze"), ("staging", "staged"), ("silver", "silver"),
              ("dead_letter", "dead"), ("dim_category", "dim_cat"), ("dim_price_bucket", "dim_pb"),
              ("fact_product_metrics", "fact"), ("agg_category_summary", "agg_cat"),
              ("agg_price_bucket_summary", "agg_pb")]
    parts = [f"SELECT '{name}' AS layer, count(*) AS row_count FROM {cte}" for name, cte in tables]
    return full_ctes(gold=True) + "\n" + "\nUNION ALL\n".join(parts)


def oracle_queries() -> dict[str, str]:
    full = full_ctes()
    gold = full_ctes(gold=True)
    hist = history_ctes()
    return {
        "scan_csv": f"WITH {PRODUCTS.strip()} SELECT {SOURCE_COLS} FROM products",
        "scan_table": f"WITH {LISTINGS.strip()} SELECT * FROM listings",
        "bronze_map_columns": f"WITH {LISTINGS.strip()} {listing_bronze(FULL_BATCH_ID, FULL_AS_OF)}",
        "bronze_union": f"{full} SELECT * FROM bronze",
        "write_overwrite": f"{hist} SELECT * FROM h2_bronze",
        "silver_clean": f"{full} SELECT * FROM cleaned",
        "silver_derive": f"{full} SELECT * FROM derived",
        "silver_validate": f"{full} SELECT {STAGED_COLS} FROM staged",
        "valid_invalid_split": f"{full} SELECT {STAGED_COLS}, CASE WHEN is_valid THEN 'valid' ELSE 'invalid' END AS side FROM staged",
        "dead_letter": f"{full} SELECT * FROM dead",
        "dead_letter_raw": f"{history_ctes(raw=True)} SELECT * FROM h1_dead UNION ALL SELECT * FROM h2_dead",
        "dead_letter_review": f"{full} SELECT name, main_category, validation_errors, batch_id, failed_at FROM dead",
        "table_by_name": f"""{full}
SELECT 'silver' AS layer, name, main_category, batch_id FROM silver
UNION ALL SELECT 'dead_letter', name, main_category, batch_id FROM dead""",
        "quality_report": f"""{full}
SELECT count(*) AS total_staged, count(*) FILTER (WHERE is_valid) AS valid_count,
       count(*) FILTER (WHERE NOT is_valid) AS invalid_count,
       CASE WHEN count(*) > 0
            THEN {r2('CAST(count(*) FILTER (WHERE is_valid) AS DOUBLE) / count(*) * 100')}
            ELSE 0.0 END AS valid_rate,
       count(*) - count(name) AS null_name, count(*) - count(main_category) AS null_main_category,
       count(*) - count(ratings) AS null_ratings, count(*) - count(no_of_ratings) AS null_no_of_ratings,
       count(*) - count(discount_price) AS null_discount_price,
       count(*) - count(actual_price) AS null_actual_price
FROM staged""",
        "distinct_category_pairs": f"""{full}
SELECT (SELECT count(*) FROM staged) AS row_count,
       (SELECT count(*) FROM (SELECT DISTINCT main_category, sub_category FROM staged)) AS distinct_count""",
        "silver_dedup": f"{full} SELECT * FROM silver",
        "dead_letter_summary": f"""{full}
SELECT validation_error, count(*) AS error_count
FROM (SELECT unnest(string_split(validation_errors, '; ')) AS validation_error FROM dead)
WHERE validation_error <> '' GROUP BY validation_error""",
        "dead_letter_sample": f"""{full}
SELECT * FROM dead ORDER BY {', '.join(c + ' ASC NULLS FIRST' for c in DEAD_COLS)} LIMIT 10""",
        "silver_upsert": f"{hist} SELECT * FROM merged",
        "silver_upsert_twice": f"{hist} SELECT * FROM merged",
        "dim_category": f"{gold} SELECT * FROM dim_cat",
        "price_bucket": f"{gold} SELECT name, main_category, sub_category, actual_price, price_bucket FROM bucketed",
        "surrogate_key": f"""{gold}
SELECT CAST(row_number() OVER (ORDER BY name ASC NULLS FIRST, main_category ASC NULLS FIRST,
                               sub_category ASC NULLS FIRST) AS BIGINT) AS product_key,
       name, main_category, sub_category FROM valid""",
        "fact_join_category": f"""{gold}
SELECT v.*, d.category_key FROM valid v
LEFT JOIN dim_cat d ON v.main_category = d.main_category AND v.sub_category = d.sub_category""",
        "fact_join_category_salted": f"""{gold}
SELECT v.*, d.category_key FROM valid v
LEFT JOIN dim_cat d ON v.main_category = d.main_category AND v.sub_category = d.sub_category""",
        "fact_join_bucket": f"""{gold}
SELECT b.name, b.main_category, b.sub_category, b.actual_price, b.price_bucket, pb.price_bucket_key
FROM bucketed b LEFT JOIN dim_pb pb ON b.price_bucket = pb.bucket_label""",
        "fact_product_metrics": f"{gold} SELECT * FROM fact",
        "agg_category_summary": f"{gold} SELECT * FROM agg_cat",
        "agg_price_bucket_summary": f"{gold} SELECT * FROM agg_pb",
        "layer_counts": _layer_counts(),
        "describe_layer": _describe_silver(),
        "describe_layers": _describe_all(),
        "gold_after_change": f"""{hist}
SELECT main_category, count(*) AS product_count, {r2('avg(ratings)')} AS avg_rating,
       {r2('avg(discount_price)')} AS avg_discount_price, {r2('avg(actual_price)')} AS avg_actual_price,
       {r2('avg(discount_pct)')} AS avg_discount_pct
FROM merged GROUP BY main_category""",
        "malformed_lines": _malformed(),
        "checkpoint_log": f"{hist} SELECT * FROM checkpoints",
        "checkpoint_latest": f"{hist} SELECT * FROM checkpoints ORDER BY executed_at DESC, batch_id DESC, layer_name LIMIT 10",
        "run_summary": f"{hist} SELECT * FROM run_summaries",
    }
