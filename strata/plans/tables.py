"""The layer tables: their declared schemas, how each is written, and silver's layout."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.operators.keys import numbered
from strata.sources.store import BATCHES, LOG, METRICS, PARTS, Buckets, TableSpec, TableStore

# A new silver table has so many parts, by a hash of the main category: batches
# of few categories rewrite few parts. A file is a bucket of a part, so a large
# table bears many more.
SILVER_PARTS = 8
SILVER_TABLE = "strata.table"

LAYER_TABLES: dict[str, TableSpec] = {
    "bronze": TableSpec(schemas.BRONZE_STORED, BATCHES, ("ingestion_date", "batch_id"),
                        optional=frozenset([schemas.RAW_LINE]), shown=schemas.BRONZE),
    "staging": TableSpec(schemas.STAGING_STORED, optional=schemas.RAW_COLUMNS, shown=schemas.STAGING),
    "dead_letter": TableSpec(schemas.DEAD_LETTER_STORED, BATCHES, ("batch_id",), optional=schemas.RAW_COLUMNS,
                             shown=schemas.DEAD_LETTER),
    "silver_batch": TableSpec(schemas.SILVER_PARTED),
    "gold_delta": TableSpec(schemas.GOLD_DELTA),
    "gold_rollup": TableSpec(schemas.GOLD_ROLLUP),
    "dim_category_rows": TableSpec(schemas.DIM_CATEGORY_ROWS),
    "dim_price_bucket": TableSpec(schemas.DIM_PRICE_BUCKET),
    "fact_rows": TableSpec(schemas.FACT_ROWS),
    "agg_category_summary": TableSpec(schemas.AGG_CATEGORY_SUMMARY),
    "agg_price_bucket_summary": TableSpec(schemas.AGG_PRICE_BUCKET_SUMMARY),
    "checkpoints": TableSpec(schemas.CHECKPOINTS, LOG),
    "run_summaries": TableSpec(schemas.RUN_SUMMARY, LOG),
}


# Views that give the rows of a table their dense key, their first column.
NUMBERED = {"dim_category": "dim_category_rows", "fact_product_metrics": "fact_rows"}


@dataclass(frozen=True)
class SilverLayout:
    """Silver as stored: parts by category, each in buckets by key hash."""

    buckets: int
    parts: int

    @property
    def table(self) -> str:
        return f"silver_b{self.buckets}_p{self.parts}"

    def spec(self) -> TableSpec:
        return TableSpec(schemas.SILVER_PARTED, PARTS, (schemas.PART,),
                         Buckets(self.buckets, schemas.KEY_HASH), shown=schemas.SILVER)

    def part(self) -> Column:
        return F.pmod(F.xxhash64("main_category"), F.lit(self.parts)).cast("int")

    @classmethod
    def of(cls, text: str) -> SilverLayout | None:
        found = re.search(r"silver_b([0-9]+)_p([0-9]+)$", text)
        return cls(int(found[1]), int(found[2])) if found else None


def ensure_tables(store: TableStore, *, silver_buckets: int | None = None, silver_parts: int | None = None) -> None:
    """Make the database and every layer table that does not exist yet, empty."""
    first = "fact_rows" not in store.specs
    store.ensure(LAYER_TABLES)
    if not first:
        return
    for view, rows in NUMBERED.items():
        key, *columns = schemas.TABLES[view].fieldNames()
        if not store.exists(view):
            store.view(view, numbered(store.name(rows), schemas.ROW_PART, schemas.ROW_POS, key, columns))
    if not store.exists("silver"):
        known = SilverLayout.of(store.last_locations().get("silver", ""))
        use_silver(store, known or SilverLayout(
            silver_buckets or int(store.spark.conf.get("spark.sql.shuffle.partitions")),
            silver_parts or SILVER_PARTS))
    else:
        layout = silver_layout(store)
        store.specs[layout.table] = layout.spec()


def use_silver(store: TableStore, layout: SilverLayout) -> None:
    """Let the name ``silver`` read the table of that layout."""
    store.create(layout.table, layout.spec(), f"{store.root}/silver/{layout.table}")
    cols = ", ".join(f"`{c}`" for c in schemas.SILVER.fieldNames())
    store.view("silver", f"SELECT {cols} FROM {store.name(layout.table)}", {SILVER_TABLE: layout.table})


def silver_layout(store: TableStore) -> SilverLayout:
    return SilverLayout.of(store.properties("silver")[SILVER_TABLE])


def describe_tables(store: TableStore) -> DataFrame:
    """(layer, ordinal, column_name, data_type, row_count, null_count) of every
    declared table, from what the writes observed: no table is read but
    ``layer_metrics``. A table's entries are the last of each of its parts."""
    last = store.read(METRICS).where(F.col("layer").isin(*schemas.TABLES)).groupBy("layer", "part", "ordinal").agg(
        F.max_by(F.struct("column_name", "data_type", "row_count", "null_count"), "write_no").alias("m"))
    return last.groupBy("layer", F.col("ordinal").cast("int").alias("ordinal"), "m.column_name", "m.data_type").agg(
        F.sum("m.row_count").alias("row_count"), F.sum("m.null_count").alias("null_count"))
