"""The three layers as plans over a :class:`TableStore`.

Each layer reads its input from the store, writes its outputs to the layer
tables and returns what it wrote, read back. Reading back cuts the lineage:
everything downstream of the staging table scans it once instead of
re-running cleaning and validation per action, and a lost executor only
recomputes from the last written table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strata import schemas
from strata.functions.rules import PRODUCT_RULES, Rule
from strata.operators.dedup import PRODUCT_SURVIVOR_ORDER, dedup_by_key
from strata.operators.joins import key_hash
from strata.operators.merge import changes, upsert
from strata.operators.quality import quality_count_exprs
from strata.operators.quarantine import dead_letter
from strata.operators.staging import split_valid, stage
from strata.operators.star import category_rows, dim_price_bucket, enrich, fact_rows, with_price_bucket
from strata.operators.summaries import (
    apply_delta,
    category_summary,
    category_summary_of,
    price_bucket_summary,
    price_bucket_summary_of,
    rollup,
    rollup_delta,
)
from strata.plans.tables import SilverLayout, ensure_tables, silver_layout, use_silver
from strata.sources.lineage import with_lineage
from strata.sources.store import TableStore, null_counts

# A silver table gets enough buckets for about this many rows of all parts each.
SILVER_ROWS_PER_BUCKET = 2_000_000
# A category with more fact rows than this is joined where its rows are read.
FACT_ROWS_PER_TASK = 2_000_000
# A batch of more rows than this share of silver, with rows in all of its parts, is
# not summed up before the merge: the merge rewrites all of silver and counts it as
# it does, and gold aggregates from all of it, which costs less than a second join.
BY_CHANGE_SHARE = 0.25
# A category dimension of at most so many rows, counted as it is written, is broadcast.
BROADCAST_ROWS = 200_000

# Properties of the tables that are kept by change: which state of silver a table
# holds or reflects, and silver's totals.
STATE, ROWS, NULLS, SINCE, ODD = "strata.state", "strata.rows", "strata.nulls", "strata.since", "strata.odd"
WRITING = "writing"

# The columns a repeated product takes from the newer batch in the
# source pipeline's MERGE; image and link keep the first value seen.
SILVER_UPDATE_COLUMNS = (
    "ratings", "no_of_ratings", "discount_price", "actual_price", "discount_amount",
    "discount_pct", "is_valid", "source_file", "batch_id", "ingestion_date",
)


def _concurrently(*jobs: Callable[[], object]) -> list[object]:
    """Run independent Spark jobs from driver threads; results in order.

    Spark schedules jobs from several threads side by side, so small
    independent writes overlap instead of queueing. Any failure is re-raised.
    """
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(job) for job in jobs]
        return [f.result() for f in futures]


@dataclass(frozen=True)
class RunParams:
    """Identity of one run. Operators never read the clock themselves."""

    batch_id: str
    as_of: dt.datetime
    clock: Callable[[], dt.datetime] = field(default=dt.datetime.now, compare=False)

    @property
    def ingestion_date(self) -> dt.date:
        return self.as_of.date()

    @classmethod
    def now(cls, batch_id: str | None = None) -> RunParams:
        """A fresh run: a random batch id (unless given) and the current time."""
        return cls(batch_id or str(uuid.uuid4()), dt.datetime.now())


@dataclass(frozen=True)
class Source:
    """A product source: a frame already projected onto the product columns."""

    label: str
    load: Callable[[], DataFrame]


def bronze_frame(sources: Sequence[Source], run: RunParams) -> DataFrame:
    """Union by name of every source with its lineage columns, and ``raw_line`` if
    any source has it."""
    loaded = [(src.label, src.load()) for src in sources]
    line = [schemas.RAW_LINE] if any(schemas.RAW_LINE in df.columns for _, df in loaded) else []
    frames = []
    for label, df in loaded:
        if line and schemas.RAW_LINE not in df.columns:
            df = df.withColumn(schemas.RAW_LINE, schemas.typed_null("string"))
        frames.append(with_lineage(df.select(*schemas.SOURCE_COLUMNS, *line), label, run.batch_id, run.ingestion_date))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@dataclass
class BronzeResult:
    bronze: DataFrame
    rows: int


def run_bronze(store: TableStore, sources: Sequence[Source], run: RunParams, *,
               mode: str = "overwrite") -> BronzeResult:
    """Land the batch in bronze, partitioned by ingestion date and batch.

    ``mode="overwrite"`` leaves only this batch in the table (as the source
    pipeline does). ``mode="append"`` keeps the raw history instead. Either way a
    replayed batch replaces its own rows and nothing earlier is rewritten; the
    returned frame is this batch only.
    """
    _check_mode("bronze", mode)
    ensure_tables(store)
    bronze, rows = store.replace_batch("bronze", bronze_frame(sources, run), run.batch_id,
                                       keep_others=mode == "append")
    return BronzeResult(bronze.select(*schemas.BRONZE_STORED.fieldNames()), rows)


def _check_mode(what: str, mode: str) -> None:
    if mode not in ("overwrite", "append"):
        raise ValueError(f"{what} mode must be 'overwrite' or 'append', not {mode!r}")


@dataclass
class SilverResult:
    staged: DataFrame
    dead_letter: DataFrame
    batch: DataFrame
    silver: DataFrame
    quality: dict[str, int]
    dead_letter_rows: int
    batch_rows: int
    silver_rows: int

    @property
    def valid_rows(self) -> int:
        return int(self.quality["valid_count"])

    @property
    def invalid_rows(self) -> int:
        return int(self.quality["invalid_count"])


def run_silver(store: TableStore, bronze: DataFrame, run: RunParams, *,
               rules: Sequence[Rule] = PRODUCT_RULES, keep_raw: bool = False,
               null_safe_merge: bool = True, dead_letter_mode: str = "overwrite",
               silver_buckets: int | None = None, silver_parts: int | None = None,
               by_change_share: float = BY_CHANGE_SHARE) -> SilverResult:
    """Stage, quarantine, deduplicate and merge one batch into silver.

    ``dead_letter_mode``: "overwrite" keeps only this batch's invalid rows (as
    the source pipeline does); "append" keeps every batch's, told apart by
    ``batch_id``, the run that quarantined them. A replay replaces its own.

    Silver is stored in parts by main category, and within them bucketed on a
    hash of the product key. A merge reads and rewrites only the parts that the
    batch has categories of, and joins on the hash, so it shuffles only the
    batch. The bucket count is ``silver_buckets``, or at first
    ``spark.sql.shuffle.partitions``; it grows with the table once the buckets
    hold twice ``SILVER_ROWS_PER_BUCKET``. The number of parts is
    ``silver_parts``, or at first ``SILVER_PARTS``. Asked for other numbers than
    it has, the table is dealt out anew.
    """
    _check_mode("dead_letter", dead_letter_mode)
    ensure_tables(store, silver_buckets=silver_buckets, silver_parts=silver_parts)
    # Stage once; the quality counts ride along on the same write.
    obs = Observation()
    plan = stage(bronze, rules, keep_raw=keep_raw).observe(obs, *quality_count_exprs())
    staged, _ = store.publish("staging", plan)
    quality = {k: int(v) for k, v in obs.get.items()}

    quarantined = dead_letter(staged, run.as_of, keep_raw=keep_raw, batch_id=run.batch_id)
    valid, _ = split_valid(staged)
    deduped = dedup_by_key(valid.select(*schemas.SILVER.fieldNames()), schemas.PRODUCT_KEY, PRODUCT_SURVIVOR_ORDER)

    # The batch is written first, on all cores; quarantine and the merge, which only
    # share the staged input, then run side by side.
    batch = write_batch(store, deduped)
    (dead, dead_rows), silver_rows = _concurrently(
        lambda: store.replace_batch("dead_letter", quarantined, run.batch_id, keep_others=dead_letter_mode == "append"),
        lambda: merge_into_silver(store, batch, null_safe=null_safe_merge, silver_buckets=silver_buckets,
                                  silver_parts=silver_parts, by_change_share=by_change_share))
    dead_schema = schemas.DEAD_LETTER_RAW if keep_raw else schemas.DEAD_LETTER
    return SilverResult(staged, dead.select(*dead_schema.fieldNames(), schemas.RAW_LINE), batch.rows,
                        store.read("silver"), quality, dead_rows, batch.count, silver_rows)


@dataclass
class SilverBatch:
    """Rows of unique keys as written for the merge: their number, the NULLs of
    their columns, and the parts of silver that they are in."""

    rows: DataFrame
    count: int
    nulls: tuple[int, ...]
    parts: list[int]


def write_batch(store: TableStore, deduped: DataFrame) -> SilverBatch:
    """Write rows of unique keys to ``silver_batch``."""
    layout = silver_layout(store)
    parted = deduped.withColumn(schemas.KEY_HASH, key_hash(schemas.PRODUCT_KEY)).withColumn(schemas.PART, layout.part())
    seen = Observation()
    rows, count = store.publish("silver_batch", parted.observe(seen, *_part_masks(layout.parts)))
    return SilverBatch(rows, count, store.last_metric("silver_batch").nulls[:len(schemas.SILVER.fields)],
                       _parts_of(seen.get) if count else [])


def merge_into_silver(store: TableStore, written: SilverBatch, *, null_safe: bool = True,
                      silver_buckets: int | None = None, silver_parts: int | None = None,
                      by_change_share: float = BY_CHANGE_SHARE) -> int:
    """Merge a written batch into silver; silver's rows.

    What the merge changes is summed up in ``gold_delta`` first, so that gold is
    brought up to date without reading silver again; not so for a batch of more
    than ``by_change_share`` of silver's rows that touches all of its parts.
    """
    layout, batch, touched = silver_layout(store), written.rows, written.parts
    state, rows, nulls = _silver_totals(store, layout)
    if not touched:
        _record_silver(store, layout, rows, nulls)
        return rows

    target = store.read(layout.table).where(F.col(schemas.PART).isin(touched))
    merge = {"null_safe": null_safe, "check_unique": False, "hash_column": schemas.KEY_HASH}  # deduplicated before
    args = (schemas.PRODUCT_KEY, SILVER_UPDATE_COLUMNS)
    first, counted = rows == 0, None
    if first:
        rows, nulls = written.count, list(written.nulls)
    elif written.count > by_change_share * rows and {
            int(p[schemas.PART]) for p in store.partitions(layout.table)} <= set(touched):
        counted = Observation()
    else:
        pair = changes(target, batch, *args, **merge)
        signed = pair.selectExpr("inline(array(struct(1 AS sign, after AS row), struct(-1 AS sign, before AS row)))")
        signed = signed.where("row IS NOT NULL").selectExpr("sign", "row.*")
        delta, brought = rollup_delta(with_price_bucket(signed), "sign"), Observation()
        sums = ", ".join(f"sum(nulls_{i})" for i in range(len(nulls)))
        store.publish("gold_delta", delta.observe(
            brought, F.expr(f"named_struct('rows', sum(n), 'nulls', array({sums}))").alias("brought")))
        more, more_nulls = brought.get["brought"]
        rows, nulls = rows + more, [a + b for a, b in zip(nulls, more_nulls, strict=True)]

    # A table that has outgrown its buckets, or is asked for another number, is
    # dealt out anew once; its name moves on when that is done.
    grown = -(-(rows + (written.count if counted else 0)) // SILVER_ROWS_PER_BUCKET)
    wanted = SilverLayout(silver_buckets or (grown if grown > 2 * layout.buckets else layout.buckets),
                          silver_parts or layout.parts)
    after = uuid.uuid4().hex
    if wanted != layout:
        old, layout = layout, wanted
        store.create(layout.table, layout.spec(), f"{store.root}/silver/{layout.table}")
        merged = upsert(store.read(old.table), batch, *args, **merge).withColumn(schemas.PART, layout.part())
        merged = merged.repartition(layout.buckets, schemas.KEY_HASH)
        store.replace_parts(layout.table, merged.observe(counted, null_counts(schemas.SILVER)) if counted else merged)
        use_silver(store, layout)
        store.forget(old.table)
    else:
        store.set_properties(layout.table, **{STATE: WRITING})
        # A first load is dealt to the buckets that a join would leave it in.
        merged = batch.repartition(layout.buckets, schemas.KEY_HASH) if first else upsert(target, batch, *args, **merge)
        store.replace_parts(layout.table, merged.observe(counted, null_counts(schemas.SILVER)) if counted else merged)
    if counted:
        rows, nulls = counted.get["counted"]
    store.set_properties(layout.table, **{STATE: after, ROWS: rows, NULLS: ",".join(map(str, nulls))})
    if not first and not counted:
        store.set_properties("gold_delta", **{SINCE: state, STATE: after})
    _record_silver(store, layout, rows, nulls)
    return rows


def _record_silver(store: TableStore, layout: SilverLayout, rows: int, nulls: Sequence[int]) -> None:
    store.record("silver", "", rows, nulls, schema=schemas.SILVER, location=f"{store.root}/silver/{layout.table}")


# Part numbers travel as bits of observed longs.
_BITS = 62


def _part_masks(parts: int) -> list:
    return [F.expr(f"bit_or(CASE WHEN {schemas.PART} div {_BITS} = {k} THEN shiftleft(1L, {schemas.PART} % {_BITS}) "
                   f"ELSE 0L END)").alias(f"parts_{k}") for k in range(-(-parts // _BITS))]


def _parts_of(masks: dict) -> list[int]:
    return [int(name.split("_")[1]) * _BITS + b for name, mask in masks.items() for b in range(_BITS) if mask >> b & 1]


def _silver_totals(store: TableStore, layout: SilverLayout) -> tuple[str, int, list[int]]:
    """(state, rows, NULLs of each column). They are kept as the table's properties;
    after a merge that did not end, or in a catalog new to the table, they are
    counted and the state is a new one, so that gold starts afresh."""
    kept = store.properties(layout.table)
    if kept.get(STATE, WRITING) != WRITING:
        return kept[STATE], int(kept[ROWS]), [int(n) for n in kept[NULLS].split(",")]
    if not store.partitions(layout.table):
        return uuid.uuid4().hex, 0, [0] * len(schemas.SILVER.fields)
    rows, nulls = store.read(layout.table).agg(null_counts(schemas.SILVER)).first().counted
    return uuid.uuid4().hex, rows, nulls


@dataclass
class GoldResult:
    dim_category: DataFrame
    dim_price_bucket: DataFrame
    fact: DataFrame
    agg_category: DataFrame
    agg_price_bucket: DataFrame
    fact_rows: int


def run_gold(store: TableStore, *, silver_rows: int | None = None,
             rows_per_task: int = FACT_ROWS_PER_TASK) -> GoldResult:
    """Dimensions, fact and summaries of silver as it stands.

    The counts and sums behind the summaries and the category dimension are kept
    by change (``gold_rollup``). ``silver_rows``: silver's row count when known;
    categories of more than ``rows_per_task`` rows are kept out of the fact's
    join shuffle.
    """
    ensure_tables(store)
    valid = store.read("silver").where(F.col("is_valid"))
    kept, groups, odd = _current_rollup(store, valid)
    if odd:
        bucketed = with_price_bucket(valid)
        by_category, by_bucket = category_summary(bucketed), price_bucket_summary(bucketed)
    else:
        by_category, by_bucket = category_summary_of(kept), price_bucket_summary_of(kept)
    dim_cat, dim_pb, agg_cat, agg_pb = _concurrently(
        lambda: _publish_numbered(store, "dim_category_rows", "dim_category", category_rows(kept, rows=groups)),
        lambda: store.publish("dim_price_bucket", dim_price_bucket(store.spark)),
        lambda: store.publish("agg_category_summary", by_category),
        lambda: store.publish("agg_price_bucket_summary", by_bucket),
    )
    # A dimension of counted, few rows is broadcast; of more, as Spark decides.
    category = F.broadcast(dim_cat[0]) if dim_cat[1] <= BROADCAST_ROWS else dim_cat[0]
    hot = None if silver_rows is not None and silver_rows <= rows_per_task else rows_per_task
    counts = kept.groupBy("main_category", "sub_category").agg(F.sum("n").alias("n"))
    fact, rows = _publish_numbered(store, "fact_rows", "fact_product_metrics", fact_rows(
        enrich(valid, category, dim_pb[0], rows_per_task=hot, counts=counts), rows=silver_rows))
    return GoldResult(dim_cat[0], dim_pb[0], fact, agg_cat[0], agg_pb[0], rows)


def _publish_numbered(store: TableStore, table: str, view: str, rows: DataFrame) -> tuple[DataFrame, int]:
    """Publish rows numbered within their partitions; (the view that keys them, their number)."""
    _, count = store.publish(table, rows)
    written = store.last_metric(table)
    store.record(view, "", count, (0, *written.nulls[:-2]), schema=schemas.TABLES[view], location=written.location)
    return store.read(view), count


def _current_rollup(store: TableStore, valid: DataFrame) -> tuple[DataFrame, int, int]:
    """(the rollup of silver's state, its rows, its odd values): as it is, from the
    last merge's changes, or where neither fits from all of silver."""
    state = store.properties(silver_layout(store).table).get(STATE, WRITING)
    known = state != WRITING
    kept, delta = store.properties("gold_rollup"), store.properties("gold_delta")
    if known and kept.get(STATE) == state:
        return store.read("gold_rollup"), int(kept[ROWS]), int(kept[ODD])
    if known and delta.get(STATE) == state and kept.get(STATE) == delta[SINCE]:
        plan = apply_delta(store.read("gold_rollup"), store.read("gold_delta"))
    else:
        plan = rollup(with_price_bucket(valid))
    seen = Observation()
    current, rows = store.publish("gold_rollup", plan.observe(seen, F.sum("odd").alias("odd")))
    odd = seen.get.get("odd") or 0
    store.set_properties("gold_rollup", **{STATE: state, ROWS: rows, ODD: odd})
    return current, rows, odd
