"""Balanced contiguous shards from global byte-size prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import checkpoint, read_table


def shard_by_bytes(
    docs: DataFrame,
    n_shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_bits: int = 12,
    tolerance: float = 0.01,
) -> DataFrame:
    """(id, size, text_crc32, shard, slot): documents cut into contiguous shards
    of equal bytes.

    The global order is by content hash, then by a hash of the id, so that
    equal texts are neighbours. It is divided into cells (content hash and 64
    slices of the id hash); cell totals are summed map-side, then turned into
    prefix sums inside ``2**bucket_bits`` hash ranges and across the range
    totals, which are a table of that fixed size. A row's own position is its
    cell's start plus a running sum within the cell, so a text that a third of
    all rows share is still spread over 64 window partitions. Cuts fall at
    equal byte targets. A group of equal texts below ``whole_share`` of a
    shard stays in one shard; a larger one is cut between documents.

    Size is the text's UTF-8 bytes plus one. A null text has no bytes; null
    ids, repeated rows and empty texts are ordinary rows (rows alike in id and
    text are interchangeable, each takes a slot of its own). An empty table
    gives no rows. Other columns are not read, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = checkpoint(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
            F.xxhash64(F.col(id_col), F.lit("slice")).alias("g"),
        )
        .withColumn("bucket", F.shiftrightunsigned("h", 64 - bucket_bits))
        .withColumn("part", F.shiftrightunsigned("g", 58))
    )
    cells = rows.groupBy("bucket", "h", "part").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n")
    )
    everything = Window.partitionBy(F.lit(0))
    ranges = (
        cells.groupBy("bucket")
        .agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
        .select(
            "bucket",
            (F.sum("bytes").over(everything.orderBy("bucket")) - F.col("bytes")).alias("bytes_before"),
            (F.sum("n").over(everything.orderBy("bucket")) - F.col("n")).alias("n_before"),
            F.sum("bytes").over(everything).alias("total"),
        )
    )
    in_range = Window.partitionBy("bucket").orderBy("h", "part")
    group = Window.partitionBy("bucket", "h")
    placed = (
        cells.withColumns({
            "b0": F.sum("bytes").over(in_range) - F.col("bytes"),
            "n0": F.sum("n").over(in_range) - F.col("n"),
        })
        .withColumns({"group_b0": F.min("b0").over(group), "group_bytes": F.sum("bytes").over(group)})
        # At most 2**bucket_bits rows.
        .join(F.broadcast(ranges), "bucket")
        .select(
            "bucket", "h", "part", "group_bytes", "total",
            (F.col("b0") + F.col("bytes_before")).alias("b0"),
            (F.col("n0") + F.col("n_before")).alias("n0"),
            (F.col("group_b0") + F.col("bytes_before")).alias("group_b0"),
        )
    )
    in_cell = Window.partitionBy("bucket", "h", "part").orderBy("g", "id")
    running = in_cell.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # In shards: the group's ends, and the first and last target between them.
    starts = F.col("group_b0") * F.lit(n_shards) / F.col("total")
    stops = (F.col("group_b0") + F.col("group_bytes")) * F.lit(n_shards) / F.col("total")
    first_at, last_at = F.floor(starts) + 1, F.ceil(stops) - 1
    head, tail = first_at - starts, stops - last_at
    to_start = (first_at <= last_at) & (head <= tolerance) & ((first_at < last_at) | (head <= tail))
    to_stop = (first_at <= last_at) & (tail <= tolerance) & ((first_at < last_at) | (tail < head))
    own = F.floor((2 * F.col("at") + F.col("size")) * F.lit(n_shards) / (2 * F.col("total")))
    moved = F.when(to_start & (own < first_at), first_at).when(to_stop & (own >= last_at), last_at - 1).otherwise(own)
    cut = (
        rows.join(placed, ["bucket", "h", "part"])
        .withColumns({
            "at": F.col("b0") + F.sum("size").over(running) - F.col("size"),
            "row_at": F.col("n0") + F.row_number().over(in_cell) - 1,
        })
        .select(
            "id", "size", "text_crc32", "row_at",
            F.least(F.lit(n_shards - 1), moved.cast("int")).alias("shard"),
        )
    )
    cut = checkpoint(cut)
    first = cut.groupBy("shard").agg(F.min("row_at").alias("first"))
    return cut.join(F.broadcast(first), "shard").select(
        "id", "size", "text_crc32", "shard", (F.col("row_at") - F.col("first")).alias("slot")
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(read_table(spark, sf_dir, "documents"), 8).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
