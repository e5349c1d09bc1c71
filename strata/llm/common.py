"""Helpers shared by the corpus operators of this subpackage."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The cluster names a shared folder in ``spark.checkpoint.dir``. Only where
    that is unset and the master is local (tests) is one made here."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-checkpoint-"))


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, cutting its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions_for(df: DataFrame, total_bytes: int, target_bytes: int) -> int:
    """Enough partitions that one holds about ``target_bytes``, and never fewer
    than the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(least, math.ceil(total_bytes / target_bytes))


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of a text column (nulls: none)."""
    return docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns whose names (in any case) an operator is about to add."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(id, component_id) for every end of an edge: the least id it reaches.

    Alternating large-star and small-star rounds: each round is two grouped
    minima and joins on the surviving edges, so a vertex with very many links
    is pre-aggregated map-side and no component is ever gathered. Nulls in an
    edge are ignored; self-loops keep their vertex. Rounds are logarithmic in
    the number of vertices (a chain of 3,000 takes about ten), so ``rounds`` is
    only there to raise instead of running on should the edges ever not settle.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull()
    )
    e = checkpoint(pairs.distinct())
    loops = e.where("u = v")
    e = e.where("u <> v")

    def signature(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    seen = signature(e)
    for _ in range(rounds):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u"), F.least("u", "m").alias("m")
        )
        large = both.where("v > u").join(low, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        ).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        e = checkpoint(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        now = signature(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = e.select(F.col("v").alias("id")).union(loops.select(F.col("v").alias("id"))).distinct()
    own = roots.join(e, roots["id"] == e["u"], "left_anti").select("id", F.col("id").alias("component_id"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(own)
