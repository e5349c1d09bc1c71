"""Embedding near-duplicates by Euclidean p-stable hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import checkpoint, components, partitions_for, read_table

#: Tables, quantised projections in each, and the quantum. At cosine 0.95 (unit
#: distance 0.316) one projection agrees with probability 0.76, six with 0.195;
#: 60 tables all miss with probability 2e-6.
TABLES = 60
PROJECTIONS = 6
QUANTUM = 1.05
SEED = 11
#: Rows of one bucket that are compared at once; larger buckets are dealt out
#: in pairs of blocks of this size.
BLOCK = 1024


def projections(dim: int, tables: int = TABLES, k: int = PROJECTIONS, seed: int = SEED):
    """Gaussian directions (dim, tables * k) and offsets in [0, 1)."""
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((dim, tables * k)), rng.random(tables * k)


def bucket_ids(unit: np.ndarray, tables: int, k: int, quantum: float, seed: int) -> np.ndarray:
    """(rows, tables) 64-bit bucket ids of unit vectors."""
    directions, offsets = projections(unit.shape[1], tables, k, seed)
    cells = np.floor(unit @ directions / quantum + offsets).astype(np.int64).reshape(len(unit), tables, k)
    out = np.zeros((len(unit), tables), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = (out ^ cells[:, :, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out.astype(np.int64)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosine of float64 vectors, each row computed alike."""
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def usable(vector: str) -> Column:
    """Neither null nor empty nor zero, and without null or non-finite components."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)


def _link_groups(batches: Iterator[pa.RecordBatch], threshold: float, tables: int, k: int,
                 quantum: float, seed: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by (part, bucket, first, second, side). A group is
    held while it is read: at most two blocks."""
    held: list[tuple] = []

    def compare(key: tuple, ids, mult, side, vectors) -> tuple[list, list, list]:
        first, second = key[2], key[3]
        x = np.stack(vectors).astype(np.float64)
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        if first == second:
            left = right = np.arange(len(ids))
        else:
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        a, b = np.nonzero(unit[left] @ unit[right].T >= threshold - 1e-9)
        a, b = left[a], right[b]
        if first == second:
            a, b = a[a < b], b[a < b]
        if len(a):
            sure = np.concatenate([
                cosines(x[a[i:i + 65536]], x[b[i:i + 65536]]) for i in range(0, len(a), 65536)
            ]) >= threshold
            a, b = a[sure], b[sure]
        if len(a) and key[0]:
            # Count a pair only in the first table where the two meet.
            met, place = np.unique(np.concatenate((a, b)), return_inverse=True)
            codes = bucket_ids(unit[met], tables, k, quantum, seed)[:, : key[0]]
            pa_, pb = place[: len(a)], place[len(a):]
            new = np.concatenate([
                ~(codes[pa_[i:i + 65536]] == codes[pb[i:i + 65536]]).any(axis=1) for i in range(0, len(a), 65536)
            ])
            a, b = a[new], b[new]
        if not len(a):
            return [], [], []
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, a, mult[b])
        np.add.at(links, b, mult[a])
        # Labels settle to the least id reached inside the group: one edge per
        # row keeps the group's connections.
        root = ids.copy()
        while True:
            low = root.copy()
            np.minimum.at(low, a, root[b])
            np.minimum.at(low, b, root[a])
            if (low == root).all():
                break
            root = low
        at = np.flatnonzero(links)
        return ids[at].tolist(), links[at].tolist(), root[at].tolist()

    def flush(rows: list[tuple]) -> tuple[list, list, list]:
        ids = np.array([r[1] for r in rows], np.int64)
        return compare(rows[0][0], ids, np.array([r[2] for r in rows], np.int64),
                       np.array([r[3] for r in rows], np.int8), [r[4] for r in rows])

    out: tuple[list, list, list] = ([], [], [])
    for batch in batches:
        flat = batch.column("vector")
        values, ends = flat.values.to_numpy(zero_copy_only=False), flat.offsets.to_numpy()
        cols = [batch.column(c).to_numpy() for c in ("part", "bucket", "first", "second", "id", "mult", "side")]
        key_rows = np.stack([c.astype(np.int64) for c in cols[:4]], axis=1)
        cut = np.flatnonzero((key_rows[1:] != key_rows[:-1]).any(axis=1)) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
            key = tuple(key_rows[lo].tolist())
            if held and held[0][0] != key:
                if len(held) > 1:
                    for o, new in zip(out, flush(held)):
                        o += new
                held = []
            held += [
                (key, int(cols[4][i]), int(cols[5][i]), int(cols[6][i]), values[ends[i]:ends[i + 1]])
                for i in range(lo, hi)
            ]
        if len(out[0]) > 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=["id", "links", "root"])
            out = ([], [], [])
    if len(held) > 1:
        for o, new in zip(out, flush(held)):
            o += new
    yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=["id", "links", "root"])


def embedding_groups(
    vectors: DataFrame,
    threshold: float = 0.95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tables: int = TABLES,
    projections_per_table: int = PROJECTIONS,
    quantum: float = QUANTUM,
    seed: int = SEED,
    block: int = BLOCK,
) -> DataFrame:
    """(id, n_links, component_id, kept) of vectors linked at cosine
    ``threshold`` or more.

    Equal vectors become one class with a count before anything else. Unit
    vectors of the classes are hashed by quantised random projections into
    several tables; classes that share a bucket are compared exactly, in double
    precision, on the vectors as given. A bucket beyond ``block`` rows is dealt
    out as pairs of blocks, so no task holds more than two blocks of it, and
    only per-row link counts and one edge per row leave a task, never all
    pairs. A pair that meets in several tables counts in the first.

    Recall for pairs at exactly 0.95 is above 0.9999 with the default tables,
    and higher above. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing; vectors of different lengths do
    not link. Rows with a null id keep a row that links with nothing. Rows
    repeating an id are one vertex to components, but each equal row counts as
    a link. Empty tables give no rows; other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    good = rows.where(F.col("id").isNotNull() & usable("vector"))
    # 0.0 and -0.0 compare alike; grouping makes them one.
    classes = checkpoint(good.groupBy("vector").agg(F.min("id").alias("rep"), F.count("*").alias("mult")))
    n = classes.count()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column("vector").to_pylist()
                buckets = np.zeros((len(lists), tables), np.int64)
                for dim in {len(v) for v in lists}:
                    of = [i for i, v in enumerate(lists) if len(v) == dim]
                    x = np.array([lists[i] for i in of], np.float64)
                    x /= np.linalg.norm(x, axis=1)[:, None]
                    # Lengths hash apart.
                    buckets[of] = bucket_ids(x, tables, projections_per_table, quantum, seed) ^ (dim * 0x5851F42D)
                yield pa.RecordBatch.from_arrays(
                    [part.column("rep"), part.column("mult"), part.column("vector"),
                     pa.array(buckets.tolist(), pa.list_(pa.int64()))],
                    names=["id", "mult", "vector", "buckets"],
                )

    element = classes.schema["vector"].dataType.simpleString()
    spread = (
        classes.select("rep", "mult", "vector")
        .mapInArrow(hashed, f"id long, mult long, vector {element}, buckets array<long>")
        .select("id", "mult", "vector", F.posexplode("buckets").alias("part", "bucket"))
    )
    sizes = spread.groupBy("part", "bucket").agg(F.count("*").alias("size")).where("size > 1").select(
        "part", "bucket", F.ceil(F.col("size") / block).cast("int").alias("blocks")
    )
    # Each row's own block, then one task for every pair of blocks.
    mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = (
        spread.join(sizes, ["part", "bucket"])
        .withColumn("own", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "part", "bucket", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"),
            "id", "mult", F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "vector",
        )
    )
    parts = partitions_for(vectors, n * tables * 300, 48 << 20)
    found = checkpoint(
        dealt.repartition(parts, "part", "bucket", "first", "second")
        .sortWithinPartitions("part", "bucket", "first", "second", "side", "id")
        .mapInArrow(
            lambda b: _link_groups(b, threshold, tables, projections_per_table, quantum, seed),
            "id long, links long, root long",
        )
    )
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    reached = components(found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = (
        classes.join(counts, F.col("rep") == counts["id"], "left").drop("id")
        .join(reached, F.col("rep") == reached["id"], "left")
        .select(
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
            F.coalesce("component_id", "rep").alias("component_id"),
        )
    )
    linked = good.join(named, "vector").select("id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(F.col("id").isNotNull() & usable("vector"), F.lit(False))).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return linked.union(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(read_table(spark, sf_dir, "embeddings"), 0.95).select(
        F.col("id").alias("vec_id"), "n_links", "component_id", "kept"
    )
