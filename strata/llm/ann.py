"""Approximate nearest neighbours by cross-polytope hashing."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import checkpoint, partitions_for, read_table
from strata.llm.embed_dedup import cosines, usable

#: Tables. In each, two pseudo-rotations give a vector two signed axes; together
#: they are its cell. Rows that share the first axis are one bucket.
TABLES = 24
#: Cells that a query looks into, over all tables, for neighbours as near as the
#: k nearest of ``PROBES_AT`` random vectors. Nearer ones, such as more random
#: vectors hold, stand in likelier cells: the number falls with those rows to the
#: power ``PROBES_POWER``, down to one cell a table, and grows as smoothly for
#: farther ones. How near a query's neighbours are is first found out in
#: ``FIRST_PROBES`` cells of the first ``FIRST_TABLES`` tables.
PROBES = 1600
FIRST_TABLES = 6
FIRST_PROBES = 400
PROBES_AT = 10_000
PROBES_POWER = 0.35
SEED = 23
#: Rows and queries of a bucket that meet in one task; beyond either, a bucket
#: is dealt out in that many parts of rows times parts of queries.
ROWS_PER_SALT = 50_000
QUERIES_PER_SALT = 5_000
#: Buckets of several parts whose numbers of parts are sent to all tasks; more
#: (vectors of very many lengths) are joined.
MAX_BROADCAST = 200_000
#: Scores that a task holds at once.
SCORES = 1 << 22


def _signs(width: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, width]).choice((-1.0, 1.0), size=(tables, 3, width))


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform along the first axis (a power of two), four
    levels at a time."""
    shape, width, h = x.shape, len(x), 1
    while h < width:
        b = min(16, width // h)
        level = np.ones((1, 1))
        while len(level) < b:
            level = np.block([[level, level], [level, -level]])
        x = np.matmul(level, x.reshape(width // (h * b), b, -1))
        h *= b
    return x.reshape(shape) / np.sqrt(width)


def rotated(vectors: np.ndarray, tables: int, seed: int) -> np.ndarray:
    """(tables, rows, width): pseudo-random rotations, three rounds of random
    signs and a Hadamard transform, of vectors padded to a power of two."""
    width = 1 << max(1, (vectors.shape[1] - 1).bit_length())
    x = np.zeros((width, 1, len(vectors)))
    x[: vectors.shape[1], 0] = vectors.T
    signs = _signs(width, tables, seed)
    out = np.broadcast_to(x, (width, tables, len(vectors)))
    for r in range(3):
        out = _hadamard(out * signs[:, r].T[:, :, None])
    return out.transpose(1, 2, 0)


def _rotations(vectors: np.ndarray, tables: int, seed: int) -> np.ndarray:
    """(rows, tables, 2, width): the two rotations of each table."""
    y = rotated(vectors, 2 * tables, seed).transpose(1, 0, 2)
    return y.reshape(len(vectors), tables, 2, -1)


def _codes(table, dim: int, axis) -> np.ndarray:
    return (np.asarray(table, np.int64) << 44) + (dim << 22) + axis


def own_cells(vectors: np.ndarray, tables: int, seed: int) -> tuple[list, list]:
    """Per row and table the bucket, and the cell in it: its nearest signed axes.
    Axis i and its negative are i and i + width."""
    y = _rotations(vectors, tables, seed)
    best = np.abs(y).argmax(axis=-1)
    best += y.shape[-1] * (np.take_along_axis(y, best[..., None], -1)[..., 0] < 0)
    codes = _codes(np.arange(tables), vectors.shape[1], best[:, :, 0])
    return codes.tolist(), best[:, :, 1].tolist()


def probed_cells(vectors: np.ndarray, tables: int, probes: int | list[int], seed: int,
                 among: int | None = None) -> tuple[list, list]:
    """Per row the buckets to look into, and the cells in each: the ``probes``
    cells (one number, or one per row), over all tables or the first ``among``
    of them, whose two axes are nearest in sum."""
    among = among or tables
    near = _rotations(vectors, tables, seed)[:, :among]
    near = np.concatenate((near, -near), axis=-1)
    order = np.argsort(-near, axis=-1, kind="stable")
    codes, cells = [], []
    for a, v, asked in zip(order, near, [probes] * len(vectors) if isinstance(probes, int) else probes):
        # A cell among the best of all has both axes among the best of its table.
        top = min(v.shape[-1], math.ceil(4 * math.sqrt(asked / among)))
        a = a[..., :top]
        v = np.take_along_axis(v, a, -1)
        total = (v[:, 0, :, None] + v[:, 1, None, :]).ravel()
        some = min(asked, len(total))
        best = np.argpartition(-total, some - 1)[:some]
        table, first, second = np.unravel_index(best, (among, top, top))
        code = _codes(table, vectors.shape[1], a[table, 0, first])
        order = np.argsort(code, kind="stable")
        cut = np.flatnonzero(np.diff(code[order])) + 1
        codes.append(code[order][np.concatenate(([0], cut))].tolist())
        cells.append([c.tolist() for c in np.split(a[table, 1, second][order], cut)])
    return codes, cells


def every_cell(vectors: np.ndarray, seed: int) -> tuple[list, list]:
    """Per row all buckets of the first table. No cells stands for all."""
    width = 2 << max(1, (vectors.shape[1] - 1).bit_length())
    codes = _codes(0, vectors.shape[1], np.arange(width)).tolist()
    return [codes] * len(vectors), [[[]] * width] * len(vectors)


def rows_as_near(cosine: float, dim: int, k: int) -> float:
    """How many random vectors hold k neighbours of at least this cosine."""
    t = np.linspace(min(1.0, max(-1.0, cosine)), 1.0, 2049)
    whole = np.linspace(-1.0, 1.0, 4097)
    power = (max(3, dim) - 3) / 2
    above = np.trapezoid((1 - t * t) ** power, t) / np.trapezoid((1 - whole * whole) ** power, whole)
    return k / max(above, 1e-100)


def _placed(df: DataFrame, place: Callable[..., tuple[list, list]], cell: str) -> DataFrame:
    """(id, vector, code, cell): one row per bucket that ``place`` gives a vector
    (and its ``kth``, where the frame has that column)."""
    more = [c for c in df.columns if c == "kth"]
    kind = df.schema["vector"].dataType.simpleString()
    item = pa.int32() if cell == "int" else pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                lists = part.column("vector").to_pylist()
                codes: list = [None] * len(lists)
                cells: list = [None] * len(lists)
                for dim in {len(v) for v in lists}:
                    of = [i for i, v in enumerate(lists) if len(v) == dim]
                    given = [[part.column(c)[i].as_py() for i in of] for c in more]
                    for i, c, e in zip(of, *place(np.array([lists[i] for i in of], np.float64), *given)):
                        codes[i], cells[i] = c, e
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("vector"), pa.array(codes, pa.list_(pa.int64())),
                     pa.array(cells, pa.list_(item))],
                    names=["id", "vector", "codes", "cells"],
                )

    # Kept, as buckets are counted before they are dealt out.
    kept = checkpoint(df.mapInArrow(run, f"id long, vector {kind}, codes array<long>, cells array<{cell}>"))
    return kept.select("id", "vector", F.explode(F.arrays_zip("codes", "cells")).alias("at")).select(
        "id", "vector", F.col("at.codes").alias("code"), F.col("at.cells").alias("cell")
    )


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Where sorted rows of keys begin to differ from the row before."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _ranks(starts: np.ndarray, n: int) -> np.ndarray:
    return np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))


def _best_in_bucket(k: int):
    """For a bucket's queries and rows: each query's k best ids among the rows
    of the cells it probes, exactly, each id at its best row."""

    def some(q: np.ndarray, qid: np.ndarray, cells: list, x: np.ndarray, unit: np.ndarray, ids: np.ndarray,
             begin: dict, repeated: bool) -> tuple[np.ndarray, ...]:
        whole = np.arange(len(ids))
        asks: dict[int, list[int]] = {}
        for i, own in enumerate(cells):
            for c in own if len(own) else [-1]:
                asks.setdefault(int(c), []).append(i)
        rough = q / np.linalg.norm(q, axis=1)[:, None]
        who, row, score = [], [], []
        for c, of in asks.items():
            rows = whole if c < 0 else whole[slice(*begin.get(c, (0, 0)))]
            if len(rows):
                who.append(np.repeat(of, len(rows)))
                row.append(np.tile(rows, len(of)))
                score.append((rough[of] @ unit[rows].T).ravel())
        if not who:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        who, row, score = (np.concatenate(v) for v in (who, row, score))
        other = ids[row] != qid[who]
        who, row, score = who[other], row[other], score[other]
        # The k-th best of each query, an id counting once; what is surely
        # below it needs no exact score.
        w, s = who, score
        if repeated:
            order = np.lexsort((ids[row], who))
            at = _firsts(who[order], ids[row][order])
            w, s = who[order][at], np.maximum.reduceat(score[order], at) if len(at) else score
        order = np.lexsort((-s, w))
        kth = order[_ranks(_firsts(w[order]), len(w)) == k - 1]
        floor = np.full(len(q), -np.inf)
        floor[w[kth]] = s[kth]
        near = score >= floor[who] - 1e-9
        who, row = who[near], row[near]
        exact = cosines(q[who], x[row])
        order = np.lexsort((-exact, ids[row], who))
        order = order[_firsts(who[order], ids[row][order])]
        order = order[np.lexsort((ids[row][order], -exact[order], who[order]))]
        order = order[_ranks(_firsts(who[order]), len(order)) < k]
        return qid[who[order]], ids[row[order]], exact[order]

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(rows):
            rows = rows.sort_values("cell", kind="stable")
            x, ids, cell = np.array(rows["vector"].tolist(), np.float64), rows["id"].to_numpy(), rows["cell"].to_numpy()
            unit = x / np.linalg.norm(x, axis=1)[:, None]
            edge = np.append(_firsts(cell), len(cell))
            begin = {int(cell[a]): (a, b) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())}
            repeated = len(np.unique(ids)) < len(ids)
            step = max(1, SCORES // len(rows))
            for at in range(0, len(queries), step):
                part = queries.iloc[at:at + step]
                q = np.array(part["vector"].tolist(), np.float64)
                found.append(some(q, part["id"].to_numpy(), part["cell"].tolist(), x, unit, ids, begin, repeated))
        query, vec, score = (np.concatenate(v) for v in zip(*found)) if found else ([], [], [])
        return pd.DataFrame({"query_id": query, "vec_id": vec, "score": score}).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    return run


def _search(asked: DataFrame, index: DataFrame, parts: int, k: int) -> DataFrame:
    """(query_id, vec_id, score, rank): the k best ids of every query in the
    cells it probes. A bucket's rows are dealt to parts, its queries to other
    parts, both sized from its own counts, and every pair of parts is a task's
    group; so a hot bucket is spread out on both sides."""
    def parts_of(df: DataFrame, size: int, name: str) -> DataFrame:
        return df.groupBy("code").agg(F.ceil(F.count("*") / size).cast("int").alias(name))

    # Only buckets of several parts: at most one row per table, axis and length
    # of vectors.
    dealt = checkpoint(
        parts_of(index, ROWS_PER_SALT, "row_parts").join(parts_of(asked, QUERIES_PER_SALT, "query_parts"), "code")
        .where("row_parts > 1 or query_parts > 1")
    )
    small = dealt.count() <= MAX_BROADCAST

    def deal(df: DataFrame, own: str, all_of: str) -> DataFrame:
        return df.join(F.broadcast(dealt) if small else dealt, "code", "left").select(
            "id", "vector", "code", "cell",
            F.pmod(F.xxhash64("id"), F.coalesce(own, F.lit(1))).cast("int").alias(own[:-1]),
            F.explode(F.sequence(F.lit(0), F.coalesce(all_of, F.lit(1)) - 1)).alias(all_of[:-1]),
        )

    key = ["code", "row_part", "query_part"]
    left, right = deal(asked, "query_parts", "row_parts"), deal(index, "row_parts", "query_parts")
    local = (
        left.repartition(parts, *key).groupBy(*key)
        .cogroup(right.repartition(parts, *key).groupBy(*key))
        .applyInPandas(_best_in_bucket(k), "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return local.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn(
        "rank", F.row_number().over(best)
    ).where(F.col("rank") <= k)


def probes_for(n: float, tables: int = TABLES) -> int:
    """Cells, over all tables, that a query probes for neighbours as near as its
    nearest among ``n`` random vectors."""
    return max(tables, math.ceil(PROBES * (PROBES_AT / max(1, n)) ** PROBES_POWER))


def nearest(
    queries: DataFrame,
    rows: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tables: int = TABLES,
    probes: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest rows by
    cosine, in double precision on the vectors as given; ties to the smaller
    id; a row with the query's own id is no candidate.

    Every row is indexed: in each table it belongs to the cell of the two signed
    axes nearest to two pseudo-rotations of its vector. A query probes the
    ``probes`` likeliest cells over all tables, and is compared with all rows
    there. Unless given, the number is each query's own and follows from how near
    its k-th row of a first, fixed search is, whatever the size of the table: the
    nearer that row, the likelier are the cells of all that are nearer still
    (``probes_for`` the random vectors that have k as near). Cells that share the first axis
    travel as one bucket; a bucket that holds a third of all rows or queries is
    dealt out on both sides, and a task returns k rows per query, never all
    pairs. A query for which this finds fewer than ``k`` rows is compared, in
    the same way, with all buckets of the first table, that is with all rows.

    Vectors that are null, empty, zero or hold null or non-finite components,
    and rows with null ids, take no part; vectors of different lengths are
    never compared. Rows that repeat an id count once, at their best. Empty
    tables give no rows; other columns are not read.
    """
    def clean(df: DataFrame) -> DataFrame:
        df = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
        return df.where(F.col("id").isNotNull() & usable("vector"))

    queries, rows = clean(queries), clean(rows)
    parts = partitions_for(rows, rows.count() * tables * 300, 48 << 20)
    index = _placed(rows, lambda v: own_cells(v, tables, seed), "int")
    if probes is None:
        some = min(FIRST_TABLES, tables)
        first = _placed(queries, lambda v: probed_cells(v, tables, FIRST_PROBES, seed, some), "array<int>")
        kth = _search(first, index.where(F.shiftright("code", 44) < some), parts, k).where(F.col("rank") == k)
        known = kth.select(F.col("query_id").alias("id"), F.col("score").alias("kth"))

        def likeliest(v: np.ndarray, near: list) -> tuple[list, list]:
            own = [probes_for(rows_as_near(s or 0.0, v.shape[1], k), tables) for s in near]
            return probed_cells(v, tables, own, seed)

        asked = _placed(queries.join(known, "id", "left"), likeliest, "array<int>")
    else:
        asked = _placed(queries, lambda v: probed_cells(v, tables, max(1, probes), seed), "array<int>")
    found = checkpoint(_search(asked, index, parts, k))
    enough = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    short = checkpoint(queries.join(enough, queries["id"] == enough["query_id"], "left_anti"))
    if not short.isEmpty():
        first = _placed(rows, lambda v: own_cells(v, 1, seed), "int")
        every = _placed(short, lambda v: every_cell(v, seed), "array<int>")
        again = _search(every, first, parts, k)
        found = found.join(enough, "query_id", "left_semi").select(again.columns).union(again)
    return found.select("query_id", "rank", "vec_id", "score")


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return nearest(rows.where(F.col("vec_id") % 50 == 0), rows, 5)
