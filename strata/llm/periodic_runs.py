"""Maximal periodic runs of words, found with a suffix automaton and link-cut access.

Words are appended one after another. The suffixes of the text read so far lie
on one path of the automaton's link tree; each stretch of that path carries the
place where its words last ended. Appending word ``i`` walks the path
(link-cut access), reads every stretch with its last end ``p``, and recolours
the path with ``i``. A stretch whose longest suffix has ``len`` words says that
the ``len`` words ending at ``p`` end at ``i`` again: with ``d = i - p <= len``
they form a square of period ``d``, which reaches from ``p - len + 1`` to ``i``.
As the stretch's suffix is the longest one that last ended at ``p``, that start
is the run's own, and ``d`` is its smallest period; squares of one start and
period are one run, up to the last ``i`` that shows it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from strata.llm.common import read_table, without

MIN_LENGTH = 12
#: Rows that a task hands back at once.
OUT_ROWS = 512
MIX = np.uint64(0x9E3779B97F4A7C15)

RUN = StructType([StructField(c, LongType(), False) for c in ("start", "length", "period")])


def _automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(longest suffix, suffix link) of each state, and the state of each
    prefix. A state's first edge is kept in two lists, only further ones in a
    dict, as most states have one."""
    length, link, ends = [0], [-1], []
    word, target, more = [-1], [-1], {}
    last = 0
    for i, c in enumerate(words):
        cur = len(length)
        length.append(i + 1), link.append(0), word.append(-1), target.append(-1)
        ends.append(cur)
        p = last
        while p >= 0:
            if word[p] == c:
                q = target[p]
                break
            q = more[p].get(c, -1) if p in more else -1
            if q >= 0:
                break
            if word[p] < 0:
                word[p], target[p] = c, cur
            else:
                more.setdefault(p, {})[c] = cur
            p = link[p]
        if p >= 0:
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(length)
                length.append(length[p] + 1), link.append(link[q])
                word.append(word[q]), target.append(target[q])
                if q in more:
                    more[clone] = dict(more[q])
                while p >= 0:
                    if word[p] == c:
                        if target[p] != q:
                            break
                        target[p] = clone
                    elif p in more and more[p].get(c) == q:
                        more[p][c] = clone
                    else:
                        break
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return length, link, ends


def _squares(words: list[int]) -> dict[tuple[int, int], int]:
    """(start, period) -> last word of every run of two periods or more."""
    length, link, ends = _automaton(words)
    n = len(length)
    # Splay trees over the stretches. The tree's root has no state here: a
    # parent of -1 ends a path. ``colour`` holds for the root of a splay tree.
    up = [x if x > 0 else -1 for x in link]
    left, right, colour = [-1] * n, [-1] * n, [-1] * n
    found: dict[tuple[int, int], int] = {}

    def rotate(x: int) -> None:
        y = up[x]
        z = up[y]
        if z >= 0 and left[z] == y:
            left[z] = x
        elif z >= 0 and right[z] == y:
            right[z] = x
        else:
            colour[x] = colour[y]
        if left[y] == x:
            b = left[y] = right[x]
            right[x] = y
        else:
            b = right[y] = left[x]
            left[x] = y
        if b >= 0:
            up[b] = y
        up[y], up[x] = x, z

    for i, v in enumerate(ends):
        below, x = -1, v
        while x >= 0:
            while (y := up[x]) >= 0 and (left[y] == x or right[y] == x):
                z = up[y]
                if z >= 0 and (left[z] == y or right[z] == y):
                    rotate(y if (left[y] == x) == (left[z] == y) else x)
                rotate(x)
            p = colour[x]
            if p >= 0 and length[x] >= i - p:
                found[p - length[x] + 1, i - p] = i
            if right[x] >= 0:
                colour[right[x]] = p
            right[x] = below
            below, x = x, up[x]
        colour[below] = i
    return found


def _stretches(ids: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Stretches of words that hold every run. The words ``start .. end - q``
    of a run recur ``q`` words on, and there are ``least / 2`` of them or more,
    so each word of a run is in a group of ``least // 2`` words that the text
    holds twice. Words in no such group are in no run (equal hashes of unequal
    groups only keep more)."""
    k = max(1, least // 2)
    n = len(ids) - k + 1
    if len(ids) < least:
        return []
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = (h ^ (h >> np.uint64(29))) * MIX + ids[j:j + n]
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    cover = np.zeros(len(ids) + 1, np.int64)
    twice = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + k, -1)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(cover[:-1]) > 0, [0]]).astype(np.int8)))
    return [(a, b) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if b - a >= least]


def runs_of(words: list[bytes], least: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run of ``max(least, 2 * period)``
    words or more, in that order."""
    if len(words) < least:
        return []
    number = dict(zip(words, range(len(words))))
    ids = np.fromiter(map(number.__getitem__, words), np.uint64, len(words))
    out = []
    for a, b in _stretches(ids, least):
        for (start, period), end in _squares(ids[a:b].tolist()).items():
            if end - start + 1 >= least:
                out.append((a + start, end - start + 1, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run contains after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, size, period in runs:
        drop[start + period] += 1
        drop[start + size] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, text_col: str = "text", least: int = MIN_LENGTH) -> DataFrame:
    """Adds ``n_words``, ``runs`` (array of start, length, period, by start and
    period) and ``collapsed`` (the words outside repeated periods, joined by one
    space) for every row's whole text.

    Words are maximal stretches without ASCII white space. A run is a stretch
    with a smallest period ``q`` of ``max(least, 2 * q)`` words or more that
    neither neighbouring word extends. Each row is handled alone, without a
    shuffle; time is near linear in its words however periodic they are. Null
    and empty texts have no words, no runs and an empty ``collapsed``; repeated
    rows are handled alike; other columns are kept, but input columns named
    like the three new ones are replaced.
    """
    docs = without(docs, "n_words", "runs", "collapsed")
    schema = StructType([
        *docs.schema.fields, StructField("n_words", LongType(), False),
        StructField("runs", ArrayType(RUN, False), False), StructField("collapsed", StringType(), False),
    ])
    names = [f.name for f in schema.fields]
    struct = pa.struct([pa.field(f.name, pa.int64(), False) for f in RUN.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(at, OUT_ROWS)
                sizes, found, texts = [], [], []
                for raw in part.column(text_col).cast(pa.binary()):
                    words = (raw.as_py() or b"").split()
                    mine = runs_of(words, least)
                    sizes.append(len(words))
                    found.append(mine)
                    texts.append(b" ".join(collapse(words, mine)))
                ends = np.cumsum([0, *map(len, found)])
                flat = np.array([r for f in found for r in f], np.int64).reshape(-1, 3)
                runs = pa.StructArray.from_arrays([pa.array(c) for c in flat.T], fields=list(struct))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs)
                made = [pa.array(sizes, pa.int64()), lists, pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=names)

    return docs.mapInArrow(run, schema)


def with_periodic_tail(text: Column, doc_id: Column) -> Column:
    """The text of ``op13``: a tenth of the documents, by a hash of their id,
    repeat their first words after a point as many times as fit."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    g = F.floor(h / 10)

    def tail(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        period = F.slice(w, a + 1, p)
        rest = F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(w, F.lit(1), a), F.slice(rest, F.lit(1), (n - a).cast("int"))), " ")

    made = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, tail(w)).otherwise(F.lit("")))[0]
    return F.when(h % 10 == 0, made).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", with_periodic_tail(F.col("text"), F.col("doc_id")).alias("text")
    )
    found = periodic_runs(docs).drop("text")
    # Greatest length first, then smallest start, then smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda s: F.concat(s, F.lit("\n"))), "").cast("binary"), 256)
        .alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
