"""Ranked lexical search by the NRA algorithm over impact-sorted lists.

Documents are split among tasks. Each task keeps, for every query term, its
documents' postings in falling order of impact, and reads the lists of one
query side by side, from the front only. A document seen in some of the lists
has a lower bound (what was read) and an upper bound (that, and the next
unread impact of every list it has not been seen in). Reading goes on until no
unseen document can reach the k-th lower bound and every document that can has
equal bounds; so members, ties and scores are final. The tasks' best k are
then ranked together.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from strata.llm.common import checkpoint, read_table

#: Distinct terms of the items that are searched in one pass over the documents.
TERMS_A_PASS = 200_000
#: Postings that a task sorts and searches at once.
POSTINGS_A_BLOCK = 2_000_000
#: Postings read from each list in the first round; every round doubles it.
FIRST_DEPTH = 128
#: Bytes of a text that are taken apart at once.
PIECE = 1 << 22

_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def count_terms(raw: bytes) -> Counter:
    """Occurrences of each term of a UTF-8 text. Separators are all ASCII, so
    bytes can be mapped and split; long texts piece by piece."""
    counts: Counter = Counter()
    at = 0
    while at < len(raw):
        end = min(len(raw), at + PIECE)
        while end < len(raw) and _LETTERS[raw[end]] != 32:
            end += 1
        counts.update(raw[at:end].translate(_LETTERS).split())
        at = end
    return counts


def _passes(items: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[tuple[dict, dict]]:
    """(term -> number, item -> its terms' numbers), each for as many items as
    have ``limit`` terms together. Items stream through the driver by id."""
    number: dict[bytes, int] = {}
    queries: dict[int | None, set[int]] = {}
    rows = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("binary").alias("t")).orderBy("i")
    for row in rows.toLocalIterator():
        if row.i not in queries and len(number) >= limit:
            yield number, queries
            number, queries = {}, {}
        queries.setdefault(row.i, set()).update(
            number.setdefault(t, len(number)) for t in count_terms(bytes(row.t or b""))
        )
    if queries:
        yield number, queries


def _postings(docs: DataFrame, id_col: str, text_col: str, number: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of each document with a term: its length, and
    which of the numbered terms it holds how often."""
    schema = StructType([
        StructField("doc_id", LongType()), StructField("n", LongType()),
        StructField("terms", ArrayType(IntegerType(), False)), StructField("tfs", ArrayType(IntegerType(), False)),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.keys()
        for batch in batches:
            ids, sizes, terms, tfs, ends = [], [], [], [], [0]
            for doc, raw in zip(batch.column(0), batch.column(1)):
                counts = count_terms(raw.as_py() or b"")
                if not counts:
                    continue
                held = counts.keys() & known
                ids.append(doc.as_py())
                sizes.append(counts.total())
                terms.extend(map(number.__getitem__, held))
                tfs.extend(map(counts.__getitem__, held))
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32())),
            ], names=schema.fieldNames())

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("raw"))
    return narrow.mapInArrow(run, schema)


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, floor: int = 0,
        first: int = FIRST_DEPTH) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, scores, postings read): all of the first ``n_docs`` whose sum
    over ``lists`` (document numbers, falling impacts) is positive and at least
    ``floor`` and among the ``k`` greatest, with everything equal to the k-th.
    ``floor`` is a sum that others are known to reach ``k`` times already."""
    lower = np.zeros(n_docs, np.int64)
    depth, reach = [0] * len(lists), first
    while True:
        ahead = []
        for t, (who, impact) in enumerate(lists):
            end = min(len(who), reach)
            lower[who[depth[t]:end]] += impact[depth[t]:end]
            depth[t] = end
            ahead.append(int(impact[end]) if end < len(who) else 0)
        unseen = sum(ahead)
        touched = np.flatnonzero(lower)
        bar = floor
        if len(touched) >= k:
            bar = max(bar, int(np.partition(lower[touched], len(touched) - k)[len(touched) - k]))
        if unseen < bar or unseen == 0:
            # What a document may still get: the next impacts of all lists, but
            # for those it has been read from.
            rest = np.full(n_docs, unseen, np.int64)
            for t, (who, _) in enumerate(lists):
                if ahead[t]:
                    rest[who[:depth[t]]] -= ahead[t]
            able = touched[lower[touched] + rest[touched] >= max(bar, 1)]
            if not rest[able].any():
                return able, lower[able], sum(depth)
        reach *= 2


def _search_block(ids, terms, tfs, owners, sizes, weights, mean, queries, k, best):
    """Search one block of documents for every item; ``best`` (item -> ids,
    scores) is brought up to date."""
    n_total, l_total = mean
    m = 50 + (50 * sizes * n_total) // l_total
    impact = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m[owners]))
    order = np.lexsort((owners, -impact, terms))
    order = order[impact[order] > 0]
    terms, owners, impact = terms[order], owners[order], impact[order]
    held = np.unique(terms, return_index=True)
    stops = [*held[1][1:].tolist(), len(terms)]
    lists = {t: (owners[a:b], impact[a:b]) for t, a, b in zip(held[0].tolist(), held[1].tolist(), stops)}
    for item, wanted in queries.items():
        mine = [lists[t] for t in wanted if t in lists]
        if not mine:
            continue
        old_ids, old_scores = best.get(item, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        floor = int(old_scores[-1]) if len(old_scores) == k else 0
        docs, scores, _ = nra(mine, len(ids), k, floor)
        docs, scores = np.concatenate([old_ids, ids[docs]]), np.concatenate([old_scores, scores])
        top = np.lexsort((docs, -scores))[:k]
        best[item] = docs[top], scores[top]


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", terms_a_pass: int = TERMS_A_PASS,
                   postings_a_block: int = POSTINGS_A_BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a
    positive score, equal scores by ascending id, nulls last.

    Terms are maximal stretches of ASCII letters and digits and characters
    beyond ASCII, A-Z lower-cased. With N documents holding a term, L terms in
    all, a document of n terms and a term in df documents, tf times in this
    one: ``w = floor(1000 ln((2N + 2) / (2df + 1)))``, ``m = 50 + 50nN div L``,
    and a score sums ``w * (10^9 tf div (1000 tf + 20m))`` over the item's
    distinct terms.

    Every row is a document of its own, repeated rows and ids too; item rows of
    one id are one item with all their terms. Null and empty texts have no
    terms; a document without terms is not counted, an item without terms has
    no rows; empty tables give none. Ids must be integers. Other columns are
    left out.

    One pass over the documents serves items of up to ``terms_a_pass`` distinct
    terms (a single item is never cut); their terms are sent to the tasks, the
    documents' postings are checkpointed once, and nothing but each task's best
    ``k`` per item is shuffled.
    """
    spark = docs.sparkSession
    out_schema = StructType([StructField(c, LongType()) for c in ("item_id", "doc_id", "score")])
    none_last = np.iinfo(np.int64).max
    results = None
    for number, queries in _passes(items, item_col, item_text_col, terms_a_pass):
        postings = checkpoint(_postings(docs, id_col, text_col, number))
        n_total, l_total = postings.agg(F.count("*"), F.sum("n")).first()
        if not n_total:
            continue
        weights = np.zeros(len(number), np.int64)
        held = postings.select(F.explode("terms").alias("t")).groupBy("t").count()
        for t, df in held.toLocalIterator():
            weights[t] = math.floor(1000 * math.log((2 * n_total + 2) / (2 * df + 1)))
        wanted = {i: sorted(terms) for i, terms in queries.items()}

        def run(batches, weights=weights, wanted=wanted, mean=(n_total, l_total)):
            best: dict = {}

            def search(parts):
                table = pa.Table.from_batches(parts).combine_chunks()
                column = lambda c: table.column(c).combine_chunks()
                lists, tfs = column("terms"), column("tfs")
                owners = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                _search_block(
                    column("doc_id").fill_null(none_last).to_numpy(), lists.flatten().to_numpy(),
                    tfs.flatten().to_numpy().astype(np.int64), owners, column("n").to_numpy(),
                    weights, mean, wanted, k, best,
                )

            parts, size = [], 0
            for batch in batches:
                parts.append(batch)
                size += len(batch.column("terms").flatten())
                if size >= postings_a_block:
                    search(parts)
                    parts, size = [], 0
            if parts:
                search(parts)
            for item, (ids, scores) in best.items():
                yield pa.RecordBatch.from_arrays([
                    pa.array([item] * len(ids), pa.int64()),
                    pa.array(ids, pa.int64(), mask=ids == none_last), pa.array(scores, pa.int64()),
                ], names=out_schema.fieldNames())

        found = postings.mapInArrow(run, out_schema)
        results = found if results is None else results.union(found)
    if results is None:
        results = spark.createDataFrame([], out_schema)

    order = [F.desc("score"), F.asc_nulls_last("doc_id")]

    # First among 32 groups of tasks, so that no task sorts what all tasks found.
    group = Window.partitionBy("item_id", "task").orderBy(*order)
    near = results.withColumn("task", F.spark_partition_id() % 32).withColumn("rank", F.row_number().over(group))
    whole = Window.partitionBy("item_id").orderBy(*order)
    return (
        near.where(F.col("rank") <= k).withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents WHERE text IS NOT NULL
), sized AS (SELECT rid, doc_id, len(words)::BIGINT AS n, words FROM doc WHERE len(words) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM sized),
item AS (
  SELECT DISTINCT item_id, unnest(
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), posting AS (
  SELECT rid, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT rid, doc_id, n, unnest(words) AS term FROM sized) GROUP BY ALL
), weight AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM posting GROUP BY term), total
), scored AS (
  SELECT item_id, rid, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))))::BIGINT AS score
  FROM item JOIN weight USING (term) JOIN posting USING (term), total
  GROUP BY item_id, rid, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
