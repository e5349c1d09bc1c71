"""Substring dedup over words: prefix-partitioned suffix trees."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import read_table
from strata.llm.pieces import covered, repeated_windows, with_keys, with_runs

WINDOW = 20
#: Words of the factor whose least hash anchors a window.
FACTOR = 4
#: Suffixes that one subtree holds; groups beyond it get longer prefixes.
SUBTREE = 1 << 16


def word_symbols(text: str) -> np.ndarray:
    words = text.encode().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def cut_words(text: str, start: np.ndarray, stop: np.ndarray) -> list[bytes]:
    words = text.encode().split()
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    return [joined[a:b] for a, b in zip(begins[start].tolist(), ends[stop - 1].tolist())]


def _subtree(
    words: np.ndarray, at: np.ndarray, stop: np.ndarray, depth: int, window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix tree of suffixes that share ``depth`` words, as its leaves in
    order, and the deep internal nodes nearest to its root: where each begins
    among the leaves, and the words that all its leaves share (at least
    ``window``). Leaves of deeper nodes are leaves of these."""
    length = stop - at
    if depth >= window:
        return np.arange(len(at)), np.zeros(1, np.int64), np.array([depth])
    place = at[:, None] + np.arange(depth, int(length.max()))
    own = words[np.minimum(place, len(words) - 1)].astype(">u4")
    # Behind a suffix's end, and never counted as shared.
    own[place >= stop[:, None]] = 0
    order = np.argsort(own.view(f"V{own.itemsize * own.shape[1]}").ravel(), kind="stable")
    own = own[order]
    differ = own[1:] != own[:-1]
    shared = depth + np.where(differ.any(axis=1), differ.argmax(axis=1), own.shape[1])
    shared = np.minimum(shared, np.minimum(length[order][1:], length[order][:-1]))
    begin = np.concatenate(([0], np.flatnonzero(shared < window) + 1))
    # A node is as deep as the least prefix that neighbours share in it.
    inner = np.append(shared, 0)
    inner[np.append(begin[1:], len(at)) - 1] = np.iinfo(np.int64).max
    return order, begin, np.minimum.reduceat(inner, begin)


def _prefix_groups(
    words: np.ndarray, at: np.ndarray, rows: np.ndarray, window: int, limit: int
) -> Iterator[tuple[np.ndarray, int]]:
    """Split suffixes into groups of at most ``limit`` by prefixes of variable
    length: a group beyond it is split by one more word. Groups of one suffix
    hold no internal node and are dropped."""
    todo = [(rows, 0)]
    while todo:
        rows, depth = todo.pop()
        if len(rows) < 2:
            continue
        if len(rows) <= limit or depth == window:
            yield rows, depth
            continue
        word = words[at[rows] + depth]
        order = np.argsort(word, kind="stable")
        edge = np.flatnonzero(np.diff(word[order])) + 1
        todo += [(part, depth + 1) for part in np.split(rows[order], edge)]


def repeated_by_trees(
    pieces: list[bytes], group: np.ndarray, place: np.ndarray, window: int, limit: int = SUBTREE
) -> list[np.ndarray]:
    """Per piece a boolean per window: does its word sequence occur before.

    The suffixes of a piece are those of at least ``window`` words. Only their
    places are kept; words are laid out for one subtree at a time."""
    number: dict[bytes, int] = {}
    numbered: dict[bytes, np.ndarray] = {}
    for piece in pieces:
        if piece not in numbered:
            # From 1, as 0 stands behind a suffix's end.
            numbered[piece] = np.array([number.setdefault(w, len(number) + 1) for w in piece.split(b" ")], np.uint32)
    words = np.concatenate([numbered[piece] for piece in pieces])
    size = np.array([len(numbered[piece]) for piece in pieces])
    counts = size - window + 1
    ends = np.cumsum(counts)
    of = np.repeat(np.arange(len(pieces)), counts)
    stop = np.cumsum(size)[of]
    at = np.arange(len(of)) + (window - 1) * of
    flags = np.zeros(len(of), bool)
    # Anchors are taken together as long as they fit one subtree; suffixes of
    # different anchors never share a deep node.
    by_anchor = np.argsort(group, kind="stable")
    rows = np.argsort(group[of], kind="stable")
    total = np.concatenate(([0], np.cumsum(counts[by_anchor])))
    whole = np.append(np.flatnonzero(np.diff(group[by_anchor])) + 1, len(by_anchor))
    begin = 0
    while begin < len(rows):
        fits = total[whole[total[whole] <= begin + limit]]
        end = int(fits[-1]) if len(fits) and fits[-1] > begin else int(total[whole[total[whole] > begin][0]])
        for some, depth in _prefix_groups(words, at, rows[begin:end], window, limit):
            order, first, _ = _subtree(words, at[some], stop[some], depth, window)
            leaves = some[order]
            # The leaves of a deep node are the copies of one repeat; the
            # earliest stays.
            earliest = np.minimum.reduceat(leaves, first)
            flags[leaves] = leaves != np.repeat(earliest, np.diff(np.append(first, len(leaves))))
        begin = end
    return np.split(flags, ends[:-1])


def substring_dedup(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", subtree: int = SUBTREE
) -> DataFrame:
    """(doc_id, kept_text, n_words, n_removed): every word covered by a
    ``window``-word sequence that also starts earlier is removed; the kept
    words are joined by one space.

    Earlier is by id, then by start; the windows are those of the input, not of
    what is left. Suffixes are partitioned by content, prefixes growing where a
    group holds more than ``subtree`` of them; in each group a suffix tree is
    built from the sorted suffixes and their common prefixes, and the leaves of
    its deep internal nodes are the copies of one repeat, of which the first
    stays.

    Words are separated by ASCII white space. A null text has no words. Null
    ids come last in the order. Rows alike in id and text are one document and
    each get its result; rows alike in id only are ordered by a hash of their
    text. Empty tables give no rows; other columns are not read.
    """
    base = with_keys(docs, id_col, text_col)
    runs = repeated_windows(
        base, word_symbols, cut_words, partial(repeated_by_trees, window=window, limit=subtree), window, FACTOR,
        distinct=False,
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                kept, n_words, n_removed = [], [], []
                for text, own in zip(part.column("text"), part.column("runs")):
                    words = (text.as_py() or "").encode().split()
                    gone = 0
                    if own.is_valid:
                        v = own.values
                        drop = covered((v.field("start").to_numpy(), v.field("n").to_numpy()), len(words), window)
                        gone = int(drop.sum())
                        left = [w for w, d in zip(words, drop.tolist()) if not d]
                    else:
                        left = words
                    kept.append(b" ".join(left).decode())
                    n_words.append(len(words))
                    n_removed.append(gone)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(kept, pa.string()), pa.array(n_words, pa.int64()),
                     pa.array(n_removed, pa.int64())],
                    names=["doc_id", "kept_text", "n_words", "n_removed"],
                )

    id_type = docs.schema[id_col].dataType.simpleString()
    return with_runs(base, runs).mapInArrow(
        remove, f"doc_id {id_type}, kept_text string, n_words long, n_removed long"
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )
