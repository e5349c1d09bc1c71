"""Anchored pieces: how repeated windows of symbols are brought together.

A window is ``window`` consecutive symbols (bytes or words) of one document.
Its anchor is the least hash among its ``q``-symbol factors, so equal windows
have equal anchors wherever they stand. Neighbouring windows mostly share an
anchor; such a run is a piece, the symbols it spans.

First only the anchors travel, to buckets by their hash, which answer with the
pieces whose anchor occurs again: a window under any other anchor has no copy.
Those pieces then travel with their symbols to the bucket of their anchor, where
a window that repeats is met by all its copies.

A bucket's pieces are handled by a method-specific function. Before that,
equal pieces are made one within a map batch, and in the bucket if the method
asks for it: only the earliest is looked at, the rest are known to repeat it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import partitions_for, text_bytes

#: Bytes of text whose anchors a map task sends at once, bytes of pieces that it
#: sends at once, and bytes that a bucket holds on average.
NOTE_BYTES = 48 << 20
BATCH_BYTES = 32 << 20
BUCKET_BYTES = 24 << 20
#: Compression level of what is shipped.
PACK_LEVEL = 6
#: Stands in for a null id in the order of documents: such rows come last.
LAST_ID = 2**63 - 1

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0xD6E8FEB86659FD93
_PLACE = np.uint64(2**26 - 1)
#: Windows of one document that are hashed at once.
SEGMENT = 1 << 22

def anchors(symbols: np.ndarray, window: int, q: int) -> tuple[np.ndarray, ...]:
    """(start, windows, anchor, place) of the runs of windows that have one anchor
    at one place, counted from the start: the first of their least factor hashes. ``symbols`` are uint64;
    ``q`` is a power of two. No run exceeds ``window - q + 1`` windows, so no
    window occurs twice in a run."""
    found = []
    for at in range(0, max(1, len(symbols) - window + 1), SEGMENT):
        start, *rest = _anchors(symbols[at:at + SEGMENT + window - 1], window, q)
        found.append((start + at, *rest))
    return tuple(np.concatenate(x) for x in zip(*found))


def _anchors(symbols: np.ndarray, window: int, q: int) -> tuple[np.ndarray, ...]:
    n = len(symbols) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), none
    h, width, step = symbols, 1, _STEP
    while width < q:
        h = h[:-width] * np.uint64(step) + h[width:]
        step, width = step * step % 2**64, 2 * width
    h = h ^ (h >> np.uint64(31))
    h *= _MIX
    h ^= h >> np.uint64(29)
    # The place in the low bits: the minimum then says where it stands.
    low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    m, width = window - q + 1, 1
    while 2 * width <= m:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < m:
        low = np.minimum(low[:n], low[m - width:m - width + n])
    start = np.concatenate(([0], np.flatnonzero(low[1:] != low[:-1]) + 1))
    place = (low[start] & _PLACE).astype(np.int64)
    return start, np.diff(np.append(start, n)), h[place], place - start


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=PACK_LEVEL))
    with pa.ipc.new_stream(sink, batch.schema, options=options) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _row(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row that holds each column as a list."""
    return pa.RecordBatch.from_arrays(
        [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), pa.array(c)) for c in columns.values()],
        names=list(columns),
    )


def _packed(rows: dict[bytes, tuple], buckets: int) -> Iterator[tuple[int, bytes]]:
    """One (bucket, table) per bucket that has pieces. A table is one row of
    arrays: its documents, then per piece its document's number, the step from
    the start before, windows, anchor, its place, size; and all bytes in one string."""
    texts = list(rows)
    fields = [np.fromiter((r[i] for r in rows.values()), t, len(rows))
              for i, t in enumerate((np.uint64, np.int64, np.int64, np.int64, np.int64, np.int64))]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    bucket = (fields[0] >> np.uint64(32)) % np.uint64(buckets)
    order = np.lexsort((fields[3], fields[2], fields[1], bucket))
    cut = np.flatnonzero(np.diff(bucket[order])) + 1
    for own in np.split(order, cut):
        key, id_, h, start, n, place = (f[own] for f in fields)
        new = np.concatenate(([True], (id_[1:] != id_[:-1]) | (h[1:] != h[:-1])))
        columns = {
            "ids": id_[new], "hs": h[new], "doc": (np.cumsum(new) - 1).astype(np.int32),
            "step": np.diff(start, prepend=0).astype(np.int32), "n": n.astype(np.int32),
            "key": key.astype(np.uint32), "place": place.astype(np.int32), "size": sizes[own].astype(np.int32),
        }
        blob = pa.array([b"".join(texts[i] for i in own.tolist())], pa.large_binary())
        yield int(bucket[own[0]]), _ipc(_row(columns).append_column("text", blob))


def _unpacked(table: bytes) -> tuple[list[np.ndarray], memoryview]:
    """Arrays key, id, h, start, n, place, begin, end of a table's pieces, and its bytes."""
    batch = pa.ipc.open_stream(table).read_next_batch()
    ids, hs, doc, step, n, key, place, size = (batch.column(i).values.to_numpy() for i in range(8))
    end = np.cumsum(size, dtype=np.int64)
    arrays = [key, ids[doc], hs[doc], np.cumsum(step, dtype=np.int64), n, place, end - size, end]
    return arrays, memoryview(batch.column(8)[0].as_buffer())


def _spans(id_, h, start, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(id_, pa.int64()), pa.array(h, pa.int64()), pa.array(start, pa.int32()), pa.array(n, pa.int32())],
        names=["id", "h", "start", "n"],
    )


def _sent(tables: list[tuple[int, bytes]], known: pa.RecordBatch | None) -> pa.RecordBatch:
    """Rows (bucket, kind, rows): tables for buckets (kind 0), and results that
    need none (kind 1), which go by any."""
    made = [(b, 0, t) for b, t in tables]
    if known is not None and known.num_rows:
        made.append((tables[0][0] if tables else 0, 1, _ipc(known)))
    columns = zip(*made) if made else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary()))],
        names=["bucket", "kind", "rows"],
    )


def _by_bucket(one_bucket: Callable[[list[bytes]], Iterator[pa.RecordBatch]]):
    """A function over rows sorted by bucket: results sent along, and those of
    ``one_bucket`` for each bucket's tables."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        at = None
        for batch in batches:
            for bucket, kind, table in zip(*(batch.column(c) for c in ("bucket", "kind", "rows"))):
                if kind.as_py():
                    yield from pa.ipc.open_stream(table.as_py()).read_all().to_batches()
                    continue
                if bucket.as_py() != at:
                    if held:
                        yield from one_bucket(held)
                    at, held = bucket.as_py(), []
                held.append(table.as_py())
        if held:
            yield from one_bucket(held)

    return gather


def _numbers(id_: np.ndarray, h: np.ndarray, no: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(id_, pa.int64()), pa.array(h, pa.int64()), pa.array(no, pa.int32())], names=["id", "h", "no"]
    )


def shared_pieces(base: DataFrame, symbols: Callable[[str], np.ndarray], window: int, q: int, total: int) -> DataFrame:
    """(id, h, pieces): the numbers of a document's pieces whose anchor occurs
    under another piece, or in another row. A document may have several rows.

    A batch sends each of its anchors once; those that it holds twice itself
    are known, and the bucket is only told that they exist. So an anchor that
    a third of all documents have comes to its bucket once a batch.
    """
    # A piece's entry here takes about as much room as the text it stands for.
    buckets = max(1, -(-total // BUCKET_BYTES))

    def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        size = 0

        def out() -> pa.RecordBatch:
            ids, hs = (np.array(x, np.int64) for x in zip(*held))
            lens = np.array([len(k) for k in held.values()])
            key = np.concatenate(list(held.values()))
            doc = np.repeat(np.arange(len(lens)), lens)
            no = np.arange(len(key)) - np.repeat(np.cumsum(lens) - lens, lens)
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.diff(key[order], prepend=~key[order[:1]]))
            count = np.diff(np.append(first, len(key)))
            again = order[np.repeat(count > 1, count)]
            sent = order[first]
            asks = np.where(count > 1, -1, doc[sent]).astype(np.int32)
            bucket = (key[sent] >> np.uint64(32)) % np.uint64(buckets)
            by = np.lexsort((no[sent], asks, bucket))
            tables = []
            for own in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1):
                docs, at = np.unique(asks[own], return_inverse=True)
                asked = docs >= 0
                tables.append((int(bucket[own[0]]), _ipc(_row({
                    "ids": np.where(asked, ids[docs], 0), "hs": np.where(asked, hs[docs], 0), "asked": asked,
                    "doc": at.astype(np.int32), "no": no[sent[own]].astype(np.int32),
                    "key": key[sent[own]].astype(np.uint32),
                }))))
            return _sent(tables, _numbers(ids[doc[again]], hs[doc[again]], no[again]))

        for batch in batches:
            for i, h, text in zip(*(batch.column(c) for c in ("_id", "_h", "text"))):
                if not text.is_valid or (i.as_py(), h.as_py()) in held:
                    continue
                text = text.as_py()
                key = anchors(symbols(text), window, q)[2]
                size += len(text)
                if len(key):
                    held[i.as_py(), h.as_py()] = key
                if size >= NOTE_BYTES and held:
                    yield out()
                    held.clear()
                    size = 0
        if held:
            yield out()

    def answer(tables: list[bytes]) -> Iterator[pa.RecordBatch]:
        found = []
        for table in tables:
            row = pa.ipc.open_stream(table).read_next_batch()
            ids, hs, asked, doc, no, key = (c.values.to_numpy(zero_copy_only=False) for c in row.columns)
            found.append((ids[doc], hs[doc], asked[doc], no, key))
        id_, h, asked, no, key = (np.concatenate(x) for x in zip(*found))
        _, at, count = np.unique(key, return_inverse=True, return_counts=True)
        told = np.bincount(at[~asked], minlength=len(count))
        some = asked & ((count > 1) | (told > 0))[at]
        if some.any():
            yield _numbers(id_[some], h[some], no[some])

    return (
        base.select("_id", "_h", "text").mapInArrow(note, "bucket long, kind int, rows binary")
        .repartition(partitions_for(base, total, BUCKET_BYTES), "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_by_bucket(answer), "id long, h long, no int")
        .groupBy("id", "h").agg(F.collect_list("no").alias("pieces"))
    )


def with_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, _id, _h). ``_id`` orders the documents (``LAST_ID`` for
    null), ``_h`` is the hash of the text; rows alike in both are one document."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_id"), F.xxhash64(text_col).alias("_h"),
    )


def _on(base: DataFrame, other: DataFrame) -> Column:
    return (F.col("_id") == other["id"]) & (F.col("_h") == other["h"])


def repeated_windows(
    base: DataFrame,
    symbols: Callable[[str], np.ndarray],
    cut: Callable[[str, np.ndarray, np.ndarray], list[bytes]],
    solve: Callable[[list[bytes], np.ndarray, np.ndarray], list[np.ndarray]],
    window: int,
    q: int,
    distinct: bool = True,
) -> DataFrame:
    """(id, h, start, n): runs of windows of a document (see ``with_keys``) that
    also start earlier.

    ``symbols(text)`` are a text's symbols as uint64, ``cut(text, start, stop)``
    the bytes of symbols start to stop, for several pieces. ``solve(pieces,
    group, place)`` gets a bucket's pieces in document order, with the number and
    place of each one's anchor; it returns per piece a boolean per window: does
    it occur before. With ``distinct``, equal pieces of a bucket are made one
    first; without, all are solved (equal ones of a map batch are still sent
    once).
    """
    total = text_bytes(base, "text")
    buckets = max(1, -(-total * 2 // BUCKET_BYTES))
    parts = partitions_for(base, total * 2, BUCKET_BYTES)
    shared = shared_pieces(base, symbols, window, q, total)
    # All columns of the base, so that its shuffle serves the last join too.
    picked = base.join(shared, _on(base, shared)).select(*base.columns, "pieces")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Earliest row per distinct piece; later copies are known repeats.
        held: dict[bytes, tuple] = {}
        again: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            return _sent(list(_packed(held, buckets)), _spans(*zip(*again)) if again else None)

        for batch in batches:
            for i, h, text, pick in zip(*(batch.column(c) for c in ("_id", "_h", "text", "pieces"))):
                i, h, text = i.as_py(), h.as_py(), text.as_py()
                own = np.unique(pick.values.to_numpy())
                start, n, key, place = (x[own] for x in anchors(symbols(text), window, q))
                cuts = cut(text, start, start + n + window - 1)
                for start, n, key, place, piece in zip(*(x.tolist() for x in (start, n, key, place)), cuts):
                    size += len(piece)
                    row = (key, i, h, start, n, place)
                    known = held.get(piece)
                    if known is None:
                        held[piece] = row
                    elif known[1:4] < row[1:4]:
                        again.append(row[1:5])
                    elif known[1:4] > row[1:4]:
                        held[piece] = row
                        again.append(known[1:5])
                if size >= BATCH_BYTES:
                    yield out()
                    held.clear()
                    again.clear()
                    size = 0
        if held:
            yield out()

    def one_bucket(tables: list[bytes]) -> Iterator[pa.RecordBatch]:
        opened = [_unpacked(t) for t in tables]
        key, id_, h, start, n, place, lo, hi = (np.concatenate(x) for x in zip(*(arrays for arrays, _ in opened)))
        source = np.repeat(np.arange(len(opened)), [len(arrays[0]) for arrays, _ in opened])
        _, group, count = np.unique(key, return_inverse=True, return_counts=True)
        keep = np.flatnonzero(count[group] > 1)
        if not len(keep):
            return
        order = keep[np.lexsort((start[keep], h[keep], id_[keep]))]
        # Rows of one document, start and all, are one.
        own = np.stack((id_[order], h[order], start[order]))
        order = order[np.concatenate(([True], (own[:, 1:] != own[:, :-1]).any(axis=0)))]
        first: dict[bytes, int] = {}
        pieces, of, copies = [], [], []
        for r, s, a, b in zip(order.tolist(), source[order].tolist(), lo[order].tolist(), hi[order].tolist()):
            piece = bytes(opened[s][1][a:b])
            if distinct and first.setdefault(piece, r) != r:
                copies.append(r)
            else:
                pieces.append(piece)
                of.append(r)
        of = np.array(of)
        if copies:
            yield _spans(id_[copies], h[copies], start[copies], n[copies])
        flags = solve(pieces, group[of], place[of])
        where, lens = np.repeat(np.arange(len(of)), [len(f) for f in flags]), np.array([len(f) for f in flags])
        if not len(where):
            return
        flat = np.concatenate(flags)
        offset = np.arange(len(where)) - np.repeat(np.cumsum(lens) - lens, lens)
        new = flat & np.concatenate(([True], ~(flat[:-1] & (where[1:] == where[:-1]))))
        begin = np.flatnonzero(new)
        if not len(begin):
            return
        run = np.cumsum(new)[flat] - 1
        length = np.bincount(run, minlength=len(begin))
        rows_of = of[where[begin]]
        yield _spans(id_[rows_of], h[rows_of], start[rows_of] + offset[begin], length)

    return (
        picked.mapInArrow(spread, "bucket long, kind int, rows binary")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_by_bucket(one_bucket), "id long, h long, start int, n int")
    )


def with_runs(base: DataFrame, runs: DataFrame) -> DataFrame:
    """(doc_id, text, runs): every document with its runs, as an array of
    (start, n) in any order, null if it has none."""
    per = runs.groupBy("id", "h").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    return base.join(per, _on(base, per), "left").select("doc_id", "text", "runs")


def covered(runs, length: int, window: int) -> np.ndarray:
    """Boolean per symbol: inside a repeated window. ``runs``: (start, n) rows."""
    edge = np.zeros(length + 1, np.int32)
    starts, ns = runs
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(length, starts + ns + window - 1), -1)
    return np.cumsum(edge[:-1]) > 0
