"""Suffix-array dedup over bytes: column-wise construction for collections."""

from __future__ import annotations

import tempfile
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import read_table
from strata.llm.pieces import covered, repeated_windows, with_keys, with_runs

WINDOW = 100
#: Bytes of the factor whose least hash anchors a window.
FACTOR = 16
#: Strings that are inserted together. One anchor with more is split into its
#: single windows, dealt out by their hash.
COLLECTION = 1024
#: Bands of windows by their reach to the left of the anchor, looked at apart
#: before the construction.
BANDS = 5
END = 0


def byte_symbols(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8).astype(np.uint64) + np.uint64(1)


def cut_bytes(text: str, start: np.ndarray, stop: np.ndarray) -> list[bytes]:
    raw = text.encode()
    return [raw[a:b] for a, b in zip(start.tolist(), stop.tolist())]


class _Column:
    """An array that is rewritten from one end to the other each round, in one
    of two temporary files that take turns."""

    def __init__(self, folder: str, dtype) -> None:
        self.files = [tempfile.TemporaryFile(dir=folder) for _ in range(2)]
        self.dtype = np.dtype(dtype)

    def read(self) -> np.ndarray:
        self.files[0].seek(0)
        return np.fromfile(self.files[0], self.dtype)

    def write(self, values: np.ndarray) -> None:
        self.files.reverse()
        # Longer than what this file held two rounds ago.
        self.files[0].seek(0)
        values.astype(self.dtype, copy=False).tofile(self.files[0])

    def close(self) -> None:
        for f in self.files:
            f.close()


def _range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least of ``values[lo:hi]`` per pair (lo < hi <= len - 1)."""
    order = np.argsort(-lo, kind="stable")
    pairs = np.stack((lo[order], hi[order]), axis=1).ravel()
    out = np.empty(len(lo), values.dtype)
    out[order] = np.minimum.reduceat(values, pairs)[::2]
    return out


def collection_bwt(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform and common prefixes of a collection.

    Symbols are bytes plus one; 0 ends a string, and ends of different strings
    differ, ordered by the strings. ``lcp[i]`` is the length that suffix i
    shares with suffix i - 1. Round r inserts the suffix of length r of every
    string that has one. The transform so far says where: a suffix c + s stands
    among those beginning with c as s stands among the suffixes preceded by c.
    The prefix it shares with a neighbour is one more than the least common
    prefix between s and the neighbour's own s.
    """
    m = len(strings)
    lens = np.fromiter(map(len, strings), np.int64, m)
    # UTF-8 has no byte 255.
    flat = np.frombuffer(b"".join(strings), np.uint8) + np.uint8(1)
    last = np.cumsum(lens) - 1
    prefix = np.uint8 if lens.max() < 255 else np.uint16
    # A symbol and its place in the transform, in one number.
    entry, bits = (np.uint32, 24) if m + len(flat) < 1 << 24 else (np.uint64, 48)
    places = entry(2**bits - 1)
    with tempfile.TemporaryDirectory() as folder:
        bwt_file, lcp_file = _Column(folder, np.uint8), _Column(folder, prefix)
        # Round 0: the empty suffixes.
        symbols = np.where(lens > 0, flat[np.maximum(last, 0)], END).astype(np.uint8)
        bwt_file.write(symbols)
        lcp_file.write(np.zeros(m, prefix))
        # Each string's newest suffix, by its place.
        active = np.flatnonzero(lens > 0)
        at = active
        # The transform's symbols but for ends, by symbol and place; `k` says
        # where those of the newest suffixes stand.
        entries, k = _merged(np.zeros(0, entry), (symbols[at].astype(entry) << entry(bits)) | at.astype(entry))
        r = 1
        while len(active):
            bwt, lcp = bwt_file.read(), lcp_file.read()
            new = m + k
            size = m + len(entries)
            own = entries[k] >> entry(bits)
            to_before, to_after = np.zeros(len(k), prefix), np.zeros(len(k), prefix)
            guarded = np.append(lcp, prefix(0))
            other = entries[np.maximum(k - 1, 0)]
            has = (k > 0) & (other >> entry(bits) == own)
            if has.any():
                to_before[has] = 1 + _range_min(guarded, (other[has] & places).astype(np.int64) + 1, at[has] + 1)
            other = entries[np.minimum(k + 1, len(entries) - 1)]
            has = (k + 1 < len(entries)) & (other >> entry(bits) == own)
            if has.any():
                to_after[has] = 1 + _range_min(guarded, at[has] + 1, (other[has] & places).astype(np.int64) + 1)
            left = lens[active] - r
            symbols = np.where(left > 0, flat[last[active] - r], END).astype(np.uint8)
            stays = np.ones(size, bool)
            stays[new] = False
            grown = np.empty(size, np.uint8)
            grown[stays] = bwt
            grown[new] = symbols
            bwt_file.write(grown)
            shared = np.zeros(size + 1, prefix)
            shared[:size][stays] = lcp
            shared[new + 1] = to_after
            shared[new] = to_before
            lcp_file.write(shared[:size])
            # What stands behind an inserted suffix moves on by one.
            slots = np.sort(new) - np.arange(len(new))
            moved = np.repeat(np.arange(len(new) + 1, dtype=entry), np.diff(slots, prepend=0, append=len(bwt)))
            entries += moved[entries & places]
            more = left > 0
            active, at = active[more], new[more]
            entries, k = _merged(entries, (symbols[more].astype(entry) << entry(bits)) | at.astype(entry))
            r += 1
        bwt, lcp = bwt_file.read(), lcp_file.read()
        bwt_file.close()
        lcp_file.close()
    return bwt, lcp


def _merged(entries: np.ndarray, added: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ``entries`` with ``added`` among them, and where each of these stands."""
    order = np.argsort(added)
    where = np.empty(len(added), np.int64)
    where[order] = np.searchsorted(entries, added[order]) + np.arange(len(added))
    old = np.ones(len(entries) + len(added), bool)
    old[where] = False
    merged = np.empty(len(old), entries.dtype)
    merged[old] = entries
    merged[where] = added
    return merged, where


def _suffix_places(bwt: np.ndarray, lens: np.ndarray) -> list[np.ndarray]:
    """Per round, the places of the strings' suffixes of that length (-1 where a
    string is shorter), by following the transform from the ends."""
    m = len(lens)
    rank = np.empty(len(bwt), np.int64)
    rank[np.argsort(bwt, kind="stable")] = np.arange(len(bwt))
    rank += m - int(np.count_nonzero(bwt == END))
    at = np.arange(m)
    out = []
    for r in range(1, int(lens.max()) + 1):
        has = lens >= r
        at = np.where(has, rank[np.where(has, at, 0)], -1)
        out.append(at)
    return out


def _repeats(strings: list[bytes], window: int) -> list[np.ndarray]:
    """Per string a boolean per window: does it occur in an earlier string or
    earlier in this one."""
    bwt, lcp = collection_bwt(strings)
    lens = np.fromiter(map(len, strings), np.int64, len(strings))
    # Suffixes that agree in `window` symbols form one run.
    run = np.cumsum(lcp < window)
    ends = np.cumsum(lens - window + 1)
    node = np.empty(int(ends[-1]), np.int64)
    for r, at in enumerate(_suffix_places(bwt, lens), start=1):
        if r >= window:
            has = np.flatnonzero(at >= 0)
            node[ends[has] - 1 - (r - window)] = run[at[has]]
    _, first = np.unique(node, return_index=True)
    flags = np.ones(len(node), bool)
    flags[first] = False
    return np.split(flags, ends[:-1])


def _may_repeat(pieces: list[bytes], place: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Per piece the first window that may occur in another, and one past the
    last (equal if none). Windows fall into bands by how far they reach to the
    left of the anchor. All windows of a band hold the bytes from its least
    reach on the left to its least reach on the right; equal windows are of one
    band, so where no other piece has these bytes, none has the windows."""
    reach = window - FACTOR
    width = -(-(reach + 1) // BANDS)
    bands = [(near, min(reach, near + width - 1)) for near in range(0, reach + 1, width)]
    shared = [
        [p[a - near:a + FACTOR + reach - far] if a >= near and len(p) >= a + FACTOR + reach - far else None
         for near, far in bands]
        for p, a in zip(pieces, place.tolist())
    ]
    counts = [Counter(column) for column in zip(*shared)]
    lo, hi = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
    for i, (p, a, own) in enumerate(zip(pieces, place.tolist(), shared)):
        held = [b for b, x, c in zip(bands, own, counts) if x is not None and c[x] > 1]
        if held:
            lo[i] = max(0, a - held[-1][1])
            hi[i] = max(lo[i], min(len(p) - window, a - held[0][0]) + 1)
    return lo, hi


def repeated_by_columns(
    pieces: list[bytes], group: np.ndarray, place: np.ndarray, window: int, limit: int = COLLECTION
) -> list[np.ndarray]:
    """Per piece a boolean per window: does it occur before. Pieces come in
    document order; those of one anchor are inserted together, each cut to the
    windows that another may hold."""
    flags = [np.zeros(len(p) - window + 1, bool) for p in pieces]
    lo, hi = _may_repeat(pieces, place, window)
    by_anchor = np.argsort(group, kind="stable")
    by_anchor = by_anchor[hi[by_anchor] > lo[by_anchor]]
    edge = np.flatnonzero(np.diff(group[by_anchor])) + 1
    batch: list[np.ndarray] = []
    size = 0

    def solve() -> None:
        some = np.sort(np.concatenate(batch)).tolist()
        for p, f in zip(some, _repeats([pieces[p][lo[p]:hi[p] + window - 1] for p in some], window)):
            flags[p][lo[p]:hi[p]] = f

    for members in np.split(by_anchor, edge) if len(by_anchor) else []:
        if len(members) == 1:
            # No window occurs twice in one piece.
            continue
        if len(members) > limit:
            _split_windows(pieces, members, lo, hi, flags, window, limit)
            continue
        if size + len(members) > limit and batch:
            solve()
            batch, size = [], 0
        batch.append(members)
        size += len(members)
    if batch:
        solve()
    return flags


def _split_windows(
    pieces: list[bytes], members: np.ndarray, lo: np.ndarray, hi: np.ndarray, flags: list, window: int, limit: int
) -> None:
    """One anchor with more pieces than a collection takes: its windows, one by
    one, in collections by their hash. Equal windows have equal hashes."""
    parts = -(-int((hi - lo)[members].sum()) // limit)
    dealt: list[list[tuple[int, int]]] = [[] for _ in range(parts)]
    for p in members.tolist():
        for o in range(lo[p], hi[p]):
            dealt[zlib.crc32(pieces[p][o:o + window]) % parts].append((p, o))
    for own in dealt:
        own.sort()
        for at, f in zip(own, _repeats([pieces[p][o:o + window] for p, o in own], window) if own else []):
            flags[at[0]][at[1]] = bool(f[0])


def suffix_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, kept, spans, n_bytes): every byte covered by a ``window``-byte
    string that also starts earlier is removed.

    Earlier is by id, then by start; strings are those of the input, within one
    document, and overlaps count. Pieces of text that share an anchor are a
    collection, whose Burrows-Wheeler transform and common prefixes are built
    column by column; suffixes that agree in ``window`` bytes are copies, of
    which the first stays.

    ``kept`` are the remaining bytes, ``spans`` the maximal removed runs (start,
    end). A null text has no bytes. Null ids come last in the order. Rows alike
    in id and text are one document and each get its result; rows alike in id
    only are ordered by a hash of their text. Empty tables give no rows; other
    columns are not read.
    """
    base = with_keys(docs, id_col, text_col)
    runs = repeated_windows(
        base, byte_symbols, cut_bytes, partial(repeated_by_columns, window=window), window, FACTOR
    )
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                kept, spans, size = [], [], []
                for text, own in zip(part.column("text"), part.column("runs")):
                    raw = (text.as_py() or "").encode()
                    gone = []
                    if own.is_valid:
                        v = own.values
                        drop = covered((v.field("start").to_numpy(), v.field("n").to_numpy()), len(raw), window)
                        step = np.diff(np.concatenate(([0], drop.view(np.int8), [0])))
                        begin, end = np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()
                        gone = [{"start": a, "end": b} for a, b in zip(begin, end)]
                        left = np.frombuffer(raw, np.uint8)[~drop].tobytes()
                    else:
                        left = raw
                    kept.append(left)
                    spans.append(gone)
                    size.append(len(raw))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(kept, pa.binary()), pa.array(spans, span), pa.array(size, pa.int64())],
                    names=["doc_id", "kept", "spans", "n_bytes"],
                )

    id_type = docs.schema[id_col].dataType.simpleString()
    return with_runs(base, runs).mapInArrow(
        remove, f"doc_id {id_type}, kept binary, spans array<struct<start:int,end:int>>, n_bytes long"
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
