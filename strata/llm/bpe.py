"""Byte-level BPE encoding and decoding over whole texts."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from strata.llm.common import read_table, without

CHUNK_CHARS = 1 << 15
OVERLAP_CHARS = 256
#: Rows and characters that a task hands back at once.
OUT_ROWS = 512
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    encoding = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return encoding, regex.compile(public_tokenizers.PATTERN)


def _starts(pattern, text: str, start: int, stop: int) -> tuple[list[int], int]:
    """Starts of the pre-tokens of ``text`` split from ``start``: those before
    ``stop``, and the first one after."""
    out = []
    for m in pattern.finditer(text, start):
        if m.start() >= stop:
            return out, m.start()
        out.append(m.start())
    return out, len(text)


def stitched_cuts(pattern, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> list[int]:
    """Positions that cut ``text`` into pieces which pre-tokenise as the whole.

    Every chunk is split from its own start, wherever that falls, and on into
    the first ``overlap`` characters of the next. A start there that both splits
    share is where the later one has met the earlier: from it on, both are the
    same. The first such start behind a character that is not white space
    becomes the cut. (Behind white space it can't be one: the pattern looks one
    character beyond white space, so the piece before the cut would not end as
    the whole does there.) Where two chunks never meet so, as in a pre-token
    longer than the overlap, the earlier split goes on through the next chunk.
    """
    cuts, begin = [0], 0
    for lo in range(chunk, len(text), chunk):
        hi = min(lo + overlap, lo + chunk, len(text))
        if begin >= hi:
            continue
        left, after = _starts(pattern, text, begin, hi)
        shared = set(left)
        right = _starts(pattern, text, lo, hi)[0]
        met = next((b for b in right if b in shared and not text[b - 1].isspace()), None)
        if met is None:
            # The next chunk's own split is not known to be right anywhere.
            begin = after
        else:
            cuts.append(met)
            begin = lo
    return [*cuts, len(text)]


def encode_text(text: str, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> list[int]:
    encoding, pattern = _encoder(path)
    if len(text) <= chunk:
        return encoding.encode_ordinary(text)
    cuts = stitched_cuts(pattern, text, chunk, overlap)
    pieces = encoding.encode_ordinary_batch([text[a:b] for a, b in zip(cuts, cuts[1:])], num_threads=2)
    return [i for ids in pieces for i in ids]


def bpe_encode(docs: DataFrame, text_col: str = "text", out_col: str = "token_ids",
               path: str | None = None, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """Adds ``out_col`` (array of int): each whole text's token ids, as if it had
    been pre-tokenised and merged in one go; no special tokens.

    A text is cut into overlapping chunks, each pre-tokenised on its own; where
    the splits of two neighbours meet again they are stitched, and the pieces
    between are encoded by several threads. A row stays a row, and nothing is
    shuffled. Null and empty texts have no ids;
    repeated rows are encoded alike; an input column named ``out_col`` is
    replaced, others are kept.
    """
    path = path or vocabulary_path()
    docs = without(docs, out_col)
    schema = StructType([*docs.schema.fields, StructField(out_col, ArrayType(IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(at, OUT_ROWS)
                ids, ends = [], [0]
                for text in part.column(text_col):
                    ids.append(np.asarray(encode_text(text.as_py() or "", path, chunk, overlap), dtype=np.int32))
                    ends.append(ends[-1] + len(ids[-1]))
                made = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.concatenate(ids) if ids else [], pa.int32())
                )
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, out_col])

    return docs.mapInArrow(run, schema)


def bpe_decode(tokens: DataFrame, ids_col: str = "token_ids", out_col: str = "decoded",
               path: str | None = None) -> DataFrame:
    """Adds ``out_col`` (binary): the ids' byte strings, concatenated. A null or
    empty list gives no bytes. Bytes need not be valid UTF-8."""
    path = path or vocabulary_path()
    tokens = without(tokens, out_col)
    schema = StructType([*tokens.schema.fields, StructField(out_col, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, _ = _encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(at, OUT_ROWS)
                made = [
                    encoding.decode_bytes(x.values.to_numpy(zero_copy_only=False).tolist()) if x.is_valid else b""
                    for x in part.column(ids_col)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(made, pa.binary())], names=[*part.schema.names, out_col]
                )

    return tokens.mapInArrow(run, schema)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe_encode(docs).drop("text")
    return bpe_decode(ids).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
