"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata.functions.names import unused_names
from strata.llm.common import checkpoint, components, read_table, without

SEED = 42
#: Shingles whose bits are counted at once.
BLOCK = 1 << 15


def fingerprint(text: str | None, words: int) -> int:
    """64-bit SimHash, as a signed integer. Shingles are runs of ``words``
    words of the text with A-Z lower-cased, repeats included; a shorter text is
    one shingle; a text without words has fingerprint zero."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        h = xxhash.xxh64_intdigest
        hashes = [
            h(joined[a:b], SEED)
            for a, b in zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1:].tolist())
        ]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = np.array(hashes[at:at + BLOCK], dtype="<u8")
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    major = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(major.view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``docs`` without its text, with its fingerprint (long)."""
    docs = without(docs, out_col)
    kept = [f for f in docs.schema.fields if f.name != text_col]
    schema = StructType([*kept, StructField(out_col, LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(t.as_py(), words) for t in batch.column(text_col)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], pa.array(made, pa.int64())],
                names=[*[f.name for f in kept], out_col],
            )

    return docs.mapInArrow(run, schema)


def _ball(segment: Column) -> Column:
    """The 32-bit segment and the 32 values one bit away."""
    flips = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i))
    return F.array_append(F.transform(flips, lambda bit: segment.bitwiseXOR(bit)), segment)


def fingerprint_links(codes: DataFrame, max_bits: int = 3) -> DataFrame:
    """(a, b), a < b: pairs of distinct ``fingerprint`` values that differ in at
    most ``max_bits`` (0 to 3) bits.

    Two such values agree up to one bit in one of their two 32-bit halves. So
    each half is looked up, with all values one bit away from it, in a table
    keyed by half and value; hits are kept if the whole distance agrees. A
    half value that very many fingerprints share is split by the join itself
    (adaptive skew handling).
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two 32-bit segments with radius 1 cover at most 3 bits")
    halves = F.array(
        F.struct(F.lit(0).alias("part"), F.shiftrightunsigned("fingerprint", 32).alias("seg")),
        F.struct(F.lit(1).alias("part"), F.col("fingerprint").bitwiseAND(F.lit(0xFFFFFFFF)).alias("seg")),
    )
    table = codes.select("fingerprint", F.explode(halves).alias("s")).select(
        F.col("fingerprint").alias("a"), "s.part", "s.seg"
    )
    probes = table.select(F.col("a").alias("b"), "part", F.explode(_ball(F.col("seg"))).alias("seg"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return table.join(probes, ["part", "seg"]).where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def fingerprint_classes(codes: DataFrame, max_bits: int = 3) -> DataFrame:
    """(fingerprint, root, component_id) for (id, fingerprint) rows: the
    fingerprint that names its component, and the least id in it."""
    classes = codes.groupBy("fingerprint").agg(F.min("id").alias("least"))
    linked = components(fingerprint_links(classes.select("fingerprint"), max_bits))
    roots = classes.join(linked, classes["fingerprint"] == linked["id"], "left").select(
        "fingerprint", "least", F.coalesce("component_id", "fingerprint").alias("root")
    )
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    return roots.join(least, "root").select("fingerprint", "root", "component_id")


def simhash_groups(
    docs: DataFrame,
    words: int = 3,
    max_bits: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, fingerprint long, component_id): documents linked, directly or
    through others, by fingerprints at ``max_bits`` or fewer differing bits.

    Documents with one fingerprint are one class, aggregated map-side before
    anything is compared, so thousands of copies cost as much as one; links and
    components are between classes. ``component_id`` is the least id reached.

    Null and empty texts and texts of white space have fingerprint zero and are
    linked like any other. Rows with a null id keep their row and fingerprint;
    they never name a component unless all its ids are null (then it is null).
    Repeated rows each keep a row. Empty tables give no rows; other columns are
    not read.
    """
    codes = checkpoint(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), words))
    named = fingerprint_classes(codes, max_bits).select("fingerprint", "component_id")
    return codes.join(named, "fingerprint").select("id", "fingerprint", "component_id")


def keep_one_per_group(
    docs: DataFrame,
    words: int = 3,
    max_bits: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with one row of each group of ``simhash_groups``: one with the
    least id. Null ids come after all others, and ids that several texts share
    lose no group. All columns are kept.

    The rows are chosen among narrow ones, without texts: by group, least id and
    two hashes of id and text. The documents are then shuffled once, to meet the
    chosen hashes; of rows alike in id and text one is kept.
    """
    one, two = unused_names(2, docs)
    both = [F.col(id_col), F.col(id_col).isNull(), F.col(text_col), F.col(text_col).isNull()]
    hashes = [F.xxhash64(*both).alias(one), F.xxhash64(F.lit(1), *both).alias(two)]
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *hashes)
    codes = checkpoint(fingerprints(narrow, words))
    # Copies are one row before anything is joined.
    row = F.struct(F.col("id").isNull().alias("none"), "id", one, two)
    least = codes.groupBy("fingerprint").agg(F.min(row).alias("row"))
    named = fingerprint_classes(codes, max_bits).select("fingerprint", "root")
    chosen = least.join(named, "fingerprint").groupBy("root").agg(F.min("row").alias("row"))
    chosen = chosen.select(F.col(f"row.{one}").alias(one), F.col(f"row.{two}").alias(two))
    kept = docs.select("*", *hashes).join(chosen, [one, two], "left_semi")
    return kept.dropDuplicates([one, two]).drop(one, two)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(read_table(spark, sf_dir, "documents"), words=3, max_bits=3).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
