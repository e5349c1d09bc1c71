"""The corpus pipeline: toxicity, near-duplicates, personal data, mixing, tokens.

Each stage takes the documents its predecessor kept and returns a DataFrame;
``run`` writes each stage's result as Parquet in the shared checkpoint folder
and reads it back as the next one's input, so a lost executor costs at most
the stage it was in. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.bpe import bpe_decode, bpe_encode
from strata.llm.common import ensure_checkpoint_dir, read_table
from strata.llm.mixing import poisson_mix
from strata.llm.pii import redact
from strata.llm.simhash import keep_one_per_group
from strata.llm.toxicity import THRESHOLD, score_toxicity, train_toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scoring below the threshold. The model is fitted on the
    labelled ones among ``docs``, held-out ids aside."""
    model = train_toxicity(docs, read_table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model)
    return scored.where(F.col("toxicity") < THRESHOLD).drop("toxicity", "toxic_passages")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: that with the least id."""
    return keep_one_per_group(docs, words=3, max_bits=3)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become their kind; ``n_chars`` follows."""
    return redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents dropped or repeated so that sources near their target shares."""
    return poisson_mix(docs).drop("copy_no", "shuffle_key")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with the number of tokens and the digest of the bytes that
    they decode to."""
    return bpe_decode(bpe_encode(docs)).select(
        "doc_id", "lang", "source", "token_ids",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = f"{shared.rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{root}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Toxicity, SimHash and BPE are beyond SQL; tests hold ``run`` against a
#: brute-force version.
ORACLE_SQL = None
