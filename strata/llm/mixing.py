"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.names import unused_names
from strata.llm.common import checkpoint, read_table, without

# Above this mean a document's count is the sum of several smaller draws, so
# that the first probability, exp(-mean), stays well inside a double.
MAX_MEAN = 64.0
#: The table of sources, under 2 KB a row, is broadcast up to so many rows.
BROADCAST_SOURCES = 20_000


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 of the parts."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def _cdf(mean: Column) -> Column:
    """Cumulative Poisson probabilities up to where the rest is below 1e-15."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int")
    zero = F.struct(
        F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.array(F.exp(-mean)).alias("all")
    )

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k.cast("double")
        return F.struct(
            p.alias("p"), (acc["c"] + p).alias("c"), F.array_append(acc["all"], acc["c"] + p).alias("all")
        )

    return F.aggregate(F.sequence(F.lit(1), last), zero, step, lambda acc: acc["all"])


def poisson_mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    temperature: float = 0.5,
    budget: float = 1.0,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Repeat or drop documents so that each source's bytes meet its target in
    expectation; then shuffle globally. Adds ``copy_no`` and ``shuffle_key``.

    ``weights`` (source, weight) gives targets, scaled to sum to one; a source
    without a row there, or with weight 0, is left out. Without it a source
    weighs its bytes to the power ``temperature``. The result has ``budget``
    times the input's bytes in expectation. A document's mean repetition rate
    is target bytes over source bytes; its count inverts the Poisson
    distribution at a uniform number hashed from seed, id and text, so every
    re-run and retried task draws alike. Each document decides for itself: a
    source that holds a third of all rows is never gathered, only summed
    (map-side first). The shuffle is by a hash of document and copy.

    A null source is a source of its own. Null and empty texts count zero
    bytes (a source with none at all has rate ``budget``). Rows alike in id and
    text are drawn alike. Empty tables give no rows. Input columns named
    ``copy_no`` or ``shuffle_key`` are replaced; all others are kept.
    """
    docs = without(docs, "copy_no", "shuffle_key")
    kept = docs.columns
    # Names of what the documents get on the way, none of them a column of theirs.
    of, draws, cdf, me, times = unused_names(5, docs)
    sums = docs.groupBy(F.col(source_col).alias("_source")).agg(
        F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).cast("double").alias("_bytes")
    )
    if weights is None:
        sums = sums.withColumn("_weight", F.pow("_bytes", F.lit(float(temperature))))
    else:
        w = weights.select(F.col("source").alias("_of"), F.col("weight").cast("double").alias("_weight"))
        sums = sums.join(w, sums["_source"].eqNullSafe(w["_of"]), "left").drop("_of")
        sums = sums.withColumn("_weight", F.coalesce("_weight", F.lit(0.0)))
    # One row of totals beside one row per source: a join without keys, of one row.
    total = sums.agg(F.sum("_bytes").alias("_all"), F.sum("_weight").alias("_weights"))
    rates = (
        sums.join(F.broadcast(total))
        .select(
            "_source",
            F.when(F.col("_bytes") > 0, F.lit(float(budget)) * F.col("_all") * F.col("_weight")
                   / F.col("_weights") / F.col("_bytes"))
            .otherwise(F.lit(float(budget))).alias("_rate"),
        )
        .withColumn("_draws", F.greatest(F.lit(1), F.ceil(F.col("_rate") / MAX_MEAN).cast("int")))
        .withColumn("_cdf", _cdf(F.col("_rate") / F.col("_draws")))
        .select(F.col("_source").alias(of), F.col("_draws").alias(draws), F.col("_cdf").alias(cdf))
    )
    digest = F.md5(F.concat_ws(
        ":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")),
        F.coalesce(F.col(text_col), F.lit("")),
    ).cast("binary"))
    rates = checkpoint(rates)
    # Up to here a row a source; beyond the bound Spark joins by shuffle.
    small = F.broadcast(rates) if rates.count() <= BROADCAST_SOURCES else rates
    drawn = docs.join(small, F.col(source_col).eqNullSafe(F.col(of))).withColumn(me, digest)

    def draw(acc: Column, i: Column) -> Column:
        u = _unit(F.lit(str(seed)), i.cast("string"), F.col(me))
        return acc + F.size(F.filter(cdf, lambda c: c <= u))

    counted = drawn.withColumn(
        times, F.aggregate(F.sequence(F.lit(1), F.col(draws)), F.lit(0), draw)
    ).where(F.col(times) > 0)
    out = counted.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col(times)))).withColumn(
        "shuffle_key",
        F.conv(F.substring(F.md5(F.concat_ws(
            ":", F.lit(str(seed)), F.lit("order"), F.col(me), F.col("copy_no").cast("string")
        ).cast("binary")), 1, 15), 16, 10).cast("bigint"),
    )
    return (
        out.select(*[F.col(f"`{c}`") for c in kept], "copy_no", "shuffle_key")
        .repartition("shuffle_key")
        .sortWithinPartitions("shuffle_key")
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix(read_table(spark, sf_dir, "documents"))


OP2_SQL = """
WITH RECURSIVE docs AS (
  SELECT *, coalesce(strlen(text), 0) AS _b,
         md5(concat_ws(':', coalesce(doc_id::VARCHAR, 'null'), coalesce(text, ''))) AS _me
  FROM documents
), sums AS (
  SELECT source AS s, sum(_b)::DOUBLE AS b, sqrt(sum(_b)::DOUBLE) AS w FROM docs GROUP BY source
), rates AS (
  SELECT s, CASE WHEN b > 0 THEN (SELECT sum(b) FROM sums) * w / (SELECT sum(w) FROM sums) / b
            ELSE 1.0 END AS r FROM sums
), split AS (
  SELECT s, greatest(1, ceil(r / 64.0)::INT) AS draws, r / greatest(1, ceil(r / 64.0)::INT) AS m FROM rates
), cdf AS (
  SELECT s, draws, m, 0 AS k, exp(-m) AS p, exp(-m) AS c FROM split
  UNION ALL
  SELECT s, draws, m, k + 1, p * m / (k + 1), c + p * m / (k + 1) FROM cdf
  WHERE k < ceil(m + 12 * sqrt(m) + 20)
), tables AS (
  SELECT s, any_value(draws) AS draws, list(c ORDER BY k) AS cs FROM cdf GROUP BY s
), drawn AS (
  SELECT d.*, t.cs, unnest(range(1, t.draws + 1)) AS i FROM docs d JOIN tables t ON d.source IS NOT DISTINCT FROM t.s
), counted AS (
  SELECT doc_id, text, lang, source, n_chars, _me,
         len(list_filter(cs, lambda c: c <= ('0x' || substr(md5('17:' || i::VARCHAR || ':' || _me), 1, 13))::BIGINT / 4503599627370496.0)) AS n
  FROM drawn
), whole AS (
  SELECT doc_id, text, lang, source, n_chars, _me, sum(n)::INT AS n FROM counted
  GROUP BY doc_id, text, lang, source, n_chars, _me
), copies AS (
  SELECT *, unnest(range(1, n + 1))::INT AS copy_no FROM whole WHERE n > 0
)
SELECT doc_id, text, lang, source, n_chars, copy_no,
       ('0x' || substr(md5('17:order:' || _me || ':' || copy_no::VARCHAR), 1, 15))::BIGINT AS shuffle_key
FROM copies
"""
