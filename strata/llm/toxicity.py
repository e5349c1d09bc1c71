"""Toxic passages: maximum-scoring segments over token log-odds."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

from strata.functions.names import unused_names
from strata.llm.common import checkpoint, read_table, without

TOKEN = re.compile(r"[^\W_]+")
#: Token scores that every task holds. Beyond this many, the scores of the
#: rarer tokens stay in a table that the texts' tokens are joined to.
HELD_SCORES = 200_000
#: Prior strength of the Dirichlet, in documents, and its floor for one token.
PRIOR_DOCS = 10.0
PRIOR_FLOOR = 0.5
#: A log-odds counts as far as its posterior lies beyond zero at this many
#: standard deviations of a normal (its quantile level).
SURE = 2.0
#: Every token costs this much, so that random text drifts downwards.
DRIFT = 0.3
#: A passage is significant if a text of its length has, by chance, at most
#: this many such passages.
MAX_E = 0.05
THRESHOLD = 0.3
#: Labelled documents are joined by broadcasting their ids up to this many.
BROADCAST_LABELS = 2_000_000
#: Cells in which evidence is counted for the final calibration.
CELLS = 400
CELL_WIDTH = 0.25
#: Distinct tokens a task holds before it hands partial counts on.
HELD_TOKENS = 300_000
#: Steps in which scores are counted for the chance law, per unit, and document
#: counts for the choice of held tokens, per doubling.
SCORE_STEPS = 256
COUNT_STEPS = 16


@dataclass(frozen=True)
class ToxicityModel:
    """Token scores and the calibration of passage scores. ``scores`` holds all
    scored tokens, or, if these are more than ``HELD_SCORES``, about that many of
    the tokens in most documents (scored or not), and ``rare`` (token, score) the
    other scored ones."""

    scores: dict[str, float]
    rate: float  # lambda of the extreme-value law
    scale: float  # K of the extreme-value law
    intercept: float = 0.0
    slope: float = 1.0
    rare: DataFrame | None = None


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring runs (start, end, score), in order, in linear time.

    Every candidate holds the running sum before it (low) and after it (high)
    and the nearest candidate to its left with a lower low. A new one either
    stands, or, if its high exceeds that candidate's, swallows all from there.
    """
    runs: list[tuple[int, int, float, float, int]] = []
    total = 0.0
    for i, s in enumerate(scores):
        if s > 0:
            start, low, high = i, total, total + s
            while True:
                j = len(runs) - 1
                while j >= 0 and runs[j][2] >= low:
                    j = runs[j][4]
                if j < 0 or runs[j][3] >= high:
                    runs.append((start, i + 1, low, high, j))
                    break
                start, low = runs[j][0], runs[j][2]
                del runs[j:]
        total += s
    return [(a, b, high - low) for a, b, low, high, _ in runs]


def passages(
    text: str | None, model: ToxicityModel, rare: dict[str, float] | None = None
) -> tuple[int, list[tuple[int, int, float, float]]]:
    """Token count and the maximal passages (start, end, score, E). ``rare``
    has the scores of the text's tokens that the model does not hold."""
    words = tokens(text)
    if not words:
        return 0, []
    get = model.scores.get
    also = (rare or {}).get
    s = np.fromiter((get(w) or also(w, 0.0) for w in words), np.float64, len(words)) - DRIFT
    up = np.flatnonzero(s > 0)
    if not len(up):
        return len(words), []
    # Between two rising tokens only the sum matters: shorten each such stretch
    # to one entry before the scan.
    sums = np.concatenate(([0.0], np.cumsum(s)))
    short: list[float] = []
    at: list[int] = []
    last = int(up[0])
    for p in up.tolist():
        if p > last:
            short.append(float(sums[p] - sums[last]))
            at.append(last)
        short.append(float(s[p]))
        at.append(p)
        last = p + 1
    found = maximal_segments(short)
    n = len(words)
    return n, [
        (at[a], at[b - 1] + 1, score, model.scale * n * math.exp(-min(700.0, model.rate * score)))
        for a, b, score in found
    ]


def evidence(
    text: str | None, model: ToxicityModel, rare: dict[str, float] | None = None
) -> tuple[float, list[tuple[int, int, float, float]]]:
    """A document's evidence and its significant passages.

    Evidence adds, over the significant passages, how far each passage's
    normalised score lies above the extreme-value location of a text of that
    length (-ln E). Without any it is that of the best passage, at least -4, so
    weak passages still differ and the calibration weighs them.
    """
    _, found = passages(text, model, rare)
    good = [x for x in found if x[3] <= MAX_E]
    if good:
        return sum(-math.log(max(x[3], 1e-300)) for x in good), good
    best = min((x[3] for x in found), default=math.inf)
    return max(-4.0, -math.log(best) if best < math.inf else -4.0), good


def _gamma_quantile(shape: np.ndarray, z: float) -> np.ndarray:
    """Gamma quantile at the level of the normal deviate z (Wilson and Hilferty),
    at least 1e-9 of the shape."""
    return shape * np.maximum(1e-3, 1 - 1 / (9 * shape) + z / (3 * np.sqrt(shape))) ** 3


def _prior(c0: np.ndarray, c1: np.ndarray, n: int) -> np.ndarray:
    return np.maximum(PRIOR_FLOOR, PRIOR_DOCS * (c0 + c1) / n)


def shrunken_log_odds(c0: np.ndarray, c1: np.ndarray, clean_docs: int, toxic_docs: int) -> np.ndarray:
    """Log-odds of tokens that c0 clean and c1 toxic documents hold, moved
    towards zero by their uncertainty, and zero where that spans zero.

    The posterior of each class's share is a gamma with the prior added. Its
    quantiles lie unevenly about the estimate, above all where a class has no
    such document: only the side towards zero counts, and the two classes' are
    combined as independent.
    """
    a = _prior(c0, c1, clean_docs + toxic_docs)
    toxic, clean = c1 + a, c0 + a
    odds = np.log(toxic / (toxic_docs + PRIOR_DOCS + a)) - np.log(clean / (clean_docs + PRIOR_DOCS + a))
    side = np.where(odds > 0, 1.0, -1.0) * SURE
    error = np.hypot(
        np.log(_gamma_quantile(toxic, -side) / toxic), np.log(_gamma_quantile(clean, side) / clean)
    )
    return np.sign(odds) * np.maximum(0.0, np.abs(odds) - error)


def _decay(values: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """lambda and K of the extreme-value law for scores drawn independently.

    lambda solves E[exp(lambda s)] = 1. K is the standard first-order form
    with the increments' spread; it moves every E alike, and the final
    calibration takes up any remaining factor.
    """
    p = weights / weights.sum()
    lo, hi = 1e-6, 1e-6
    def moment(x): return float(np.log(p @ np.exp(np.minimum(700, x * values))))
    if values.max() <= 0 or p @ values >= 0:
        return 1.0, 1.0
    while moment(hi) < 0 and hi < 500:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if moment(mid) < 0 else (lo, mid)
    rate = hi
    slope = float(p @ (values * np.exp(np.minimum(700, rate * values))))
    scale = min(1.0, (p @ values) ** 2 / max(slope, 1e-9) * rate)
    return rate, max(scale, 1e-6)


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the training rows."""
    own, label = unused_names(2, docs)
    train = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
        .groupBy(F.col("doc_id").alias(own))
        .agg(F.max("toxic").cast("int").alias(label))
    )
    few = train.count() <= BROADCAST_LABELS
    return docs.join(F.broadcast(train) if few else train, F.col("doc_id") == F.col(own)).select(
        "text", F.col(label).alias("toxic")
    )


def _document_counts(train: DataFrame) -> DataFrame:
    """(token, clean, toxic): in how many documents of each class it occurs.
    Counts leave a task pre-aggregated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()),
                 pa.array([v[0] for v in held.values()], pa.int64()),
                 pa.array([v[1] for v in held.values()], pa.int64())],
                names=["token", "clean", "toxic"],
            )

        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                # The empty token counts documents.
                for w in {"", *tokens(text.as_py())}:
                    held.setdefault(w, [0, 0])[1 if toxic else 0] += 1
                if len(held) >= HELD_TOKENS:
                    yield out()
                    held.clear()
        yield out()

    partial = train.mapInArrow(run, "token string, clean long, toxic long")
    return partial.groupBy("token").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _scored(counts: DataFrame, clean_docs: int, toxic_docs: int) -> DataFrame:
    """(token, docs, score, mass): mass is the posterior count among clean
    documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c0 = batch.column("clean").to_numpy(zero_copy_only=False).astype(float)
            c1 = batch.column("toxic").to_numpy(zero_copy_only=False).astype(float)
            yield pa.RecordBatch.from_arrays(
                [batch.column("token"), pa.array((c0 + c1).astype(np.int64)),
                 pa.array(shrunken_log_odds(c0, c1, clean_docs, toxic_docs)),
                 pa.array(c0 + _prior(c0, c1, clean_docs + toxic_docs))],
                names=["token", "docs", "score", "mass"],
            )

    return counts.where(F.col("token") != "").mapInArrow(run, "token string, docs long, score double, mass double")


def _held_and_rare(scored: DataFrame) -> tuple[dict[str, float], DataFrame | None]:
    """The scores that every task holds, and the table of the others if there
    are any. The tokens in most documents are held even if they do not score,
    so that none of them is a key of the join."""
    nonzero = scored.where("score <> 0")
    rare = None
    if nonzero.count() <= HELD_SCORES:
        held = nonzero
    else:
        step = F.floor(F.log2("docs") * COUNT_STEPS)
        # A row for each step: at most 64 * COUNT_STEPS.
        sizes = sorted(scored.groupBy(step.alias("step")).count().collect(), reverse=True)
        total, least = 0, sizes[0]["step"] + 1
        for r in sizes:
            total += r["count"]
            if total > HELD_SCORES:
                break
            least = r["step"]
        held = scored.where(step >= least)
        rare = checkpoint(nonzero.where(step < least).select("token", "score"))
    table = held.select("token", "score").toArrow()
    return dict(zip(table.column("token").to_pylist(), table.column("score").to_pylist())), rare


def _with_rare(docs: DataFrame, model: ToxicityModel, text_col: str) -> DataFrame:
    """Adds a last column: the scores of a text's tokens that the model does not
    hold, looked up by joining the distinct tokens of each text to its table."""
    key_name, last = unused_names(2, docs)
    kind = F.lit(None).cast("map<string,double>")
    if model.rare is None:
        return docs.withColumn(last, kind)
    held = docs.sparkSession.sparkContext.broadcast(model.scores)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("_key"), batch.column("_text")):
                own = [w for w in set(tokens(text.as_py())) if w not in held.value]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key.as_py()] * len(own), pa.string()), pa.array(own, pa.string())],
                    names=["_key", "token"],
                )

    keyed = docs.withColumn(key_name, F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
    # Equal texts have one key: each of their tokens is looked up once.
    pairs = keyed.select(F.col(key_name).alias("_key"), F.col(text_col).alias("_text")).mapInArrow(run, "_key string, token string").distinct()
    found = pairs.join(model.rare, "token").groupBy(F.col("_key").alias(key_name)).agg(
        F.map_from_entries(F.collect_list(F.struct("token", "score"))).alias(last)
    )
    return keyed.join(found, key_name, "left").drop(key_name)


def _rare_of(batch: pa.RecordBatch) -> Iterator[dict[str, float] | None]:
    for x in batch.column(batch.num_columns - 1):
        yield dict(x.as_py()) if x.is_valid else None


def _evidence_cells(train: DataFrame, model: ToxicityModel) -> dict[int, tuple[int, int]]:
    shared = train.sparkSession.sparkContext.broadcast(replace(model, rare=None))
    train = _with_rare(train, model, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((CELLS, 2), np.int64)
        for batch in batches:
            for text, toxic, rare in zip(batch.column("text"), batch.column("toxic").to_pylist(), _rare_of(batch)):
                x, _ = evidence(text.as_py(), shared.value, rare)
                counts[min(CELLS - 1, int((x + 4.0) / CELL_WIDTH)), 1 if toxic else 0] += 1
        at = np.flatnonzero(counts.sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(counts[at, 0]), pa.array(counts[at, 1])],
            names=["cell", "clean", "toxic"],
        )

    cells = train.mapInArrow(run, "cell long, clean long, toxic long").groupBy("cell").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    # At most CELLS rows.
    return {r["cell"]: (r["clean"], r["toxic"]) for r in cells.collect()}


def _calibrate(cells: dict[int, tuple[int, int]]) -> tuple[float, float]:
    """Logistic intercept and slope over the counted cells, by Newton steps with
    a weak pull of the slope towards one tenth."""
    x = np.array([c * CELL_WIDTH - 4.0 + CELL_WIDTH / 2 for c in cells])
    n = np.array([sum(v) for v in cells.values()], float)
    y = np.array([v[1] for v in cells.values()], float)
    a, b = 0.0, 0.1
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = n * p * (1 - p) + 1e-9
        g = np.array([(y - n * p).sum() - 1e-3 * a, ((y - n * p) * x).sum() - (b - 0.1)])
        h = np.array([[w.sum() + 1e-3, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 1.0]])
        step = np.linalg.solve(h, g)
        step = np.clip(step, -1.0, 1.0)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(max(b, 0.0))


def train_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit on every labelled document whose ``crc32(doc_id as text) % 4`` is not
    2. Rows of ``labels`` with a null id or label are left out; of rows that
    contradict each other, toxic wins. Without any toxic or any clean document
    no token scores, and all documents score alike.

    A token's log-odds compares the share of toxic and of clean documents that
    hold it, under a Dirichlet prior in proportion to the corpus, less its
    uncertainty (``shrunken_log_odds``). Documents, not occurrences, are
    counted, so a passage repeated within one document weighs once.
    """
    train = _labelled(docs, labels)
    counts = _document_counts(train).persist()
    try:
        head = counts.where(F.col("token") == "").first()
        if head is None or not head["clean"] or not head["toxic"]:
            return ToxicityModel({}, 1.0, 1.0, -3.0, 0.0)
        clean_docs, toxic_docs = head["clean"], head["toxic"]
        scored = _scored(counts, clean_docs, toxic_docs)
        scores, rare = _held_and_rare(scored)
        # The chance law: scores as clean documents draw their tokens, the prior
        # standing in for tokens that no clean document has shown. A row for
        # each step of scores, and scores are logarithms of counts: few rows.
        law = scored.groupBy((F.round(F.col("score") * SCORE_STEPS) / SCORE_STEPS).alias("score")).agg(
            F.sum("mass").alias("mass")
        ).toArrow()
    finally:
        counts.unpersist()
    values = np.concatenate((law.column("score").to_numpy(), [0.0])) - DRIFT
    rate, scale = _decay(values, np.concatenate((law.column("mass").to_numpy(), [1.0])))
    model = ToxicityModel(scores, rate, scale, rare=rare)
    intercept, slope = _calibrate(_evidence_cells(train, model))
    return replace(model, intercept=intercept, slope=slope)


PASSAGES = ArrayType(StructType([
    StructField("start", IntegerType()), StructField("end", IntegerType()),
    StructField("score", DoubleType()), StructField("expected", DoubleType()),
]))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """Adds ``toxicity`` (0 to 1) and ``toxic_passages`` (token start, end,
    score, and how many as good chance alone would give).

    Texts are read whole, one row at a time; nothing is shuffled unless the
    model has a table of rare tokens (``_with_rare``). Null and empty texts have
    no passage and score as a document without evidence. Input columns with
    those two names are replaced.
    """
    docs = without(docs, "toxicity", "toxic_passages")
    schema = StructType([
        *docs.schema.fields, StructField("toxicity", DoubleType()), StructField("toxic_passages", PASSAGES),
    ])
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, rare=None))
    docs = _with_rare(docs, model, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        kind = pa.list_(pa.struct([
            ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64()),
        ]))
        for batch in batches:
            scores, found = [], []
            for text, rare in zip(batch.column(text_col), _rare_of(batch)):
                x, good = evidence(text.as_py(), m, rare)
                z = m.intercept + m.slope * min(x, CELLS * CELL_WIDTH)
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                found.append([{"start": a, "end": b, "score": s, "expected": e} for a, b, s, e in good])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64()), pa.array(found, kind)],
                names=[*batch.schema.names[:-1], "toxicity", "toxic_passages"],
            )

    return docs.mapInArrow(run, schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
    )
