"""Runs of the layers over the supplied test tables, shared by the queries.

Three scenarios, all over the whole ``lineitem`` table:

* ``full``: one batch holding every product row (CSV source) plus the wide
  listing table (catalog source);
* ``history``: two daily batches split by ship date (earlier rows first,
  then the rest), each loaded with the listing table, so the second run
  merges into the silver table of the first. Quarantine keeps both batches
  with the text as received. Two later runs whose source is
  missing leave their audit rows and change no table;
* ``faulty``: one batch of the products written line by line, some lines too
  short, too long or with a quote that never closes.

Inputs and tables live under the session's checkpoint directory, in a folder
unique to this process and session, and each scenario runs at most once per
session. Run identity (batch ids, times) is fixed, so results are reproducible.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import threading
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.layers import RunParams, Source
from strata.plans.runner import RunResult, run_layers
from strata.sources.checkpoints import checkpoint_root
from strata.sources.files import read_csv_source, write_csv, write_lines
from strata.sources.products import faulty_lines, listing_table, messy_products
from strata.sources.splits import fine_tasks
from strata.sources.store import TableStore
from strata.sources.tables import LISTING_COLUMN_MAP, map_columns

# Fixed run parameters of the scenarios (the oracle SQL uses the same values).
FULL_BATCH_ID = "batch-full"
FAULTY_BATCH_ID = "batch-faulty"
FULL_AS_OF = dt.datetime(2024, 1, 1, 6, 0, 0)
HISTORY_SPLIT_SHIPDATE = "1998-06-01"
HISTORY_RUNS = (("batch-1", dt.datetime(2024, 1, 1, 6, 0, 0)),
                ("batch-2", dt.datetime(2024, 1, 2, 6, 0, 0)))
FAILED_RUNS = (("batch-3", dt.datetime(2024, 1, 3, 6, 0, 0)),
               ("batch-4", dt.datetime(2024, 1, 4, 6, 0, 0)))
MISSING_SOURCE = "the daily file has not arrived"
PRODUCTS_LABEL = "products.csv"
LISTINGS_LABEL = "listings"
# How the inputs are written: compressed, in files of bounded size.
STORED = {"compression": "lz4", "rows_per_file": 500_000}

_PROCESS_TOKEN = uuid.uuid4().hex[:12]
_LOCK = threading.RLock()  # scenarios and inputs are built once even under concurrent callers


@dataclass
class StepClock:
    """A deterministic clock: ``start + step``, ``start + 2*step``, ..."""

    start: dt.datetime
    step: dt.timedelta = dt.timedelta(seconds=1)
    calls: int = field(default=0, compare=False)

    def __call__(self) -> dt.datetime:
        self.calls += 1
        return self.start + self.step * self.calls


class TestdataRuns:
    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        tag = hashlib.sha1(self.sf_dir.encode()).hexdigest()[:10]
        app = spark.sparkContext.applicationId
        self.root = f"{checkpoint_root(spark)}/strata-testdata/{app}-{_PROCESS_TOKEN}/{tag}"
        self._written: set[str] = set()
        # The scenarios' databases: strata_<process>_<tag>_full and so on.
        self.database = f"strata_{_PROCESS_TOKEN}_{tag}"
        self._full: RunResult | None = None
        self._history: list[RunResult] | None = None
        self._faulty: RunResult | None = None

    # -- inputs --------------------------------------------------------------
    def csv_path(self, name: str) -> str:
        return f"{self.root}/inputs/csv/{name}"

    def _ensure_csv(self, name: str, df: DataFrame) -> str:
        path = self.csv_path(name)
        with _LOCK:
            if path not in self._written:
                with fine_tasks(self.spark):
                    write_csv(df, path, **STORED)
                self._written.add(path)
        return path

    def products_csv(self, part: str = "all") -> str:
        rows = messy_products(self.spark, self.sf_dir, with_ship_date=True)
        if part == "early":
            rows = rows.where(F.col("l_shipdate") < F.lit(HISTORY_SPLIT_SHIPDATE).cast("timestamp"))
        elif part == "late":
            rows = rows.where(F.col("l_shipdate") >= F.lit(HISTORY_SPLIT_SHIPDATE).cast("timestamp"))
        return self._ensure_csv(f"products_{part}", rows.drop("l_shipdate"))

    def products_csv_split(self) -> list[str]:
        """The products in two files: one with its columns reversed and one more."""
        rows = messy_products(self.spark, self.sf_dir, with_ship_date=True)
        early = F.col("l_shipdate") < F.lit(HISTORY_SPLIT_SHIPDATE).cast("timestamp")
        turned = rows.where(~F.coalesce(early, F.lit(False)))
        turned = turned.select(F.lit("extra").alias("note"), *reversed(turned.drop("l_shipdate").columns))
        return [self._ensure_csv("products_early", rows.where(early).drop("l_shipdate")),
                self._ensure_csv("products_turned", turned)]

    def listings(self) -> DataFrame:
        path = f"{self.root}/inputs/listings"
        with _LOCK:
            if path not in self._written:
                with fine_tasks(self.spark):
                    listing_table(self.spark, self.sf_dir).write.parquet(path)
                self._written.add(path)
        return self.spark.read.parquet(path)

    def faulty_csv(self) -> str:
        """The products as lines, some of them malformed (:func:`faulty_lines`)."""
        path = self.csv_path("products_faulty")
        with _LOCK:
            if path not in self._written:
                with fine_tasks(self.spark):
                    write_lines(faulty_lines(self.spark, self.sf_dir), path, **STORED)
                self._written.add(path)
        return path

    def sources(self, part: str = "all") -> list[Source]:
        csv = self.products_csv(part)
        listings = self.listings()
        return [
            Source(PRODUCTS_LABEL, lambda: read_csv_source(self.spark, csv, raw_line=True)),
            Source(LISTINGS_LABEL, lambda: map_columns(listings, LISTING_COLUMN_MAP)),
        ]

    def distinct_sources(self, part: str = "all") -> list[Source]:
        """The products with their price in the name, so that hardly two rows are one product."""
        csv = self.products_csv(part)

        def load() -> DataFrame:
            rows = read_csv_source(self.spark, csv, raw_line=True)
            return rows.withColumn("name", F.concat_ws(" ", "name", "no_of_ratings", "actual_price"))

        return [Source(PRODUCTS_LABEL, load)]

    # -- scenarios -----------------------------------------------------------
    def full(self) -> RunResult:
        with _LOCK:
            return self._full_locked()

    def _full_locked(self) -> RunResult:
        if self._full is None:
            store = TableStore(self.spark, f"{self.root}/full", f"{self.database}_full")
            run = RunParams(FULL_BATCH_ID, FULL_AS_OF, clock=StepClock(FULL_AS_OF))
            result = _succeeded(run_layers(store, self.sources("all"), run))
            self.full_store = store
            self._full = result
        return self._full

    def history(self) -> list[RunResult]:
        with _LOCK:
            return self._history_locked()

    def _history_locked(self) -> list[RunResult]:
        if self._history is None:
            store = TableStore(self.spark, f"{self.root}/history", f"{self.database}_history")
            out = []
            for (batch_id, as_of), part in zip(HISTORY_RUNS, ("early", "late"), strict=True):
                run = RunParams(batch_id, as_of, clock=StepClock(as_of))
                out.append(_succeeded(run_layers(store, self.sources(part), run, keep_raw=True,
                                                 dead_letter_mode="append", by_change_share=1e9)))
            for batch_id, as_of in FAILED_RUNS:
                run_layers(store, [Source(PRODUCTS_LABEL, _missing_source)],
                           RunParams(batch_id, as_of, clock=StepClock(as_of)))
            self.history_store = store
            self._history = out
        return self._history

    def faulty(self) -> RunResult:
        """One batch of the products as lines, some of them malformed."""
        with _LOCK:
            if self._faulty is None:
                store = TableStore(self.spark, f"{self.root}/faulty", f"{self.database}_faulty")
                path = self.faulty_csv()
                source = Source(PRODUCTS_LABEL, lambda: read_csv_source(self.spark, path, raw_line=True))
                run = RunParams(FAULTY_BATCH_ID, FULL_AS_OF, clock=StepClock(FULL_AS_OF))
                self._faulty = _succeeded(run_layers(store, [source], run))
                self.faulty_store = store
            return self._faulty


def _missing_source() -> DataFrame:
    raise FileNotFoundError(MISSING_SOURCE)


def _succeeded(result: RunResult) -> RunResult:
    """Queries read the scenario's tables, so a failed layer must not pass silently."""
    if not result.succeeded:
        failed = [(r[1], r[2], r[5]) for r in result.checkpoints if r[2] != "SUCCESS"]
        raise RuntimeError(f"scenario run {result.run.batch_id} did not succeed: {failed}")
    return result


_RUNS: dict[tuple[str, str], TestdataRuns] = {}


def testdata_runs(spark: SparkSession, sf_dir: str) -> TestdataRuns:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _RUNS:
            _RUNS[key] = TestdataRuns(spark, sf_dir)
        return _RUNS[key]
