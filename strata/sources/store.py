"""Layer tables in Spark's catalog.

Every table is an external Parquet table of one database, made by DDL from its
declared schema, so that any SQL user reads it by name. How a table is written
depends on its kind:

* a **snapshot** is replaced whole. Its rows go to the one of two folders that
  readers don't see, then ``ALTER TABLE ... SET LOCATION`` points the name
  there: all or nothing, and a failed write leaves the table as it was;
* a **batches** table keeps what each batch brought in partitions of its own
  (``batch_id`` is the last partition column). Writing a batch overwrites its
  partitions and no others, so a batch can be replayed;
* a **parts** table is partitioned by a part number and bucketed. A write
  replaces the parts that it holds rows of;
* a **log** is appended to.

Batches and parts are written by dynamic partition overwrite: Spark puts new
files aside and moves them in when the whole job has succeeded.

Each write observes its row count and the NULL count of every column.
:meth:`TableStore.flush_metrics` appends them, with the folder written to, to
the table ``layer_metrics``. The catalog says where a table's rows are; a
catalog that does not know the tables yet (a session without a metastore) is
told by that log. One writer at a time.
"""

from __future__ import annotations

import hashlib
import threading
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.functions.names import quoted
from strata.schemas import enforce_schema

SNAPSHOT, BATCHES, PARTS, LOG = "snapshot", "batches", "parts", "log"
SLOTS = ("a", "b")
METRICS = "layer_metrics"
METRICS_SCHEMA = StructType([
    StructField("layer", StringType()), StructField("part", StringType()), StructField("ordinal", LongType()),
    StructField("column_name", StringType()), StructField("data_type", StringType()),
    StructField("row_count", LongType()), StructField("null_count", LongType()),
    StructField("location", StringType()), StructField("batch_id", StringType()), StructField("write_no", LongType()),
])


@dataclass(frozen=True)
class Buckets:
    """``count`` buckets on ``column``, sorted by it."""

    count: int
    column: str


@dataclass(frozen=True)
class TableSpec:
    """A table's declared columns and how it is written. Columns in ``optional``
    are NULL where a writer leaves them out; ``shown`` (default: all) are those
    whose NULLs are counted."""

    schema: StructType
    kind: str = SNAPSHOT
    partition_by: tuple[str, ...] = ()
    buckets: Buckets | None = None
    optional: frozenset[str] = frozenset()
    shown: StructType | None = None

    def columns(self) -> list[StructField]:
        """In the table's order: partition columns last."""
        rest = [f for f in self.schema.fields if f.name not in self.partition_by]
        return rest + [self.schema[c] for c in self.partition_by]

    def counted(self) -> StructType:
        return self.shown or self.schema


@dataclass(frozen=True)
class Metric:
    """What one write brought: rows and NULLs of each shown column."""

    layer: str
    part: str
    schema: StructType
    rows: int
    nulls: tuple[int, ...]
    location: str
    write_no: int


def null_counts(schema: StructType) -> Column:
    """An aggregate: the rows of a frame and the NULLs of its columns, as (rows, nulls)."""
    nulls = ", ".join(f"count_if({quoted(f.name)} IS NULL)" for f in schema.fields)
    return F.expr(f"named_struct('rows', count(1), 'nulls', array({nulls}))").alias("counted")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _partition(values: Mapping[str, str]) -> str:
    return ", ".join(f"`{k}` = {_text(v)}" for k, v in values.items())


class TableStore:
    """The tables of one database, their files under ``root``.

    ``database`` is made where it does not exist; without one, its name is
    derived from ``root``, so one root is always the same database.
    """

    def __init__(self, spark: SparkSession, root: str, database: str | None = None):
        if not root:
            raise ValueError("a table store needs a root folder that outlives the session")
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database or f"strata_{hashlib.sha1(self.root.encode()).hexdigest()[:12]}"
        self.specs: dict[str, TableSpec] = {}
        self._metrics: list[Metric] = []
        self._lock = threading.Lock()

    # -- DDL -----------------------------------------------------------------
    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{table}")

    def ensure(self, specs: Mapping[str, TableSpec]) -> None:
        """``CREATE DATABASE`` and ``CREATE TABLE`` for what does not exist yet. Rows
        that are under the root already belong to the new tables."""
        new = {t: s for t, s in specs.items() if t not in self.specs}
        if not new:
            return
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION {_text(self.root)}")
        known = {r.tableName for r in self.spark.sql(f"SHOW TABLES IN `{self.database}`").collect()}
        if METRICS not in known:
            self._create(METRICS, TableSpec(METRICS_SCHEMA, LOG), f"{self.root}/{METRICS}")
        self.specs.setdefault(METRICS, TableSpec(METRICS_SCHEMA, LOG))
        if absent := [t for t in new if t not in known]:
            written = self.last_locations()
            for table in absent:
                default = f"{self.root}/{table}" + (f"/{SLOTS[0]}" if new[table].kind == SNAPSHOT else "")
                self._create(table, new[table], written.get(table, default))
        self.specs.update(new)

    def last_locations(self) -> dict[str, str]:
        """Where the metrics say that each table was last written."""
        rows = self.spark.table(self.name(METRICS)).groupBy("layer").agg(
            F.max_by("location", "write_no").alias("location")).collect()
        return {r.layer: r.location for r in rows if r.location}

    def _create(self, table: str, spec: TableSpec, location: str) -> None:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.columns())
        ddl = f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({cols}) USING parquet"
        if spec.partition_by:
            ddl += f" OPTIONS ('partitionOverwriteMode' = 'dynamic') PARTITIONED BY ({', '.join(spec.partition_by)})"
        if spec.buckets:
            on = f"`{spec.buckets.column}`"
            ddl += f" CLUSTERED BY ({on}) SORTED BY ({on}) INTO {spec.buckets.count} BUCKETS"
        self.spark.sql(f"{ddl} LOCATION {_text(location)}")
        if spec.partition_by:
            try:
                self.spark.sql(f"ALTER TABLE {self.name(table)} RECOVER PARTITIONS")
            except Exception as exc:  # noqa: BLE001 - of a new table there is no folder yet
                if "FileNotFoundException" not in str(exc):
                    raise

    def create(self, table: str, spec: TableSpec, location: str) -> None:
        """One more table, at a folder of the caller's choice."""
        if not self.exists(table):
            self._create(table, spec, location)
        self.specs[table] = spec

    def forget(self, table: str) -> None:
        """Take a table out of the catalog and empty its folder."""
        location = self.location(table)
        schema = self.spark.table(self.name(table)).schema
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(location)
        self.specs.pop(table, None)

    def location(self, table: str) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").collect()
        return next(r.data_type for r in reversed(rows) if r.col_name == "Location").rstrip("/")

    def view(self, name: str, query: str, properties: Mapping[str, str] | None = None) -> None:
        """Let ``name`` be what ``query`` reads."""
        shown = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in (properties or {}).items())
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(name)}"
                       + (f" TBLPROPERTIES ({shown})" if shown else "") + f" AS {query}")

    def properties(self, table: str) -> dict[str, str]:
        return {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()}

    def set_properties(self, table: str, **values: str | int) -> None:
        shown = ", ".join(f"{_text(k)} = {_text(str(v))}" for k, v in values.items())
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET TBLPROPERTIES ({shown})")

    # -- writes --------------------------------------------------------------
    def _observed(self, table: str, df: DataFrame) -> tuple[DataFrame, Observation]:
        spec = self.specs[table]
        have = {c.lower() for c in df.columns}
        if absent := sorted(c for c in spec.optional if c.lower() not in have):
            df = df.selectExpr("*", *[f"CAST(NULL AS {spec.schema[c].dataType.simpleString()}) AS {quoted(c)}"
                                      for c in absent])
        df = enforce_schema(df, StructType(spec.columns()))
        obs = Observation()
        return df.observe(obs, null_counts(spec.counted())), obs

    def record(self, table: str, part: str, rows: int, nulls: Sequence[int], *, layer: str | None = None,
               schema: StructType | None = None, location: str | None = None) -> None:
        """Remember what a write brought until the metrics are flushed."""
        with self._lock:
            self._metrics.append(Metric(
                layer or table, part, schema or self.specs[table].counted(), rows, tuple(nulls),
                location or self.location(table), time.time_ns()))

    def _record(self, table: str, part: str, obs: Observation, location: str) -> int:
        # A frame that is known to be empty before it runs has nothing to observe.
        counted = obs.get.get("counted")
        rows, nulls = counted or (0, [0] * len(self.specs[table].counted().fields))
        self.record(table, part, rows, nulls, location=location)
        return rows

    def last_metric(self, table: str) -> Metric:
        """What the last write of a table since the last flush brought."""
        with self._lock:
            return next(m for m in reversed(self._metrics) if m.layer == table)

    def publish(self, table: str, df: DataFrame) -> tuple[DataFrame, int]:
        """Replace a snapshot by ``df``; (the table read back, its rows)."""
        df, obs = self._observed(table, df)
        now = self.location(table)
        slot = f"{self.root}/{table}/{SLOTS[now.endswith('/' + SLOTS[0])]}"
        df.write.mode("overwrite").parquet(slot)
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION {_text(slot)}")
        return self.read(table), self._record(table, "", obs, slot)

    def replace_batch(self, table: str, df: DataFrame, batch_id: str, *, keep_others: bool) -> tuple[DataFrame, int]:
        """Let ``df`` be all that a batches table holds of ``batch_id``, and unless
        ``keep_others`` all that it holds; (the batch's rows read back, their
        number). Replaying a batch replaces what it brought, on whichever day.

        The batch's new partitions come in before others go, so a reader between
        the two sees both, and a failure in between loses nothing.
        """
        if not batch_id:
            raise ValueError("a batch needs an id")
        df, obs = self._observed(table, df)
        day = [c for c in self.specs[table].partition_by if c != "batch_id"]
        # The batch's other partition values are the same in all its rows.
        seen = Observation()
        if day:
            df = df.observe(seen, *[F.max(F.col(c).cast("string")).alias(c) for c in day])
        df.write.insertInto(self.name(table), overwrite=True)
        location = f"{self.root}/{table}"
        rows = self._record(table, batch_id, obs, location)
        written = {**({c: seen.get[c] for c in day} if day and rows else {}), "batch_id": batch_id}
        for old in self.partitions(table):
            ours = old["batch_id"] == batch_id
            if ours and rows and old == written or not ours and keep_others:
                continue
            self._drop_partition(table, old)
            if not ours:
                self.record(table, old["batch_id"], 0, [0] * len(self.specs[table].counted().fields),
                            location=location)
        return self.read(table).where(F.col("batch_id") == batch_id), rows

    def partitions(self, table: str) -> list[dict[str, str]]:
        rows = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()
        return [dict((k, unquote(v)) for k, v in (p.split("=", 1) for p in r[0].split("/"))) for r in rows]

    def _drop_partition(self, table: str, values: Mapping[str, str]) -> None:
        """Readers lose the partition at once; its files go by an empty overwrite."""
        spec = self.specs[table]
        nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in spec.columns()
                          if f.name not in values)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name(table)} PARTITION ({_partition(values)}) "
                       f"SELECT {nulls} WHERE false")
        self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION ({_partition(values)})")

    def replace_parts(self, table: str, df: DataFrame) -> None:
        """Overwrite the parts that ``df`` has rows of; others stay untouched. ``df``
        may be computed from the table itself."""
        df = enforce_schema(df, StructType(self.specs[table].columns()))
        df.write.insertInto(self.name(table), overwrite=True)

    def append(self, table: str, df: DataFrame) -> int:
        """Add ``df``'s rows to a log; returns their number."""
        df, obs = self._observed(table, df)
        df.write.insertInto(self.name(table))
        return self._record(table, f"append-{time.time_ns()}", obs, f"{self.root}/{table}")

    # -- reads ---------------------------------------------------------------
    def read(self, table: str, schema: StructType | None = None) -> DataFrame:
        """The table, or the columns of ``schema`` of it."""
        df = self.spark.table(self.name(table))
        return df if schema is None else df.select(*[quoted(f.name) for f in schema.fields])

    # -- metrics -------------------------------------------------------------
    def flush_metrics(self, batch_id: str) -> None:
        """Append what was observed since the last flush to ``layer_metrics``."""
        with self._lock:
            waiting, self._metrics = self._metrics, []
        rows = [(m.layer, m.part, i, f.name, f.dataType.simpleString(), m.rows, n, m.location, batch_id, m.write_no)
                for m in waiting for i, (f, n) in enumerate(zip(m.schema.fields, m.nulls, strict=True), 1)]
        if rows:
            self.spark.createDataFrame(rows, METRICS_SCHEMA).coalesce(1).write.insertInto(self.name(METRICS))
