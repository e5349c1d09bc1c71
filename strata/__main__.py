"""Run the three layers as a job.

    python -m strata --csv 's3://bucket/products/*.csv' --table catalog.listings \\
        --store s3://bucket/lake/products --batch-id 2024-01-01

    spark-submit --py-files strata.zip strata/__main__.py --csv ... --store ...

Prints the run's checkpoint rows and the row count of every layer table as
JSON lines. Exits non-zero when a layer did not succeed.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys


def _parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="strata", description=__doc__.split("\n\n")[0])
    p.add_argument("--csv", action="append", default=[], help="product CSV path or glob (repeatable)")
    p.add_argument("--table", action="append", default=[],
                   help="catalog table of scraped listings, mapped by the listing column map (repeatable)")
    p.add_argument("--store", required=True, help="root folder of the tables, kept from run to run")
    p.add_argument("--batch-id", default=None, help="batch id (default: a random UUID)")
    p.add_argument("--as-of", default=None, help="run time, ISO format (default: now)")
    p.add_argument("--keep-raw", action="store_true", help="keep the received numeric text in quarantine")
    p.add_argument("--dead-letter-mode", choices=("overwrite", "append"), default="overwrite")
    p.add_argument("--bronze-mode", choices=("overwrite", "append"), default="overwrite",
                   help="append keeps every batch's raw rows instead of replacing them")
    p.add_argument("--plain-key-match", action="store_true",
                   help="match merge keys with SQL '=' (NULL never matches) instead of NULL-safe")
    p.add_argument("--silver-buckets", type=int, default=None, help="buckets of each part of silver, by key")
    p.add_argument("--silver-parts", type=int, default=None, help="parts of silver, by main category")
    p.add_argument("--database", default=None, help="database of the layer tables (default: one named after the root)")
    args = p.parse_args(argv)
    if not args.csv and not args.table:
        p.error("give at least one --csv or --table source")
    return args


def main(argv: list[str] | None = None) -> int:
    args = _parse(sys.argv[1:] if argv is None else argv)
    from pyspark.sql import SparkSession

    from strata.operators.quality import layer_counts
    from strata.plans.layers import RunParams, Source
    from strata.plans.runner import run_layers
    from strata.schemas import TABLES
    from strata.sources.files import read_csv_source
    from strata.sources.store import TableStore
    from strata.sources.tables import LISTING_COLUMN_MAP, map_columns, read_table

    spark = SparkSession.builder.appName("strata").getOrCreate()
    store = TableStore(spark, args.store, args.database)
    sources = [Source(path.rstrip("/").rsplit("/", 1)[-1], lambda path=path: read_csv_source(spark, path, raw_line=True))
               for path in args.csv]
    sources += [Source(name, lambda name=name: map_columns(read_table(spark, name), LISTING_COLUMN_MAP))
                for name in args.table]
    run = RunParams.now(args.batch_id)
    if args.as_of:
        run = RunParams(run.batch_id, dt.datetime.fromisoformat(args.as_of))
    result = run_layers(store, sources, run, keep_raw=args.keep_raw,
                        null_safe_merge=not args.plain_key_match,
                        dead_letter_mode=args.dead_letter_mode, silver_buckets=args.silver_buckets,
                        silver_parts=args.silver_parts,
                        bronze_mode=args.bronze_mode)
    for row in result.checkpoints:
        print(json.dumps(dict(zip(TABLES["checkpoints"].fieldNames(), row, strict=True)), default=str))
    for r in layer_counts({t: store.read(t) for t in TABLES if t != "checkpoints"}).collect():
        print(json.dumps({"layer": r["layer"], "row_count": r["row_count"]}))
    return 0 if result.succeeded else 1


if __name__ == "__main__":
    sys.exit(main())
