"""Sources (CSV files, catalog tables, derived test inputs) and the table store."""

from strata.sources.checkpoints import checkpoint_root
from strata.sources.files import read_csv_source, write_csv
from strata.sources.lineage import with_lineage
from strata.sources.store import Buckets, TableSpec, TableStore
from strata.sources.tables import LISTING_COLUMN_MAP, map_columns, read_table

__all__ = [
    "Buckets",
    "LISTING_COLUMN_MAP",
    "TableSpec",
    "TableStore",
    "checkpoint_root",
    "map_columns",
    "read_csv_source",
    "read_table",
    "with_lineage",
    "write_csv",
]
