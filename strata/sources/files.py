"""CSV source and sink for product files (every column read as text)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.names import unused_names
from strata.schemas import RAW_LINE, SOURCE_COLUMNS


def read_csv_source(spark: SparkSession, path: str | list[str],
                    columns: Sequence[str] = SOURCE_COLUMNS, *, raw_line: bool = False,
                    options: dict[str, str] | None = None) -> DataFrame:
    """Scan header CSV files without type inference and select ``columns`` by name.

    Header names are matched case-insensitively; a missing column fails
    analysis, other columns are ignored. Each path of a list is read with its own
    header, so files may differ in column order and extra columns. All files
    below one path must have the same header: Spark raises where one differs,
    instead of reading its columns by position. A quote inside a quoted field is
    written twice (``options={"escape": "\\\\"}`` for files that escape it).

    With ``raw_line`` a column of that name holds the whole text of every
    malformed line (fewer or more fields than the header, a quote that is never
    closed); all other columns of such a row are NULL. It is NULL for well-formed
    lines. Without, fields of a malformed line fall where they fall. Blank lines
    are no rows.
    """
    if not isinstance(path, str):
        frames = [read_csv_source(spark, p, columns, raw_line=raw_line, options=options) for p in path]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out
    reader = spark.read.format("csv").options(**{
        "header": True, "inferSchema": False, "mode": "PERMISSIVE", "enforceSchema": False, "escape": '"',
        **(options or {}),
    })
    found = reader.load(path)
    by_lower = {c.lower(): c for c in found.columns}
    missing = [c for c in columns if c.lower() not in by_lower]
    if missing:
        raise ValueError(f"CSV source lacks columns {missing}; has {found.columns}")
    chosen = [F.col(f"`{by_lower[c.lower()]}`").alias(c) for c in columns]
    if not raw_line:
        return found.select(*chosen)
    (line,) = unused_names(1, found)
    # Every field is parsed: with fewer, Spark would not see that some are missing.
    rows = (reader.option("columnPruning", False).option("columnNameOfCorruptRecord", line)
            .schema(StructType([*found.schema.fields, StructField(line, StringType())])).load(path))
    whole = F.col(line).isNull()
    return rows.select(*[F.when(whole, col).alias(name) for name, col in zip(columns, chosen, strict=True)],
                       F.col(line).alias(RAW_LINE))


def write_csv(df: DataFrame, path: str, *, mode: str = "errorifexists", compression: str = "none",
              rows_per_file: int = 0) -> None:
    """Write header CSV that reads back unchanged (whitespace and "" kept). A
    compressed file is read by one task: ``rows_per_file`` (0: any) bounds it."""
    (
        df.write.mode(mode)
        .option("compression", compression)
        .option("maxRecordsPerFile", rows_per_file)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("escape", '"')
        .csv(path)
    )


def write_lines(lines: DataFrame, path: str, *, mode: str = "errorifexists", compression: str = "none",
                rows_per_file: int = 0) -> None:
    """Write the one text column of ``lines`` as it is, a line each, below a header
    line that is the column's name: CSV that was made elsewhere. ``compression``
    and ``rows_per_file`` as in :func:`write_csv`."""
    (
        lines.write.mode(mode)
        .option("compression", compression)
        .option("maxRecordsPerFile", rows_per_file)
        .option("header", True)
        .option("sep", "\u0001")  # in no line
        .option("quote", "")
        .option("escapeQuotes", False)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
