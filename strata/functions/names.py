"""Names for the columns that an operator adds only to drop again."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused_names(count: int, *frames: DataFrame) -> list[str]:
    """``count`` column names that none of the frames has, in any case."""
    taken = {c.lower() for df in frames for c in df.columns}
    out, k = [], 0
    while len(out) < count:
        if (name := f"__w{k}") not in taken:
            out.append(name)
        k += 1
    return out


def quoted(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"
