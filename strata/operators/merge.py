"""Keyed upsert (MERGE) as a plain DataFrame computation.

``upsert(target, source, keys, update_columns)`` returns the next state of the
target: matched rows take the source's values for ``update_columns`` and keep
their own for the rest, unmatched source rows are inserted whole, and target
rows the source does not mention stay as they are. ``changes`` gives the rows
that it changes, before and after.

Strategy:

* by default a left join (updates) and an anti join (inserts) on the keys,
  without hints: Spark broadcasts the source where its bytes allow;
* ``hash_column`` given (a column of both sides holding :func:`key_hash` of
  the keys): one full outer join whose only join key is that hash, the key
  equality being a residual filter. A target stored bucketed on the hash
  column is then read bucket by bucket and never shuffled, whatever the
  source size; only the source is shuffled into the target's buckets.

Keys compare NULL-safely by default, which makes applying the same batch
twice equal to applying it once; ``null_safe=False`` reproduces SQL ``=``
matching, under which rows with a NULL key part are inserted again each time.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.names import quoted, unused_names


class DuplicateKeyError(ValueError):
    """The source holds two rows for one key, so a target row would match twice."""


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    (rows,) = unused_names(1, df)
    dup = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(rows)).where(
        F.col(rows) > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"duplicate key {[dup[0][k] for k in keys]} in merge source")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_columns: Sequence[str], *, null_safe: bool = True,
           check_unique: bool = True, hash_column: str | None = None) -> DataFrame:
    """The merged rows. Two source rows of one key raise :class:`DuplicateKeyError`;
    ``check_unique=False`` skips that job for a source known to be deduplicated."""
    cols, update = _checked(target, source, keys, update_columns, check_unique)
    src, mark = unused_names(2, target)
    packed = source.selectExpr(_struct(cols, src))
    if hash_column is not None:
        marked = target.selectExpr("*", f"true AS {mark}")
        cond = _on_hash(marked, packed, src, keys, hash_column, null_safe)
        joined = marked.join(packed, cond, "full_outer")
        return joined.selectExpr(*_after(cols, update | {hash_column}, src, f"{mark} IS NOT NULL"))
    joined = target.join(packed, _on_keys(target, packed, src, keys, null_safe), "left")
    updated = joined.selectExpr(*_after(cols, update, src, "true"))
    known = target.selectExpr(_struct(keys, src))
    inserts = source.join(known, _on_keys(source, known, src, keys, null_safe), "left_anti")
    return updated.unionByName(inserts.select(*[quoted(c) for c in cols]))


def changes(target: DataFrame, source: DataFrame, keys: Sequence[str], update_columns: Sequence[str], *,
            null_safe: bool = True, check_unique: bool = True, hash_column: str | None = None) -> DataFrame:
    """(before, after) of every row that the same :func:`upsert` would change: two
    structs of the target's columns, ``before`` NULL for an inserted row. Only
    the source's rows come out, so what depends on the merge can be kept up to
    date from them. With ``hash_column`` the target is not shuffled."""
    cols, update = _checked(target, source, keys, update_columns, check_unique)
    src, old = unused_names(2, target)
    packed = source.selectExpr(_struct(cols, src))
    cond = (_on_hash(target, packed, src, keys, hash_column, null_safe) if hash_column is not None
            else _on_keys(target, packed, src, keys, null_safe))
    joined = packed.join(target.selectExpr("*", _struct(cols, old)), cond, "left")
    after = _after(cols, update | ({hash_column} if hash_column else set()), src, f"{old} IS NOT NULL")
    return joined.selectExpr(f"{old} AS before", f"struct({', '.join(after)}) AS after")


def _checked(target: DataFrame, source: DataFrame, keys: Sequence[str], update_columns: Sequence[str],
             check_unique: bool) -> tuple[list[str], set[str]]:
    cols = list(target.columns)
    if sorted(source.columns) != sorted(cols):
        raise ValueError(f"source columns {source.columns} differ from target columns {cols}")
    if check_unique:
        assert_unique(source, keys)
    return cols, set(update_columns) | set(keys)


def _on_keys(left: DataFrame, packed: DataFrame, struct: str, keys: Sequence[str], null_safe: bool) -> Column:
    return _all(left[f"`{k}`"].eqNullSafe(packed[struct][k]) if null_safe else left[f"`{k}`"] == packed[struct][k]
                for k in keys)


def _on_hash(target: DataFrame, packed: DataFrame, struct: str, keys: Sequence[str], hash_column: str,
             null_safe: bool) -> Column:
    """Equality of the hashes is the only join key; that of the keys stays a filter."""
    pairs = [(target[f"`{k}`"], packed[struct][k]) for k in keys]
    return (target[f"`{hash_column}`"] == packed[struct][hash_column]) & _all(
        F.coalesce(a == b, (a.isNull() & b.isNull()) if null_safe else F.lit(False)) for a, b in pairs)


def _all(conditions: Iterable[Column]) -> Column:
    return functools.reduce(lambda a, b: a & b, conditions)


def _struct(cols: Sequence[str], name: str) -> str:
    return f"struct({', '.join(quoted(c) for c in cols)}) AS {name}"


def _after(cols: Sequence[str], update: set[str], src: str, in_target: str) -> list[str]:
    """Each column's merged value, from the target's columns and the packed source row."""
    return [
        (f"CASE WHEN {src} IS NOT NULL THEN {src}.{quoted(c)} ELSE {quoted(c)} END AS {quoted(c)}" if c in update
         else f"CASE WHEN {in_target} THEN {quoted(c)} ELSE {src}.{quoted(c)} END AS {quoted(c)}")
        for c in cols
    ]
