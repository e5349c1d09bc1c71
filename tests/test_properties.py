"""Property checks against small brute-force models (hypothesis)."""

from __future__ import annotations

import pytest

hypothesis = pytest.importorskip("hypothesis")
from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from strata.operators import dedup_by_key, dense_key, upsert  # noqa: E402

SCHEMA = "name string, main_category string, sub_category string, price double, tag string"
KEYS = ["name", "main_category", "sub_category"]
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

key_part = st.sampled_from([None, "a", "b"])
row = st.tuples(key_part, key_part, key_part, st.integers(0, 5).map(float), st.sampled_from(["x", "y"]))


def _unique(rows):
    seen, out = set(), []
    for r in rows:
        if r[:3] not in seen:
            seen.add(r[:3])
            out.append(r)
    return out


def _model_merge(target, source):
    """MERGE with NULL-safe keys: price is updated, tag kept, new keys inserted."""
    out = {r[:3]: r for r in target}
    for r in source:
        k = r[:3]
        out[k] = (*k, r[3], out[k][4]) if k in out else r
    return sorted(out.values(), key=repr)


@SETTINGS
@given(st.lists(row, max_size=12), st.lists(row, max_size=12))
def test_upsert_matches_model(spark, target_rows, source_rows):
    target, source = _unique(target_rows), _unique(source_rows)
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA)
    got = upsert(t, s, KEYS, ["price"])
    got_rows = sorted(map(tuple, got.collect()), key=repr)
    assert got_rows == _model_merge(target, source)
    again = sorted(map(tuple, upsert(got, s, KEYS, ["price"]).collect()), key=repr)
    assert again == got_rows


@SETTINGS
@given(st.lists(row, min_size=1, max_size=25))
def test_dedup_keeps_first_in_order(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r)[:3]: tuple(r) for r in dedup_by_key(df, KEYS, [("price", "desc")]).collect()}
    expected = {}
    for r in rows:
        k = r[:3]
        best = expected.get(k)
        # price descending, then tag ascending (the remaining column)
        if best is None or (-r[3], r[4]) < (-best[3], best[4]):
            expected[k] = r
    assert got == expected


def _sort_key(r):
    return tuple((0, "") if v is None else (1, v) for v in r[:3])


@SETTINGS
@given(st.lists(row, max_size=40), st.integers(1, 6))
def test_dense_key_is_a_sorted_numbering(spark, rows, parts):
    df = spark.createDataFrame(rows, SCHEMA)
    got = dense_key(df, KEYS, "k", num_partitions=parts).collect()
    assert sorted(r["k"] for r in got) == list(range(1, len(rows) + 1))
    by_key = [_sort_key(tuple(r)) for r in sorted(got, key=lambda r: r["k"])]
    assert by_key == sorted(by_key)


@SETTINGS
@given(st.lists(st.tuples(key_part, key_part, st.integers(0, 99)), max_size=40),
       st.lists(st.tuples(key_part, key_part, st.integers(100, 199)), max_size=6),
       st.booleans(), st.integers(1, 5))
def test_salted_dimension_join_matches_model(spark, fact_rows, dim_rows, null_safe, rows_per_task):
    from strata.operators import left_join_dim

    dim_rows = [r for i, r in enumerate(dim_rows) if r[:2] not in {d[:2] for d in dim_rows[:i]}]
    fact = spark.createDataFrame(fact_rows, "a string, b string, id long")
    dim = spark.createDataFrame(dim_rows, "a string, b string, v long")
    got = left_join_dim(fact, dim, ["a", "b"], null_safe=null_safe,
                        rows_per_task=rows_per_task)
    lookup = {}
    for a, b, v in dim_rows:
        if null_safe or (a is not None and b is not None):
            lookup[(a, b)] = v
    expected = sorted(((a, b, i, lookup.get((a, b))) for a, b, i in fact_rows), key=repr)
    assert sorted(((r["a"], r["b"], r["id"], r["v"]) for r in got.collect()), key=repr) == expected
