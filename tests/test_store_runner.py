"""Layer tables in the catalog, and the audited layer runner."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import MOCK_SCHEMA
from strata import schemas
from strata.operators.star import with_price_bucket
from strata.operators.summaries import category_summary, price_bucket_summary, rollup
from strata.plans import (
    RunParams,
    SilverLayout,
    Source,
    describe_tables,
    ensure_tables,
    latest_checkpoints,
    run_layers,
    silver_layout,
)
from strata.plans.layers import STATE, WRITING
from strata.plans.testdata import StepClock
from strata.sources.splits import LEAST_TASKS, fine_tasks
from strata.sources.store import BATCHES, LOG, TableSpec, TableStore

PRODUCT = ("name string, main_category string, sub_category string, ratings string, no_of_ratings string, "
           "discount_price string, actual_price string, image string, link string")


def _store(spark, root, **tables):
    store = TableStore(spark, root)
    store.ensure(tables)
    return store


ONE = TableSpec(schemas._schema(("id", schemas.L)))


def test_a_snapshot_is_replaced_whole(spark, scratch_dir):
    store = _store(spark, scratch_dir, t=ONE)
    assert store.read("t").count() == 0
    for n in (3, 5, 0, 4):
        frame, rows = store.publish("t", spark.range(n))
        assert rows == n == frame.count() == store.read("t").count()
    assert sorted(d for d in os.listdir(f"{scratch_dir}/t") if not d.startswith(".")) == ["a", "b"]
    assert store.publish("t", store.read("t").where("id > 1"))[1] == 2  # computed from itself


def test_failed_write_keeps_previous_state(spark, scratch_dir):
    store = _store(spark, scratch_dir, t=ONE, b=TableSpec(
        schemas._schema(("id", schemas.L), ("batch_id", schemas.S)), BATCHES, ("batch_id",)))
    store.publish("t", spark.range(3))
    bad = spark.range(10).select(F.when(F.col("id") < 7, F.col("id")).otherwise(
        F.raise_error(F.lit("bad row")).cast("long")).alias("id"))
    good = spark.range(3).select("id", F.lit("x").alias("batch_id"))
    store.replace_batch("b", good, "x", keep_others=True)
    with pytest.raises(Exception, match="bad row"):
        store.publish("t", bad)
    with pytest.raises(Exception, match="bad row"):
        store.replace_batch("b", bad.withColumn("batch_id", F.lit("x")), "x", keep_others=False)
    assert store.read("t").count() == 3 == store.read("b").count()


def test_a_replayed_batch_replaces_its_own_rows(spark, scratch_dir):
    spec = TableSpec(schemas._schema(("id", schemas.L), ("day", schemas.DateType()), ("batch_id", schemas.S)),
                     BATCHES, ("day", "batch_id"))
    store = _store(spark, scratch_dir, b=spec)

    def batch(name, day, n):
        return spark.range(n).select("id", F.lit(day).cast("date").alias("day"), F.lit(name).alias("batch_id"))

    def held():
        return {(str(r.day), r.batch_id): r["count"] for r in store.read("b").groupBy("day", "batch_id").count().collect()}

    odd = "a=b/c d%é'"
    for name, day, n in (("one", "2024-01-01", 5), (odd, "2024-01-01", 2), ("one", "2024-01-01", 5), ("two", "2024-01-02", 3)):
        frame, rows = store.replace_batch("b", batch(name, day, n), name, keep_others=True)
        assert rows == n == frame.count()
    assert held() == {("2024-01-01", "one"): 5, ("2024-01-01", odd): 2, ("2024-01-02", "two"): 3}
    store.replace_batch("b", batch("one", "2024-01-09", 1), "one", keep_others=True)  # replayed on another day
    store.replace_batch("b", batch(odd, "2024-01-01", 0), odd, keep_others=True)  # now without a row
    assert held() == {("2024-01-09", "one"): 1, ("2024-01-02", "two"): 3}
    store.replace_batch("b", batch("three", "2024-01-03", 4), "three", keep_others=False)
    assert held() == {("2024-01-03", "three"): 4} and len(store.partitions("b")) == 1
    with pytest.raises(ValueError):
        store.replace_batch("b", batch("", "2024-01-03", 4), "", keep_others=True)


def test_log_and_schema_enforcement(spark, scratch_dir):
    store = _store(spark, scratch_dir, log=TableSpec(schemas.CHECKPOINTS, LOG))
    df = spark.createDataFrame([("b", "BRONZE", "SUCCESS", 3, None, None, 3)], schemas.CHECKPOINTS)
    assert store.append("log", df) == 1 and store.append("log", df) == 1
    assert store.read("log").count() == 2
    with pytest.raises(ValueError):
        store.append("log", df.drop("status"))


def test_store_needs_a_root(spark):
    with pytest.raises((TypeError, ValueError)):
        TableStore(spark, "")


def _mock_source(spark, mock_df):
    extra = mock_df.select("*", F.lit(None).cast("string").alias("image"),
                           F.lit(None).cast("string").alias("link"))
    return Source("mock.csv", lambda: extra)


def test_runner_end_to_end_and_replay(spark, scratch_dir, mock_df):
    store = TableStore(spark, scratch_dir)
    as_of = dt.datetime(2024, 3, 1, 6, 0, 0)
    src = [_mock_source(spark, mock_df)]
    first = run_layers(store, src, RunParams("r1", as_of, clock=StepClock(as_of)))
    assert first.succeeded, first.checkpoints
    assert [(r[1], r[2], r[3]) for r in first.checkpoints] == [
        ("BRONZE", "SUCCESS", 10), ("SILVER", "SUCCESS", 4), ("GOLD", "SUCCESS", 4)]
    assert first.silver.dead_letter_rows == 5
    fact = store.read("fact_product_metrics", schema=schemas.FACT_PRODUCT_METRICS)
    assert sorted(r["product_key"] for r in fact.collect()) == [1, 2, 3, 4]
    # Replaying the same batch changes nothing in silver (idempotent merge).
    again = run_layers(store, src, RunParams("r1", as_of, clock=StepClock(as_of)))
    assert again.silver.silver_rows == 4 == store.read("silver").count()
    log = store.read("checkpoints", schema=schemas.CHECKPOINTS)
    assert log.count() == 6
    assert latest_checkpoints(log, 2).count() == 2
    assert [r["overall_status"] for r in store.read("run_summaries").collect()] == ["SUCCESS", "SUCCESS"]


def test_replay_in_append_mode_changes_nothing(spark, scratch_dir, mock_df):
    store = TableStore(spark, scratch_dir)
    src = [_mock_source(spark, mock_df)]
    modes = {"bronze_mode": "append", "dead_letter_mode": "append", "keep_raw": True}

    def rows(table):
        return sorted(map(str, store.read(table).collect()))

    for day, batch in ((1, "d1"), (2, "d2"), (3, "d3")):
        run_layers(store, src, RunParams(batch, dt.datetime(2024, 3, day, 6)), **modes)
    before = {t: rows(t) for t in ("bronze", "dead_letter", "silver")}
    assert [len(before[t]) for t in before] == [30, 15, 4]
    again = run_layers(store, src, RunParams("d2", dt.datetime(2024, 3, 2, 6)), **modes)
    assert rows("bronze") == before["bronze"] and rows("dead_letter") == before["dead_letter"]
    assert again.bronze.rows == 10 == again.bronze.bronze.count()
    assert again.silver.dead_letter_rows == 5 == again.silver.dead_letter.count()
    # Batches are partitions of one table: one scan, which reads only those asked for.
    for frame, filtered in ((store.read("bronze"), ""), (store.read("bronze").where("batch_id = 'd3'"), "d3")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Union" not in plan
        filters = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert (f"= {filtered})" in filters) if filtered else not filters


def test_runner_bronze_failure_skips_downstream(spark, scratch_dir, mock_df):
    """A failed first run leaves every table there to read, empty."""
    store = TableStore(spark, scratch_dir, "first_run")
    as_of = dt.datetime(2024, 3, 2, 6, 0, 0)

    def broken():
        raise OSError("source unavailable")

    result = run_layers(store, [Source("gone.csv", broken)], RunParams("r2", as_of, clock=StepClock(as_of)))
    assert [(r[1], r[2], r[3]) for r in result.checkpoints] == [
        ("BRONZE", "FAILED", 0), ("SILVER", "SKIPPED", 0), ("GOLD", "SKIPPED", 0)]
    assert "source unavailable" in result.checkpoints[0][5]
    assert result.overall_status == "PARTIAL FAILURE"
    assert [r[4] for r in result.checkpoints] == [as_of + dt.timedelta(seconds=i) for i in (1, 2, 3)]
    for table, schema in schemas.TABLES.items():
        found = spark.sql(f"SELECT * FROM first_run.{table}")
        assert {f.name for f in schema.fields} <= set(found.columns), table
        assert found.count() == (3 if table == "checkpoints" else 0), table


def test_runner_keep_raw_dead_letter(spark, scratch_dir, mock_df):
    store = TableStore(spark, scratch_dir)
    as_of = dt.datetime(2024, 3, 3, 6, 0, 0)
    result = run_layers(store, [_mock_source(spark, mock_df)], RunParams("r3", as_of), keep_raw=True)
    dead = {r["name"]: r for r in result.silver.dead_letter.collect()}
    assert dead["Linen Apron"]["raw_ratings"] is None and dead["Desk Lamp"]["raw_discount_price"] == "-12"


def test_mock_schema_is_text():
    assert {f.dataType.simpleString() for f in MOCK_SCHEMA.fields} == {"string"}


def test_dead_letter_append(spark, scratch_dir, mock_df):
    store = TableStore(spark, scratch_dir)
    ensure_tables(store)
    assert all(store.exists(t) for t in schemas.TABLES)
    assert store.read("silver", schema=schemas.SILVER).count() == 0
    for batch in ("a1", "a2"):
        as_of = dt.datetime(2024, 4, 1, 6, 0, 0)
        result = run_layers(store, [_mock_source(spark, mock_df)], RunParams(batch, as_of),
                            dead_letter_mode="append")
        assert result.silver.dead_letter_rows == 5
        assert result.silver.dead_letter.count() == 5
    dead = store.read("dead_letter", schema=schemas.DEAD_LETTER)
    assert sorted(r["batch_id"] for r in dead.select("batch_id").distinct().collect()) == ["a1", "a2"]
    assert dead.count() == 10


def test_merge_shuffles_only_the_batch(spark, scratch_dir, mock_df):
    from strata.operators import changes, upsert
    from strata.operators.joins import key_hash

    keys = list(schemas.PRODUCT_KEY)
    spec = SilverLayout(4, 3).spec()
    small = schemas._schema(*[(k, schemas.S) for k in keys], ("v", schemas.D), (schemas.KEY_HASH, schemas.L),
                            (schemas.PART, schemas.IntegerType()))
    store = _store(spark, scratch_dir, silver=TableSpec(small, spec.kind, spec.partition_by, spec.buckets))

    def rows(data):
        df = spark.createDataFrame(data, "name string, main_category string, sub_category string, v double")
        return df.withColumn(schemas.KEY_HASH, key_hash(keys)).withColumn(
            schemas.PART, F.pmod(F.xxhash64("main_category"), F.lit(3)).cast("int"))

    store.replace_parts("silver", rows([(f"n{i}", f"m{i % 7}", None if i % 3 == 0 else "s", float(i)) for i in range(200)]))
    src = rows([("n3", "m3", None, -1.0), ("new", "m3", "s", 9.0)])
    parts = [r[0] for r in src.select(schemas.PART).distinct().collect()]
    target = store.read("silver").where(F.col(schemas.PART).isin(parts))
    merged = upsert(target, src, keys, ["v"], hash_column=schemas.KEY_HASH)
    for frame in (merged, changes(target, src, keys, ["v"], hash_column=schemas.KEY_HASH).hint("merge")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 1, plan  # the batch side only
        assert f"{schemas.PART}#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    pairs = {r.after.name: (r.before and r.before.v, r.after.v) for r in changes(
        target, src, keys, ["v"], hash_column=schemas.KEY_HASH).collect()}
    assert pairs == {"n3": (3.0, -1.0), "new": (None, 9.0)}
    store.replace_parts("silver", merged)
    out = {r["name"]: r["v"] for r in store.read("silver").collect()}
    assert len(out) == 201 and out["n3"] == -1.0 and out["new"] == 9.0 and out["n4"] == 4.0


def _files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_merge_rewrites_only_touched_parts(spark, scratch_dir):
    def product(i, category, price):
        return (f"n{i}", category, "s", "4.0", "7", str(price), "800", None, None)

    store = TableStore(spark, scratch_dir)
    as_of = dt.datetime(2024, 7, 1, 6)
    all_rows = [product(i, f"category {i % 12}", 5) for i in range(120)]
    run_layers(store, [Source("a", lambda: spark.createDataFrame(all_rows, PRODUCT))], RunParams("one", as_of))
    layout = silver_layout(store)
    folder = f"{scratch_dir}/silver/{layout.table}"
    before = _files(folder)
    some = [product(i, "category 3", 6) for i in range(3, 120, 12)] + [product(999, "category 3", 1)]
    run_layers(store, [Source("b", lambda: spark.createDataFrame(some, PRODUCT))], RunParams("two", as_of))
    after = _files(folder)
    part = store.read(layout.table).where("main_category = 'category 3'").select(schemas.PART).first()[0]
    kept = {f: t for f, t in before.items() if f"/_part={part}/" not in f}
    assert kept and len(kept) < len(before) and {f: after.get(f) for f in kept} == kept
    assert not {f for f in before if f"/_part={part}/" in f} & set(after)
    silver = {r.name: r.discount_price for r in store.read("silver").collect()}
    assert len(silver) == 121 and silver["n3"] == 6.0 and silver["n4"] == 5.0 and silver["n999"] == 1.0


def test_job_entry_point(spark, scratch_dir, mock_df, capsys):
    from strata.__main__ import main
    from strata.sources.files import write_csv

    extra = mock_df.select("*", F.lit(None).cast("string").alias("image"),
                           F.lit(None).cast("string").alias("link"))
    write_csv(extra, f"{scratch_dir}/in")
    spark.createDataFrame([("T1", 4.5, 10, 99.0, 120.0, "A1")],
                          "title string, rating_stars double, rating_count long, price_value double, "
                          "list_price double, asin string").createOrReplaceTempView("cli_listings")
    code = main(["--csv", f"{scratch_dir}/in", "--table", "cli_listings", "--store", f"{scratch_dir}/store",
                 "--batch-id", "cli", "--as-of", "2024-05-01T06:00:00", "--database", "cli_lake"])
    out = capsys.readouterr().out
    assert code == 0
    assert '"layer_name": "BRONZE", "status": "SUCCESS", "record_count": 11' in out
    assert '"layer_name": "SILVER", "status": "SUCCESS", "record_count": 4' in out
    # The listing row has no main category, so it is quarantined with the invalid CSV rows.
    assert '{"layer": "dead_letter", "row_count": 6}' in out
    assert spark.table("cli_lake.silver").count() == 4


def test_bronze_append_keeps_history(spark, scratch_dir, mock_df):
    store = TableStore(spark, scratch_dir)
    for day in (1, 2):
        as_of = dt.datetime(2024, 6, day, 6, 0, 0)
        result = run_layers(store, [_mock_source(spark, mock_df)], RunParams(f"d{day}", as_of),
                            bronze_mode="append")
        assert result.succeeded and result.bronze.rows == 10 and result.bronze.bronze.count() == 10
        assert result.silver.silver_rows == 4
    history = store.read("bronze", schema=schemas.BRONZE)
    assert history.count() == 20
    assert sorted(r["batch_id"] for r in history.select("batch_id").distinct().collect()) == ["d1", "d2"]
    run_layers(store, [_mock_source(spark, mock_df)], RunParams("d3", as_of))  # overwrite: only its own
    assert [r[0] for r in store.read("bronze").select("batch_id").distinct().collect()] == ["d3"]


@pytest.mark.parametrize("database", [None, "moved"])
def test_later_session_merges_into_silver(spark, scratch_dir, mock_df, database):
    """What a later process finds under the same root, its catalog knowing the
    tables or (under another name) not: silver to merge into, and the whole log."""
    as_of = dt.datetime(2024, 7, 1, 6, 0, 0)
    run_layers(TableStore(spark, scratch_dir), [_mock_source(spark, mock_df)], RunParams("one", as_of),
               silver_buckets=3, silver_parts=2, bronze_mode="append")
    later = spark.newSession()
    more = later.createDataFrame([("Tea Towel", "Kitchen", "Textiles", "4.0", "7", "5", "8", None, None)], PRODUCT)
    store = TableStore(later, scratch_dir, database)
    ensure_tables(store)
    assert silver_layout(store) == SilverLayout(3, 2)
    assert store.read("silver").count() == 4 == store.read("fact_product_metrics").count()
    second = run_layers(store, [Source("more.csv", lambda: more)], RunParams("two", as_of), bronze_mode="append")
    assert second.succeeded, second.checkpoints
    assert second.silver.silver_rows == 5 == store.read("silver").count()
    assert store.read("checkpoints").count() == 6 and store.read("bronze").count() == 11
    if database:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_quarantine_history_keeps_raw_columns(spark, scratch_dir, mock_df):
    store = TableStore(spark, scratch_dir)
    as_of = dt.datetime(2024, 7, 2, 6, 0, 0)
    for batch, raw in (("plain", False), ("raw", True)):
        run_layers(store, [_mock_source(spark, mock_df)], RunParams(batch, as_of), keep_raw=raw,
                   dead_letter_mode="append")
    dead = store.read("dead_letter", schema=schemas.DEAD_LETTER_RAW)
    got = {(r["batch_id"], r["raw_discount_price"]) for r in dead.where("name = 'Desk Lamp'").collect()}
    assert got == {("plain", None), ("raw", "-12")}


def test_layout_can_change(spark, scratch_dir, mock_df):
    store = TableStore(spark, scratch_dir)
    as_of = dt.datetime(2024, 7, 3, 6, 0, 0)
    for n, parts in ((4, 2), (16, 2), (16, 5)):
        result = run_layers(store, [_mock_source(spark, mock_df)], RunParams(f"b{n}", as_of), silver_buckets=n,
                            silver_parts=parts)
        assert result.succeeded and result.silver.silver_rows == 4, result.checkpoints
        assert silver_layout(store) == SilverLayout(n, parts)
        assert store.read("silver", schema=schemas.SILVER).count() == 4
    assert not _files(f"{scratch_dir}/silver/silver_b4_p2") or spark.read.parquet(f"{scratch_dir}/silver/silver_b4_p2").isEmpty()


def test_failure_text_is_whole(spark, scratch_dir):
    def broken():
        raise OSError("x" * 9000)

    as_of = dt.datetime(2024, 7, 4, 6, 0, 0)
    run_layers(TableStore(spark, scratch_dir), [Source("s", broken)], RunParams("long", as_of))
    log = TableStore(spark, scratch_dir).read("checkpoints", schema=schemas.CHECKPOINTS)
    assert max(len(r["error_message"] or "") for r in log.collect()) > 9000


def test_layer_tables_by_catalog_name(spark, scratch_dir, mock_df):
    store = TableStore(spark, f"{scratch_dir}/store", "lake")
    as_of = dt.datetime(2024, 8, 1, 6, 0, 0)
    for batch, raw in (("plain", False), ("raw", True)):
        run_layers(store, [_mock_source(spark, mock_df)], RunParams(batch, as_of), keep_raw=raw,
                   dead_letter_mode="append", bronze_mode="append")
    assert spark.table("lake.silver").columns == schemas.SILVER.fieldNames()
    assert spark.sql("SELECT * FROM lake.silver").count() == 4
    # The history tables hold every batch; columns that only later ones have are NULL before.
    assert spark.table("lake.bronze").count() == 20
    assert spark.table("lake.bronze").schema["ingestion_date"].dataType == schemas.BRONZE["ingestion_date"].dataType
    assert spark.table("lake.checkpoints").count() == 6
    dead = spark.sql("SELECT batch_id, raw_discount_price FROM lake.dead_letter WHERE name = 'Desk Lamp'")
    assert {tuple(r) for r in dead.collect()} == {("plain", None), ("raw", "-12")}


def _plain_profile(store):
    out = {}
    for table, schema in schemas.TABLES.items():
        df = store.read(table, schema=schema)
        counts = df.agg(F.count(F.lit(1)), *[F.count_if(F.col(f.name).isNull()) for f in schema.fields]).first()
        for i, f in enumerate(schema.fields):
            out[table, i + 1, f.name, f.dataType.simpleString()] = (counts[0], counts[i + 1])
    return out


def _messy(spark, seed, n):
    r = random.Random(seed)
    rows = [(r.choice(["a", "b", "c", None]) or None, r.choice(["x", "Y", "z", " "]), r.choice(["s", None, "t"]),
             r.choice(["4", "1.5", "bad"]), str(r.randint(0, 9)), r.choice(["10", "9.99", "NaN", "-1", "1e300"]),
             r.choice(["100", "777.77", "3000", "0", "20000"]), r.choice([None, "img"]), None) for _ in range(n)]
    return Source("messy.csv", lambda: spark.createDataFrame(rows, PRODUCT))


@pytest.mark.parametrize("share", [1e9, 0.25])
def test_metrics_and_summaries_are_kept_by_change(spark, scratch_dir, share):
    """After updates, inserts and an unfinished merge: every table's counts as the
    tables have them, and the summaries as a full aggregate gives them."""
    store = TableStore(spark, scratch_dir)
    finite = [Source("m", lambda k=k: _messy(spark, k, 25).load().where("discount_price not in ('NaN', '1e300')"))
              for k in range(5)]
    plans = [finite[0], finite[1], _messy(spark, 9, 60), finite[2], finite[3], finite[4]]
    for k, source in enumerate(plans):
        if k == 4:  # as if the run before had died in its merge
            store.set_properties(silver_layout(store).table, **{STATE: WRITING})
        result = run_layers(store, [source], RunParams(f"b{k}", dt.datetime(2024, 9, 1 + k, 6)),
                            dead_letter_mode="append", bronze_mode="append" if k % 2 else "overwrite",
                            by_change_share=share)
        assert result.succeeded, result.checkpoints
        got = {(r.layer, r.ordinal, r.column_name, r.data_type): (r.row_count, r.null_count)
               for r in describe_tables(store).collect()}
        assert got == _plain_profile(store), k
        bucketed = with_price_bucket(store.read("silver"))
        assert result.silver.silver_rows == bucketed.count()
        for table, want in (("agg_category_summary", category_summary(bucketed)),
                            ("agg_price_bucket_summary", price_bucket_summary(bucketed))):
            assert sorted(map(str, store.read(table).collect())) == sorted(map(str, want.select(
                *store.read(table).columns).collect())), (k, table)
        full = rollup(bucketed)
        assert store.read("gold_rollup").exceptAll(full).isEmpty() and full.exceptAll(store.read("gold_rollup")).isEmpty()
        state = store.properties(silver_layout(store).table)[STATE]
        assert store.properties("gold_rollup")[STATE] == state
    plan = describe_tables(store)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "layer_metrics" in plan


def test_layers_are_built_by_several_tasks_a_core(spark, scratch_dir):
    """One task a core and one more would leave all cores waiting for that one."""
    spark.range(400_000).selectExpr(
        "concat('n', id) AS name", "'m' AS main_category", "'s' AS sub_category", "'1' AS ratings",
        "string(id) AS no_of_ratings", "'1' AS discount_price", "'2' AS actual_price", "sha2(string(id), 256) AS image",
        "sha2(string(-id), 256) AS link").repartition(40).write.parquet(f"{scratch_dir}/in")
    spark.conf.set("spark.sql.files.openCostInBytes", "64k")
    try:
        store = TableStore(spark, f"{scratch_dir}/store")
        done = run_layers(store, [Source("s", lambda: spark.read.parquet(f"{scratch_dir}/in"))],
                          RunParams("b", dt.datetime(2024, 1, 1)))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert done.succeeded and done.gold.fact_rows == 400_000
    files = {r.f for r in store.read("bronze").selectExpr("input_file_name() AS f").distinct().collect()}
    assert len(files) >= 2 * spark.sparkContext.defaultParallelism


def test_fine_tasks_leaves_the_session_as_it_was(spark):
    files, shuffles = LEAST_TASKS
    spark.conf.set(files, "3")
    try:
        with pytest.raises(KeyError), fine_tasks(spark, 2):
            assert spark.conf.get(files) == "3"
            assert int(spark.conf.get(shuffles)) == 2 * spark.sparkContext.defaultParallelism
            raise KeyError
        assert spark.conf.get(files) == "3" and spark.conf.get(shuffles, None) is None
    finally:
        spark.conf.unset(files)
