from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from conftest import plan_of
from fixtures import source_tables
from starloom.operators.load import (
    REJECTS,
    accepted,
    apply_defaults,
    compare_schemas,
    infer_target_schema,
    load_with_rejects,
    reject_sample,
    rejected,
    schema_diff,
    upsert,
)
from starloom.plans.build import build_all
from starloom.plans.run import load_all, load_many, load_table, recover, replay, run, run_from
from starloom.plans.spec import LOAD_TIME, MappingSet, TargetMapping
from starloom.plans.targets import TARGETS
from starloom.sinks.store import Target, clustered, write_clustered
from starloom.operators.report import run_metrics
from starloom.operators.state import changed_since, current_watermarks, database_marks, forget_job, job_summary, read_events, replay_due
from starloom.functions.window import IncrementalWindow

ITEM = TargetMapping(
    name="dim_item",
    sources=("item",),
    key=("item_id",),
    columns={"item_id": "item.id", "name": "item.name", "is_new": "item.is_new", "created_at": "item.created_at"},
    required=("name",),
    defaults={"is_new": False},
    cluster_by=("name",),
)
ITEMS = MappingSet([ITEM])


def items(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id string, name string, is_new string, created_at bigint")


GOOD = ("1", "a", "1", 1700000000123)


# Rejects


def test_rejects_and_good_rows_make_the_input(spark):
    df = items(spark, GOOD, ("x", "b", None, None), ("3", None, "no", 5), (None, "d", "0", 253402300799001))
    checked = load_with_rejects(df, ITEM.schema, required=("item_id", "name"))
    reasons = {tuple(r[REJECTS]) for r in rejected(checked).collect()}
    assert reasons == {
        ("item_id: not bigint", "item_id: NULL"),
        ("name: NULL", "is_new: not boolean", "created_at: not timestamp"),
        ("item_id: NULL",),
    }
    assert accepted(checked).collect()[0].asDict() == {
        "item_id": 1, "name": "a", "is_new": True, "created_at": datetime(2023, 11, 14, 22, 13, 20, 123000), LOAD_TIME: None,
    }
    assert accepted(checked).count() + rejected(checked).count() == df.count()
    assert reject_sample(checked).count() == 3 and reject_sample(checked, 2).count() == 2
    assert "Exchange" not in plan_of(checked)


def test_columns_by_name_in_any_case(spark):
    df = spark.createDataFrame([("b", 7, "x")], "NAME string, Item_ID int, other string")
    row = accepted(load_with_rejects(df, ITEM.schema)).first()
    assert (row["item_id"], row["name"], row["is_new"]) == (7, "b", None)


def test_lengths_only_when_asked(spark):
    df = items(spark, ("1", "n" * 256, None, None))
    assert rejected(load_with_rejects(df, ITEM.schema)).isEmpty()
    assert rejected(load_with_rejects(df, ITEM.schema, lengths=True)).first()[REJECTS] == ["name: longer than 255"]


def test_defaults_fill_absent_columns_only(spark):
    df = spark.createDataFrame([(1, None)], "id int, a string")
    assert apply_defaults(df, {"a": "x", "b": 0}).first().asDict() == {"id": 1, "a": None, "b": 0}


# Upsert


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (None, "n", "z")], "k int, v string, w string")
    new = spark.createDataFrame([(2, None, 1), (2, "B", 2), (3, "c", 1), (None, "m", 1), (None, "m", 1)], "k int, v string, n int")
    got = upsert(old, new, ["k"], ["n"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, "a", "x"), (2, "B", None), (3, "c", None), (None, "n", "z"), (None, "m", None), (None, "m", None)], key=repr
    )


def test_upsert_twice_changes_nothing(spark):
    old = spark.range(20).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    new = spark.range(10, 30).select(F.col("id").alias("k"), F.lit(1).alias("v"), F.col("id").alias("n"))
    once = upsert(old, new, ["k"], ["n"])
    assert sorted(upsert(once, new, ["k"], ["n"]).collect()) == sorted(once.collect())
    assert once.count() == 30


def test_composite_key_with_null_part_never_collides(spark):
    old = spark.createDataFrame([(1, None, "a")], "k int, j int, v string")
    new = spark.createDataFrame([(1, None, "b", 1)], "k int, j int, v string, n int")
    assert upsert(old, new, ["k", "j"], ["n"]).count() == 2


# Schemas


def test_infer(spark):
    schema = "n int, f float, b boolean, s string, created_at bigint, timestamp string, x_json string, d decimal(10,2), t timestamp"
    types = {f.name: f.dataType.simpleString() for f in infer_target_schema(spark.createDataFrame([], schema))}
    assert types == {
        "n": "bigint", "f": "double", "b": "boolean", "s": "string", "created_at": "timestamp", "timestamp": "timestamp",
        "x_json": "variant", "d": "double", "t": "timestamp", LOAD_TIME: "timestamp",
    }


def test_compare_schemas(spark):
    expected = T.StructType.fromDDL("a bigint, b boolean, c variant, d string, e timestamp, z int")
    actual = T.StructType.fromDDL("A decimal(38,0), b int, c string, d varchar(5), f int, z bigint")
    got = {row[0]: row[1] for row in compare_schemas(expected, actual)}
    assert got == {"a": "ok", "b": "mismatch", "c": "mismatch", "d": "ok", "e": "missing", "f": "extra", "z": "ok"}
    assert schema_diff(spark, expected, actual).filter("status = 'mismatch'").count() == 2


# Store


def test_append_is_by_name(spark, store):
    store.ensure_target(ITEM)
    assert not store.ensure_target(ITEM)
    store.append("dim_item", spark.createDataFrame([("a", 1, 5)], "name string, ITEM_ID int, extra int"))
    row = store.read("dim_item").first()
    assert (row["item_id"], row["name"], row["is_new"]) == (1, "a", None)


def test_insert_by_sql_gets_the_defaults(spark, store):
    store.ensure_target(ITEM)
    spark.sql(f"INSERT INTO {store.name('dim_item')} (item_id, name) VALUES (1, 'a')")
    row = store.read("dim_item").first()
    assert row["is_new"] is False and row[LOAD_TIME] is not None


def test_upsert_moves_to_a_new_version(spark, store):
    store.ensure_target(ITEM)
    frame = lambda *rows: spark.createDataFrame(list(rows), "item_id bigint, name string, seq int")
    store.upsert("dim_item", frame((1, "a", 1), (2, "b", 1)), ["item_id"], ["seq"], cluster_by=["name"])
    reader = store.read("dim_item")
    store.upsert("dim_item", frame((2, "B", 1), (2, "C", 2), (3, "d", 1)), ["item_id"], ["seq"])
    assert sorted((r["item_id"], r["name"]) for r in store.read("dim_item").collect()) == [(1, "a"), (2, "C"), (3, "d")]
    assert reader.count() == 2  # the version before is still there for those who read it
    store.upsert("dim_item", frame((4, "e", 1)), ["item_id"], ["seq"])
    assert store.drop_old_versions("dim_item", keep=1) >= 2
    assert store.read("dim_item").count() == 4


def test_evolve_adds_columns(spark, store):
    store.ensure_table("t", T.StructType.fromDDL("a bigint"))
    store.append("t", spark.range(2).withColumnRenamed("id", "a"))
    assert store.evolve("t", T.StructType.fromDDL("a bigint, is_on boolean, s string")) == ["is_on", "s"]
    store.append("t", spark.createDataFrame([(5, True, "x")], "a bigint, is_on boolean, s string"))
    rows = {r["a"]: (r["is_on"], r["s"]) for r in store.read("t").collect()}
    assert rows[5] == (True, "x") and rows[0][1] is None


def test_evolve_with_another_type(spark, store):
    def fresh():
        store.drop("t")
        store.ensure_table("t", T.StructType.fromDDL("a bigint, is_on bigint"))
        store.append("t", spark.createDataFrame([(1, 1), (2, 0), (3, 9)], "a bigint, is_on bigint"))

    wanted = T.StructType.fromDDL("a bigint, is_on boolean")
    fresh()
    with pytest.raises(ValueError):
        store.evolve("t", wanted, on_mismatch="fail")
    store.evolve("t", wanted)
    assert {r["a"]: r["is_on"] for r in store.read("t").collect()} == {1: True, 2: False, 3: None}
    fresh()
    store.evolve("t", wanted, on_mismatch="recreate")
    assert store.read("t").isEmpty() and store.read("t").schema["is_on"].dataType == T.BooleanType()


def test_clear(spark, store):
    store.ensure_table("t", T.StructType.fromDDL("a bigint"))
    store.append("t", spark.range(7).withColumnRenamed("id", "a"))
    assert [tuple(r) for r in store.clear().collect()] == [("t", 7, 0)]
    assert store.read("t").columns == ["a"]
    store.append("t", spark.range(2).withColumnRenamed("id", "a"))
    assert store.read("t").count() == 2


def test_clustered_layout_splits_a_hot_value(spark, tmp_path):
    df = spark.range(0, 40_000, 1, 4).select(F.lit(1).alias("tenant_id"), F.col("id"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert clustered(df, ["tenant_id"], tie=["id"]).select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    write_clustered(df, ["tenant_id"], str(tmp_path / "c"), tie=["id"])
    assert spark.read.parquet(str(tmp_path / "c")).count() == 40_000


def test_target_by_format(spark, tmp_path):
    target = Target("parquet", {"path": str(tmp_path), "password": "secret"})
    target.write(spark.range(3), "t")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3 and "secret" not in repr(target)


# Runs


def test_load_counts_rejects_and_skips_empty(spark, store, tmp_path):
    df = items(spark, GOOD, ("x", "b", None, None))
    row = load_table(store, "dim_item", df, ITEMS, rejects_path=str(tmp_path / "rejects"))
    assert row == ("dim_item", "loaded", 2, 1, 1, None)
    assert spark.read.parquet(str(tmp_path / "rejects/dim_item")).count() == 1
    assert load_table(store, "nothing", spark.range(0), ITEMS) == ("nothing", "skipped", 0, 0, 0, None)
    assert store.tables() == ["dim_item"]


def test_load_time_and_defaults(spark, store):
    df = spark.createDataFrame([("1", "a")], "item_id string, name string")
    load_table(store, "dim_item", df, ITEMS)
    load_table(store, "dim_item", df, ITEMS, fill_defaults=True)
    rows = store.read("dim_item").collect()
    assert sorted(r["is_new"] is None for r in rows) == [False, True] and all(r[LOAD_TIME] for r in rows)


def test_clustered_load(spark, store):
    rows = [(str(i), f"n{i % 7}", None, None) for i in range(60)]
    assert load_table(store, "dim_item", items(spark, *rows), ITEMS, cluster=True)[1:5] == ("loaded", 60, 60, 0)
    assert load_table(store, "dim_item", items(spark, *rows), ITEMS, mode="upsert", order_by=["name"], cluster=True)[2] == 60
    assert store.read("dim_item").count() == 60


def test_equal_keys_of_two_databases(spark, store):
    """The union keeps both, the bare key lets one replace the other, the database in the key keeps both."""
    frame = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "_database string, item_id bigint, name string")
    assert load_table(store, "dim_item", frame, ITEMS)[3] == 2 and store.read("dim_item").count() == 2
    store.drop("dim_item")
    load_table(store, "dim_item", frame, ITEMS, mode="upsert", order_by=["name"])
    assert [r["name"] for r in store.read("dim_item").collect()] == ["y"]
    store.drop("dim_item")
    load_table(store, "dim_item", frame, ITEMS, mode="upsert", order_by=["name"], per_database=True)
    assert store.read("dim_item").count() == 2


def test_load_by_upsert(spark, store):
    load_table(store, "dim_item", items(spark, GOOD), ITEMS, mode="upsert", order_by=["created_at"])
    row = load_table(store, "dim_item", items(spark, ("1", "A", "0", 1700000000999), ("2", "b", "0", None)), ITEMS, mode="upsert", order_by=["created_at"])
    assert row == ("dim_item", "loaded", 2, 2, 0, None)
    assert {r["item_id"]: r["name"] for r in store.read("dim_item").collect()} == {1: "A", 2: "b"}


def failing(spark):
    return spark.range(3).select(F.col("id").alias("item_id"), F.raise_error(F.lit("broken row")).cast("string").alias("name"))


@pytest.mark.parametrize(
    "strategy, statuses, success",
    [
        ("bulk", ["loaded", "failed", "skipped", "loaded"], True),
        ("continue_on_error", ["loaded", "failed", "skipped", "loaded"], True),
        ("all_or_nothing", ["loaded", "failed", "skipped", "loaded"], False),
        ("fail_fast", ["loaded", "failed"], False),
    ],
)
def test_strategies(spark, store, strategy, statuses, success):
    targets = {"dim_item": items(spark, GOOD), "bad": failing(spark), "empty": spark.range(0), "more": spark.range(4)}
    result = load_all(store, targets, strategy, ITEMS)
    assert [row[1] for row in result.rows] == statuses and result.success is success
    assert "broken row" in result.rows[1][5]
    assert result.report(spark).count() == len(statuses)


def test_parallel_loads_report_in_order(spark, store):
    targets = {f"t{i}": spark.range(i) for i in range(6)} | {"bad": failing(spark)}
    result = load_all(store, targets, "continue_on_error", None, parallel=4)
    assert [row[0] for row in result.rows] == list(targets)
    assert [row[3] for row in result.rows] == [0, 1, 2, 3, 4, 5, 0] and result.names("failed") == ["bad"]


def test_continue_on_error_needs_one_loaded_table(spark, store):
    assert not load_all(store, {"bad": failing(spark)}, "continue_on_error", ITEMS).success
    with pytest.raises(ValueError):
        load_all(store, {}, "sometimes")


def test_recover_loads_the_rest(spark, store):
    store.ensure_table("DIM_a", T.StructType.fromDDL("a bigint"))
    targets = {"dim_A": spark.range(1), "dim_b": spark.range(2), "Dim_C": spark.range(3)}
    result = recover(store, targets, skip=["DIM_c"])
    assert result.names("loaded") == ["dim_b"] and result.success
    assert recover(store, targets, skip=["dim_c"]).success and store.tables() == ["dim_a", "dim_b"]


def test_recover_takes_tables_whose_load_failed(spark, store):
    failed = load_all(store, {"a": spark.range(2), "b": failing(spark)}, "continue_on_error")
    assert failed.names("failed") == ["b"] and store.tables() == ["a"]
    assert recover(store, {"a": spark.range(9), "b": spark.range(3)}).names("loaded") == ["b"]
    assert store.read("a").count() == 2 and store.read("b").count() == 3


def test_undeclared_table_with_json_and_nested_values(spark, store):
    df = spark.createDataFrame([(1, '{"a":[1]}', (2,), 1_700_000_000_000), (2, "{", None, None)], "id int, x_json string, s struct<n:int>, seen_at bigint")
    assert load_table(store, "extra", df)[1:5] == ("loaded", 2, 1, 1)
    row = store.read("extra").selectExpr("id", "variant_get(x_json, '$.a[0]', 'int') AS a", "s", "year(seen_at) AS y").first()
    assert tuple(row) == (1, 1, '{"n":2}', 2023)


def test_append_to_a_partitioned_table(spark, store):
    df = spark.range(100).select(F.col("id").alias("item_id"), F.col("id").cast("string").alias("name"), F.concat(F.lit("t"), F.col("id") % 3).alias("_database"))
    assert load_table(store, "dim_item", df, ITEMS, per_database=True)[2] == 100
    load_table(store, "dim_item", df, ITEMS, per_database=True)
    assert store.read("dim_item").count() == 200 and len(store.read("dim_item").inputFiles()) <= 6


def test_load_many(spark, store):
    results = load_many(store, {"one": {"a": spark.range(1)}, "two": {"b": failing(spark)}}, "continue_on_error")
    assert results["one"].success and not results["two"].success


def test_run_end_to_end(spark, store, tmp_path):
    state = str(tmp_path / "state")
    sources = source_tables(spark, rows=3)
    result = run(spark, sources, store, state_path=state, job_id="job-1", at=datetime(2024, 6, 1))
    assert len(result.names("loaded")) == 25 and result.success
    assert result.total_records == sum(store.read(t).count() for t in store.tables())
    summary = job_summary(read_events(spark, f"{state}/job_events")).first()
    assert (summary["status"], summary["loaded_tables"], summary["should_resume"]) == ("completed", 25, False)
    marks = current_watermarks(spark.read.parquet(f"{state}/watermarks"))
    assert marks.filter("table = 'users'").first()["value"] == datetime(2023, 11, 14, 22, 13, 20, 2000)
    outcome = run_metrics(spark.read.parquet(f"{state}/run_metrics")).first()
    assert (outcome["outcome"], outcome["loading_records"]) == ("success", result.total_records)
    assert forget_job(spark, f"{state}/job_events", "job-1") and not forget_job(spark, f"{state}/job_events", "job-1")


def test_incremental_runs_take_what_changed(spark, store, tmp_path):
    state = str(tmp_path / "state")
    rows = lambda *r: {"project": spark.createDataFrame(list(r), "id bigint, name string, tenant_tsid bigint, updated_at_epoch bigint")}
    go = lambda tables: run(spark, tables, store, state_path=state, incremental=True, mode="upsert", load_options={"order_by": ["name"]})
    start = 1_700_000_000_000
    assert go(rows((1, "a", 1, start), (2, "b", 1, start + 5))).total_records == 2
    # The row at the mark is due again, the one before it is not; its change went unmarked.
    assert go(rows((1, "A", 1, start), (2, "b", 1, start + 5), (3, "c", 1, start + 9))).total_records == 2
    assert {r["project_id"]: r["name"] for r in store.read("dim_projects").collect()} == {1: "a", 2: "b", 3: "c"}
    assert current_watermarks(spark.read.parquet(f"{state}/watermarks")).count() == 1


def test_a_failed_load_keeps_the_mark_and_asks_for_replay(spark, store, tmp_path):
    state = str(tmp_path / "state")
    bad = spark.range(2).select("id", F.raise_error(F.lit("broken")).cast("string").alias("name"), F.lit(1).alias("tenant_tsid"), F.lit(1_700_000_000_000).alias("updated_at_epoch"))
    result = run(spark, {"project": bad}, store, state_path=state, strategy="all_or_nothing", job_id="j")
    assert not result.success
    events = read_events(spark, f"{state}/job_events")
    assert [r["job_id"] for r in replay_due(events).collect()] == ["j"]
    assert not (tmp_path / "state" / "watermarks").exists()
    assert run_metrics(spark.read.parquet(f"{state}/run_metrics")).first()["failed_phase"] == "loading"


PROJECT = "id bigint, name string, tenant_tsid bigint, updated_at_epoch bigint"


def test_no_mark_is_committed_for_a_failed_source_or_a_window(spark, store, tmp_path):
    """Also under the strategy that counts a run with failures as a success."""
    state = str(tmp_path / "state")
    bad = spark.range(2).select("id", F.raise_error(F.lit("broken")).cast("string").alias("name"), F.lit(1).alias("tenant_tsid"), F.lit(1_700_000_000_000).alias("updated_at_epoch"))
    assert run(spark, {"project": bad}, store, state_path=state, incremental=True, mode="upsert").success
    good = {"project": spark.createDataFrame([(1, "a", 1, 1_700_000_000_000)], PROJECT)}
    run(spark, good, store, state_path=state, window=IncrementalWindow.between("2023-11-01"), mode="upsert")
    folder = tmp_path / "state" / "watermarks"
    assert not folder.exists() or spark.read.parquet(str(folder)).isEmpty()
    run(spark, good, store, state_path=state, incremental=True, mode="upsert")
    assert current_watermarks(spark.read.parquet(str(folder))).count() == 1


def test_incremental_runs_must_upsert(spark, store):
    with pytest.raises(ValueError, match="upsert"):
        run(spark, {}, store, incremental=True)


def test_rejects_are_kept_by_default_and_errors_whole(spark, store, tmp_path):
    df = spark.createDataFrame([(1, "x" * 3000), (2, "ok")], "project_id bigint, name string")
    result = load_all(store, {"dim_projects": df})
    rejects = result.rows[0][4]
    assert rejects and spark.read.parquet(f"{store.root}/_rejects/dim_projects").count() == rejects
    spark.range(3).write.parquet(str(tmp_path / "broken"))
    broken = spark.read.parquet(str(tmp_path / "broken"))
    for part in (tmp_path / "broken").glob("part-*"):
        part.write_bytes(b"no parquet")
    result = load_all(store, {"dim_x": broken, "dim_y": spark.range(2)}, "continue_on_error")
    assert (result.names("failed"), result.names("loaded")) == (["dim_x"], ["dim_y"])


@pytest.mark.parametrize("whole, found", [(True, {20}), (False, {None})])
def test_lookups_in_a_window(spark, store, whole, found):
    """The account did not change in the window: it is found only if lookups are read whole."""
    old, new = 1704844799999, 1704844800000
    tables = {
        "users": spark.createDataFrame([(1, 1, new), (2, 2, old)], "id bigint, user_id bigint, updated_at_epoch bigint"),
        "user_accounts": spark.createDataFrame([(20, 1, old, 0)], "id bigint, user_id bigint, updated_at_epoch bigint, _pos int"),
    }
    run(spark, tables, store, window=IncrementalWindow.resolve("2024-01-10", "new"), whole_lookups=whole)
    assert {r["user_account_id"] for r in store.read("dim_users").collect()} == found


def test_window_limits_a_run(spark, store):
    rows = spark.createDataFrame([(1, 1, 1704844800000), (2, 1, 1704844799999)], "id bigint, tenant_tsid bigint, updated_at_epoch bigint")
    assert run(spark, {"project": rows}, store, window=IncrementalWindow.resolve("2024-01-10", "new")).total_records == 1


def test_run_from_stored_targets(spark, store):
    targets = build_all(TARGETS, {"project": source_tables(spark)["project"]})
    assert run_from(spark, targets, store).names("loaded") == ["dim_projects"]
    assert run_from(spark, {"project": source_tables(spark)["project"]}, store).names("loaded") == ["dim_projects"]
    assert store.read("dim_projects").count() == 20


# Scale


def test_upsert_rewrites_only_partitions_with_changes(spark, store, tmp_path):
    rows = [("tenant_a", 1, "a", 1), ("tenant_b", 1, "b", 1), ("tenant_c", 1, "c", 1)]
    frame = lambda *r: spark.createDataFrame(list(r), "_database string, item_id bigint, name string, updated_at int")
    first = load_table(store, "dim_item", frame(*rows), ITEMS, mode="upsert", per_database=True, order_by=["item_id"])
    assert first[1:5] == ("loaded", 3, 3, 0)
    assert store.partition_columns("dim_item") == ["_database"]

    def files():
        return {r["f"].split("_database=")[1] for r in store.read("dim_item").select(F.input_file_name().alias("f")).collect()}

    before = files()
    load_table(store, "dim_item", frame(("tenant_b", 1, "B", 2), ("tenant_b", 2, "n", 2)), ITEMS, mode="upsert", per_database=True, order_by=["item_id"])
    assert sorted((r["_database"], r["item_id"], r["name"]) for r in store.read("dim_item").collect()) == [
        ("tenant_a", 1, "a"), ("tenant_b", 1, "B"), ("tenant_b", 2, "n"), ("tenant_c", 1, "c")]
    kept = {f for f in before if not f.startswith("tenant_b")}
    assert kept <= files() and len(kept) == 2


def test_upsert_of_a_partitioned_table_by_another_key(spark, store):
    store.ensure_table("t", T.StructType.fromDDL("k bigint, v string, p string"), partition_by=["p"])
    frame = lambda *r: spark.createDataFrame(list(r), "k bigint, v string, p string, n int")
    store.upsert("t", frame((1, "a", "x", 1), (2, "b", "x", 1)), ["k"], ["n"])
    store.upsert("t", frame((1, "A", "y", 1)), ["k"], ["n"])
    assert sorted((r["k"], r["v"], r["p"]) for r in store.read("t").collect()) == [(1, "A", "y"), (2, "b", "x")]
    assert store.read("t").filter("p = 'y'").count() == 1


def test_recluster_keeps_all_rows(spark, store):
    load_table(store, "dim_item", items(spark, *[(str(i), f"n{i % 3}", None, None) for i in range(50)]), ITEMS)
    store.recluster("dim_item", ITEM.cluster_by, tie=ITEM.key)
    assert store.read("dim_item").count() == 50


def test_upsert_measures_a_large_batch(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        old = spark.range(1000).select(F.col("id").alias("k"), F.lit(0).alias("v"))
        new = spark.range(500, 1500).select((F.col("id") - F.col("id") % 2).alias("k"), F.lit(1).alias("v"), F.col("id").alias("n"))
        got = upsert(old, new, ["k"], ["n"])
        assert "BroadcastHashJoin" in plan_of(got)
        assert got.count() == 1250 and got.filter("v = 1").count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# Marks by database


USER = "_database string, id bigint, user_id bigint, first_name string, updated_at_epoch bigint, _pos int"
DAY = 86_400_000
JANUARY = 1_704_067_200_000


def users(spark, *rows):
    return {"users": spark.createDataFrame([(d, i, i, n, JANUARY + day * DAY, i) for d, i, n, day in rows], USER)}


def loaded_users(store):
    return {r["user_id"]: r["first_name"] for r in store.read("dim_users").collect()}


def test_a_database_that_joins_later_loses_nothing(spark, store, tmp_path):
    """Also one that could not be opened before, or that stands behind the others."""
    state = str(tmp_path / "state")
    go = lambda tables, **more: run(spark, tables, store, state_path=state, incremental=True, mode="upsert", load_options={"order_by": ["user_id"]}, **more)
    go(users(spark, ("tenant_a", 1, "a", 20)), failures=[("tenant_b", "users", "AnalysisException")])
    rows = [("tenant_a", 1, "late", 5), ("tenant_a", 2, "new", 21), ("tenant_b", 10, "b", 10), ("tenant_c", 20, "c", 1)]
    assert go(users(spark, *rows)).total_records == 3
    assert loaded_users(store) == {1: "a", 2: "new", 10: "b", 20: "c"}
    # Each goes on from its own mark.
    rows = [("tenant_a", 3, "early", 15), ("tenant_b", 11, "b2", 15), ("tenant_c", 21, "c2", 2), ("tenant_c", 20, "C", 0), (None, 30, "none", 0)]
    assert go(users(spark, *rows)).total_records == 3
    assert loaded_users(store) == {1: "a", 2: "new", 10: "b", 11: "b2", 20: "c", 21: "c2", 30: "none"}
    marks = {(r["database"], r["value"].day) for r in current_watermarks(spark.read.parquet(f"{state}/watermarks")).collect()}
    assert marks == {("tenant_a", 22), ("tenant_b", 16), ("tenant_c", 3), (None, 1)}


def test_no_mark_for_tables_joined_with_a_source_that_failed(spark, store, tmp_path):
    state = str(tmp_path / "state")
    tables = users(spark, ("tenant_a", 1, "a", 20), ("tenant_b", 2, "b", 20))
    run(spark, tables, store, state_path=state, incremental=True, mode="upsert", failures=[("tenant_b", "user_accounts", "AnalysisException")])
    marks = current_watermarks(spark.read.parquet(f"{state}/watermarks")).collect()
    assert [(r["table"], r["database"]) for r in marks] == [("users", "tenant_a")]
    metrics = run_metrics(spark.read.parquet(f"{state}/run_metrics")).first()
    assert (metrics["extraction_records"], metrics["failed_tables"], metrics["outcome"]) == (2, 1, "partial")
    sources = read_events(spark, f"{state}/job_events").filter("kind = 'source'").collect()
    assert [(r["name"], r["status"], r["details"]) for r in sources] == [("tenant_b.user_accounts", "failed", "AnalysisException")]


def test_marks_kept_without_a_database_read_the_history_whole(spark, store, tmp_path):
    state = str(tmp_path / "state")
    old = spark.createDataFrame([("users", datetime(2024, 1, 20), "r", datetime(2024, 1, 21))], "table string, value timestamp, run_id string, committed_at timestamp")
    old.write.parquet(f"{state}/watermarks")
    got = run(spark, users(spark, ("tenant_a", 1, "a", 1)), store, state_path=state, incremental=True, mode="upsert", load_options={"order_by": ["user_id"]})
    assert got.total_records == 1


def test_marks_reach_partitions_and_files(spark, tmp_path):
    path = str(tmp_path / "users")
    rows = [(f"t{d}", i, JANUARY + (d * 10 + i % 10) * DAY) for d in range(30) for i in range(40)]
    spark.createDataFrame(rows, "_database string, id bigint, updated_at_epoch bigint").write.partitionBy("_database").parquet(path)
    df = spark.read.parquet(path)
    history = database_marks({"users": df.filter("id < 35 AND _database != 't7'")}).selectExpr(
        "table", "database", "value", "'r' AS run_id", "timestamp'2024-02-01' AS committed_at")
    due = changed_since({"users": df}, history)["users"]
    got = {(r["_database"], r["id"]) for r in due.collect()}
    assert got == {(f"t{d}", i) for d in range(30) for i in range(40) if i % 10 == 9 or d == 7}
    plan = plan_of(changed_since({"users": df}, history)["users"])
    assert plan.count("FileScan") <= 9 and plan.count("GreaterThanOrEqual(updated_at_epoch") == plan.count("FileScan") - 1


# Replay


def test_a_failed_run_goes_on_from_its_extract(spark, store, tmp_path):
    state, extracts = str(tmp_path / "state"), str(tmp_path / "extracts")
    project = "_database string, id bigint, name string, tenant_tsid bigint, updated_at_epoch bigint"
    tables = {
        "project": spark.createDataFrame([("t", 1, "p", 5, JANUARY)], project),
        "agents": spark.createDataFrame([(1, "a", 5, JANUARY)], "id bigint, unique_id string, tenant_tsid bigint, updated_at_epoch bigint"),
    }
    real = store.upsert

    def failing_store(table, *args, **more):
        if table == "dim_agents":
            raise ValueError("no agents today")
        return real(table, *args, **more)

    store.upsert = failing_store
    options = {"incremental": True, "mode": "upsert", "strategy": "all_or_nothing"}
    first = run(spark, tables, store, state_path=state, job_id="j", extract_path=extracts, **options)
    assert first.names("loaded") == ["dim_projects"] and first.names("failed") == ["dim_agents"]
    assert not (tmp_path / "state" / "watermarks").exists()
    store.upsert = real
    again = replay(spark, store, state, extracts, mode="upsert", strategy="all_or_nothing")
    assert list(again) == ["j"] and again["j"].names("loaded") == ["dim_agents"]
    assert store.read("dim_agents").first()["name"] == "a" and store.read("dim_projects").count() == 1
    marks = {(r["table"], r["database"]) for r in current_watermarks(spark.read.parquet(f"{state}/watermarks")).collect()}
    assert marks == {("project", "t"), ("agents", None)}
    assert replay(spark, store, state, extracts) == {}
