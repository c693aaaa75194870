import pytest
from pyspark.sql import functions as F

from fixtures import GROUP_DATABASES, source_tables
from starloom.operators.load import accepted, load_with_rejects
from starloom.operators.project import drop_empty_rows, fan_out, project
from starloom.operators.report import estimated_rows
from starloom.operators.sets import within, without
from starloom.session import auto_broadcast_bytes, estimated_bytes
from starloom.plans.build import build_all, build_target, choose_main, fan_out_all, main_order, table_availability
from starloom.plans.targets import TARGETS


@pytest.fixture(scope="module")
def sources(spark):
    frames = source_tables(spark)
    return {name: df.cache() for name, df in frames.items()}


@pytest.fixture(scope="module")
def targets(spark, sources):
    return build_all(TARGETS, sources)


@pytest.mark.parametrize("name", TARGETS.names())
def test_every_target(targets, name):
    mapping = TARGETS[name]
    df = targets[name]
    assert set(df.columns) == {*mapping.schema.names, "_database"}
    assert df.count() == 5 * len(GROUP_DATABASES[mapping.group])
    checked = load_with_rejects(df, mapping.schema, required=(*mapping.primary_key, *mapping.required), lengths=True)
    assert accepted(checked).count() == df.count()
    assert accepted(checked).schema.names == mapping.schema.names


def test_lookups_stay_in_their_database(sources, targets):
    # Each database has its own first row; the second tenant's rows are moved apart to tell them.
    moved = sources["application_version"].withColumn(
        "application_id", F.when(F.col("_database") == "tenant_b", F.col("application_id") + 100).otherwise(F.col("application_id"))
    )
    df = build_target(TARGETS["dim_test_suites"], {**sources, "application_version": moved})
    rows = {(r["_database"], r["test_suite_id"]): r["app_id"] for r in df.collect()}
    assert rows[("tenant_a", 3)] == 3
    assert {rows[("tenant_b", i)] for i in range(5)} == {100}


def test_main_table_choice():
    mapping = TARGETS["dim_users"]
    assert main_order(mapping)[0] == "users"
    assert choose_main(mapping, ["user_accounts", "users"]) == "users"
    assert choose_main(mapping, ["user_accounts", "user_preferences"]) == "user_preferences"
    assert choose_main(mapping, []) is None


def test_absent_main_table(spark, sources):
    tables = {"user_preferences": sources["user_preferences"], "user_accounts": sources["user_accounts"]}
    df = build_target(TARGETS["dim_users"], tables)
    rows = df.collect()
    assert len(rows) == 5 and all(r["user_id"] is None for r in rows)
    # No key joins these two, so each row takes the first account.
    assert {r["user_account_id"] for r in rows} == {0}


def test_no_source_no_target(spark, sources):
    assert build_target(TARGETS["dim_users"], {"project": sources["project"]}) is None
    assert "dim_users" not in build_all(TARGETS, {"project": sources["project"]})
    empty = {"project": sources["project"].limit(0)}
    assert build_target(TARGETS["dim_projects"], empty) is None


def test_availability(spark, sources):
    held = table_availability({"users": sources["users"], "project": sources["project"], "plain": spark.range(1), "none": spark.range(0)})
    assert held == {"users": {"identity"}, "project": {"tenant_a", "tenant_b"}, "plain": {None}, "none": frozenset()}


def test_cleaning_in_a_build(spark):
    accounts = spark.createDataFrame([(1, 1, bytearray(b"caf\xc3\xa9")), (2, 2, bytearray(b"\xff"))], "id int, account_id int, name binary")
    modules = spark.createDataFrame([(1, bytearray(b"\x00"), 0), (2, bytearray(b"\x01"), 1)], "account_id int, enabled binary, _pos int")
    rows = {r["account_id"]: r for r in build_target(TARGETS["dim_accounts"], {"accounts": accounts, "authentication_modules": modules}).collect()}
    assert rows[1]["name"] == "café" and rows[2]["name"] == "b'\\xff'"
    assert rows[1]["auth_enabled"] is False and rows[2]["auth_enabled"] is True
    audit = spark.createDataFrame([(1, None), (2, 7)], "id int, organization_tsid int")
    rows = {r["event_id"]: r["tenant_id"] for r in build_target(TARGETS["fct_audit_events"], {"audit_history": audit}).collect()}
    assert rows == {1: 0, 2: 7}


def test_nan_counts_as_a_value_and_reads_null(spark):
    steps = spark.createDataFrame([(None, float("nan")), (None, None)], "id int, step_id double")
    rows = build_target(TARGETS["fct_api_steps"], {"api_steps": steps}).collect()
    assert len(rows) == 1 and rows[0]["test_step_id"] is None


def test_users_without_the_shared_key(spark):
    """The mapping reads users.id, the join wants users.user_id: without it everyone gets the first row."""
    users = spark.createDataFrame([(1,), (2,)], "id int")
    prefs = spark.createDataFrame([(2, True, 1), (1, False, 0)], "user_id int, is_2fa_enabled boolean, _pos int")
    df = build_target(TARGETS["dim_users"], {"users": users, "user_preferences": prefs})
    assert {r["is_2fa_enabled"] for r in df.collect()} == {False}
    strict = build_target(TARGETS["dim_users"], {"users": users, "user_preferences": prefs}, on_miss="null")
    assert {r["is_2fa_enabled"] for r in strict.collect()} == {None}


def test_fan_out(sources):
    fanned = fan_out("tenant_features", sources["tenant_features"], TARGETS)
    assert set(fanned) == {"brg_tenant_features", "dim_features"}
    assert all(df.count() == 5 for df in fanned.values())
    # Without joins, a table that feeds a target only as a lookup leaves the main columns NULL.
    only = project(sources["user_preferences"], TARGETS["dim_users"], "user_preferences")
    assert only.filter("user_id IS NOT NULL").isEmpty() and only.count() == 5


def test_single_tables_add_up_without_joins(spark, sources):
    targets = fan_out_all(TARGETS, {t: sources[t] for t in ("users", "user_preferences", "organization_policy", "tenant_features")})
    assert set(targets) == {"dim_users", "brg_tenant_features", "dim_features"}
    # Rows of both tables, each with its own columns only; rows without values are kept here.
    assert targets["dim_users"].count() == 10
    assert targets["dim_users"].filter("user_id IS NULL AND is_2fa_enabled IS NOT NULL").count() == 5


def test_names_in_sets(spark):
    left = spark.createDataFrame([("A",), ("b",), (None,)], "table string")
    right = spark.createDataFrame([("a",), (None,), ("a",)], "table string")
    assert {r[0] for r in without(left, right, "table").collect()} == {"b", None}
    assert within(left, right, "table").isEmpty() and within(right, right, "table").count() == 2


def test_estimated_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    assert estimated_rows(df, row_bytes=10) == int(estimated_bytes(df) / 10 * 1.1) > 0


def test_empty_rows(spark):
    df = spark.createDataFrame([(None, ""), (None, None), (0, None), (None, " ")], "a int, b string")
    assert drop_empty_rows(df).count() == 2
    flags = spark.createDataFrame([(None, False), (None, None)], "a string, b boolean")
    assert drop_empty_rows(flags).count() == 1


@pytest.mark.parametrize("text, size", [("-1", -1), ("10485760b", 10485760), ("10MB", 10485760), ("2g", 2 << 30), ("77", 77)])
def test_broadcast_threshold(spark, text, size):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        assert auto_broadcast_bytes(spark) == size
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_mixed_inputs(spark):
    """A related table without a database belongs to all; a main one without is joined with the rows of all."""
    users = spark.createDataFrame([("a", 1, 1, 0), ("b", 2, 2, 0)], "_database string, id bigint, user_id bigint, _pos int")
    accounts = spark.createDataFrame([(2, 20, 0), (1, 10, 1)], "user_id bigint, id bigint, _pos int")
    prefs = spark.createDataFrame([("a", 1, True, 0), ("b", 2, False, 0)], "_database string, user_id bigint, is_2fa_enabled boolean, _pos int")
    got = build_target(TARGETS["dim_users"], {"users": users, "user_accounts": accounts, "user_preferences": prefs}).collect()
    assert {(r["_database"], r["user_id"], r["user_account_id"], r["is_2fa_enabled"]) for r in got} == {("a", 1, 10, True), ("b", 2, 20, False)}
    got = build_target(TARGETS["dim_users"], {"users": users.drop("_database"), "user_accounts": accounts, "user_preferences": prefs}).collect()
    assert {(r["user_id"], r["user_account_id"], r["is_2fa_enabled"]) for r in got} == {(1, 10, True), (2, 20, False)}
