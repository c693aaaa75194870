import gzip
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from conftest import plan_of
from starloom.functions.window import IncrementalWindow
from starloom.operators.report import table_counts
from starloom.plans.build import build_all, build_target
from starloom.plans.targets import TARGETS
from starloom.sinks.datasets import read_counts, read_datasets, write_extract, write_transformed
from starloom.sources.envelope import document_tables, explode_extract, read_documents, read_extract, read_single, read_transformed, table_rows
from starloom.sources.scan import Source, has_changes, latest_dataset, latest_file, layout_databases, scan, scan_all, scan_layout, scan_layouts

USERS = T.StructType().add("id", T.LongType()).add("name", T.StringType()).add("tags", T.StringType())
EXTRACT = {
    "identity": {"users": {"records": 2, "sample": [{"id": 1, "name": "a", "tags": "x"}, {"id": "7", "name": None}]}},
    "tenant_1": {"users": {"records": 1, "sample": [{"id": 3}]}, "project": {"records": 0, "sample": []}, "odd": {}},
    "extraction_metadata": {"total_tables": 3, "date_filtering": {"enabled": False}},
}


def test_multi_database_documents(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps(EXTRACT))
    (tmp_path / "two.json").write_text(json.dumps({"tenant_2": {"users": {"records": 1, "sample": [{"id": 9}]}}}))
    rows = read_extract(spark, str(tmp_path / "*.json"))
    users = table_rows(rows, "users", USERS)
    got = sorted((r["_database"], r["_pos"], r["id"], r["name"]) for r in users.collect())
    assert [(g[0], g[1]["file"].rsplit("/")[-1], g[1]["pos"]) for g in got] == [
        ("identity", "one.json", 0), ("identity", "one.json", 1), ("tenant_1", "one.json", 0), ("tenant_2", "two.json", 0)]
    assert [g[2] for g in got] == [1, 7, 3, 9]
    assert table_rows(rows, "project", USERS).isEmpty()


def test_single_table_documents(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"database": "d", "table": "users", "row_count": 1, "data": [{"id": 4, "name": "n"}]}))
    (tmp_path / "b.json").write_text(json.dumps({"table": "users", "timestamp": "t", "row_count": 1, "data": [{"id": 5}]}))
    got = table_rows(read_single(spark, str(tmp_path / "*.json")), "users", USERS).collect()
    assert {(r["_database"], r["id"]) for r in got} == {("d", 4), (None, 5)}


def test_transformed_documents_plain_and_gzip(spark, tmp_path):
    plain = {"etl_timestamp": "t", "tables": {"dim_x": [{"id": 1, "name": "a"}], "dim_empty": []}}
    (tmp_path / "p.json").write_text(json.dumps(plain))
    with gzip.open(tmp_path / "z.json.gz", "wt") as out:
        json.dump({"dim_x": [{"id": 2}]}, out)
    rows = read_transformed(spark, [str(tmp_path / "p.json"), str(tmp_path / "z.json.gz")])
    assert {r["id"] for r in table_rows(rows, "dim_x", USERS).collect()} == {1, 2}
    assert table_rows(rows, "dim_empty", USERS).isEmpty()


def test_documents_to_target(spark, tmp_path):
    (tmp_path / "e.json").write_text(json.dumps({"d": {
        "users": {"records": 2, "sample": [{"id": 1, "user_id": 1}, {"id": 2, "user_id": 2}]},
        "user_accounts": {"records": 2, "sample": [{"user_id": 2, "id": 20}, {"user_id": 2, "id": 21}]},
    }}))
    rows = read_extract(spark, str(tmp_path / "e.json"))
    tables = {t: table_rows(rows, t, T.StructType.fromDDL("id bigint, user_id bigint")) for t in ("users", "user_accounts")}
    got = build_target(TARGETS["dim_users"], tables).collect()
    assert {(r["user_id"], r["user_account_id"]) for r in got} == {(1, 20), (2, 20)}


def test_documents_to_all_their_targets(spark, tmp_path):
    """Values as other tools write them: epoch milliseconds, 0/1, bytes as text, nested JSON."""
    stored = {
        "accounts": {"sample": [{"id": 1, "account_id": 1, "name": "n", "created_date": 1700000000123, "updated_date": "2024-01-02 03:04:05"},
                                {"id": 2, "account_id": 2, "name": "m", "created_date": 1700000000}, {"id": 3, "account_id": 3, "name": "o"}]},
        "authentication_modules": {"sample": [{"account_id": 1, "enabled": "b'\\x00'"}, {"account_id": 2, "enabled": 1}, {"account_id": 3, "enabled": 0}]},
        "test_data": {"sample": [{"id": 5, "columns": {"a": [1, 2]}, "test_data_name": "t"}]},
        "agents": {"sample": [{"id": 6, "tenant_tsid": 1, "is_active": 1}, {"id": 7, "tenant_tsid": 1, "is_active": "false"}]},
    }
    (tmp_path / "e.json").write_text(json.dumps({"db": stored}))
    targets = build_all(TARGETS, document_tables(read_extract(spark, str(tmp_path / "e.json"))))
    assert set(targets) == {"dim_accounts", "dim_test_data", "dim_agents"}
    accounts = {r["account_id"]: r for r in targets["dim_accounts"].collect()}
    assert [accounts[i]["auth_enabled"] for i in (1, 2, 3)] == [False, True, False]
    assert accounts[1]["created_at"] == datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert accounts[1]["updated_at"] == datetime(2024, 1, 2, 3, 4, 5) and accounts[2]["created_at"] is None
    assert targets["dim_test_data"].first()["data_json"] == '{"a":[1,2]}'
    assert {r["agent_id"]: r["is_active"] for r in targets["dim_agents"].collect()} == {6: True, 7: False}


def test_newest(spark, tmp_path):
    for i, name in enumerate(["b", "c", "a"]):
        spark.range(1).write.parquet(str(tmp_path / "sets" / name))
        (tmp_path / f"{name}.json").write_text("{}")
        for root, _, files in os.walk(tmp_path / "sets" / name):
            for f in files:
                os.utime(os.path.join(root, f), (1e9 + i, 1e9 + i))
        os.utime(tmp_path / f"{name}.json", (1e9 + i, 1e9 + i))
    assert latest_file(spark, str(tmp_path / "*.json")).endswith("/a.json")
    assert latest_dataset(spark, str(tmp_path / "sets")).endswith("/a")


def frames(spark):
    rows = spark.range(100).select(
        F.when(F.col("id") < 60, "tenant_a").when(F.col("id") < 90, "tenant_b").otherwise("staging_c").alias("_database"),
        F.col("id"), (F.lit(1704844800000) + F.col("id") * 3_600_000).alias("updated_at_epoch"),
    )
    return {"project": rows, "agents": rows.filter("id < 3")}


def test_extract_layout(spark, tmp_path):
    root = str(tmp_path)
    counts = write_extract(spark, frames(spark), root, IncrementalWindow.resolve("2024-01-10", "new"), "test")
    assert {(r["_database"], r["table"], r["records"]) for r in counts.collect()} == {
        ("tenant_a", "project", 60), ("tenant_b", "project", 30), ("staging_c", "project", 10), ("tenant_a", "agents", 3)}
    meta = spark.read.json(f"{root}/extraction_metadata").first()
    assert (meta["total_databases"], meta["total_tables"], meta["total_records"], meta["environment"]) == (3, 4, 103, "test")
    assert meta["date_filtering"].asDict() == {"enabled": True, "start_date": "2024-01-10 00:00:00"}

    window = IncrementalWindow.resolve("2024-01-10", "new", 3)
    df = scan_layout(spark, root, "project", window, include="tenant", exclude="_b")
    assert {r["_database"] for r in df.collect()} == {"tenant_a"} and df.count() == 60
    plan = plan_of(df)
    partition_filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "_database" in partition_filters
    assert "LessThanOrEqual(updated_at_epoch" in plan
    assert plan_of(df.select("id")).split("ReadSchema: ")[1].startswith("struct<id:bigint,updated_at_epoch:bigint>")


def test_planning_reads_no_rows(spark, tmp_path):
    """Which databases hold which tables is in the list of the folders; counts are kept with the extract."""
    from fixtures import source_tables

    root = str(tmp_path)
    tables = {n: df for n, df in source_tables(spark, rows=3).items() if n in ("users", "user_accounts", "user_preferences", "project")}
    write_extract(spark, tables, root)
    frames, _ = scan_layouts(spark, root, tables, include="tenant_a,identity")
    held = layout_databases(spark, root, tables, include="tenant_a,identity")
    assert held["project"] == {"tenant_a"} and held["users"] == {"identity"}
    want = {n: df.count() for n, df in build_all(TARGETS, frames).items()}
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        built = build_all(TARGETS, frames, available=held)
        counts = read_counts(spark, root)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert {n: df.count() for n, df in built.items()} == want and set(want) == {"dim_users", "dim_projects"}
    assert {(r["_database"], r["table"]): r["records"] for r in counts.collect()}["tenant_b", "project"] == 3


def test_layouts_that_are_there(spark, tmp_path):
    write_extract(spark, frames(spark), str(tmp_path))
    tables, missing = scan_layouts(spark, str(tmp_path), ["project", "agents", "users", "SPRING_SESSION"], exclude="staging")
    assert set(tables) == {"project", "agents"} and [m[0] for m in missing] == ["users"]
    assert tables["project"].count() == 90


def test_scan_many_databases_and_a_missing_table(spark, tmp_path):
    for name in ("tenant_a", "tenant_b"):
        spark.range(5).withColumn("created_at", F.lit(datetime(2024, 1, 10))).write.parquet(str(tmp_path / name / "project"))
    spark.range(2).write.parquet(str(tmp_path / "tenant_a" / "agents"))
    sources = [Source(name, str(tmp_path / name)) for name in ("tenant_a", "tenant_b")]
    tables, failures = scan_all(spark, sources, ["project", "agents", "SPRING_SESSION"])
    assert set(tables) == {"project", "agents"} and tables["project"].count() == 10
    assert [(f[0], f[1]) for f in failures] == [("tenant_b", "agents")]
    window = IncrementalWindow.resolve("2024-01-11", "new")
    assert scan(spark, sources[0], "project", window).isEmpty()
    assert not has_changes(tables["project"], window) and has_changes(tables["project"], IncrementalWindow())
    assert {r["records"] for r in table_counts(tables).filter("table = 'project'").collect()} == {5}


def test_position_in_file(spark, tmp_path):
    spark.range(5).withColumnRenamed("id", "n").coalesce(1).write.parquet(str(tmp_path / "d" / "t"))
    df = Source("d", str(tmp_path / "d")).read(spark, "t")
    assert [r["n"] for r in df.orderBy("_pos").collect()] == [0, 1, 2, 3, 4]


def test_credentials_are_not_shown():
    source = Source.jdbc({"tenant": "mysql://u:secret@h/x"}, "tenant_1", numPartitions="8")
    assert "secret" not in repr(source) and source.options["numPartitions"] == "8"


def test_broken_documents_fail(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"db": {"t": {"sample": [{"a": 1}')
    with pytest.raises(Exception, match="MALFORMED|parse|JSON"):
        explode_extract(read_documents(spark, str(tmp_path / "x.json"))).count()


def test_transformed_datasets(spark, tmp_path):
    targets = {"dim_a": spark.range(3), "dim_b": spark.range(4)}
    write_transformed(targets, str(tmp_path / "p"))
    write_transformed(targets, str(tmp_path / "j"), format="json", gzip=True)
    assert any(f.name.endswith(".json.gz") for f in (tmp_path / "j" / "dim_a").iterdir())
    assert {n: d.count() for n, d in read_datasets(spark, str(tmp_path / "p"), list(targets)).items()} == {"dim_a": 3, "dim_b": 4}
    assert read_datasets(spark, str(tmp_path / "j"), ["dim_b"], format="json")["dim_b"].count() == 4
