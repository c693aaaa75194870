"""Versions of tables: what outlives a session, a failure or another writer."""

import os
import subprocess
import sys
import textwrap
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from starloom.plans.run import load_table, recover
from starloom.sinks import files
from starloom.sinks.datasets import write_extract
from starloom.sinks.store import StarStore
from starloom.streaming.incremental import read_landing, stream_upsert

ROOT = Path(__file__).resolve().parent.parent


def schema(ddl):
    return T.StructType.fromDDL(ddl)


def frame(spark, *rows, ddl="k bigint, v string, n int"):
    return spark.createDataFrame(list(rows), ddl)


def seen(store, table="t", *names):
    return sorted(tuple(r) for r in store.read(table).select(*names or ["k", "v"]).collect())


def data_files(root):
    return {str(p): p.stat().st_mtime_ns for p in Path(root).rglob("part-*.parquet")}


@pytest.fixture()
def bucketed(spark, store):
    store.ensure_table("t", schema("k bigint, v string"), key=["k"], buckets=8)
    store.upsert("t", frame(spark, *[(k, f"a{k}", 1) for k in range(200)]), ["k"], ["n"])
    return store


def test_upsert_rewrites_its_buckets_alone(spark, bucketed):
    before = data_files(f"{bucketed.root}/t")
    version = bucketed.version("t")
    assert len(version.folders) == 8 and bucketed.read("t").columns == ["k", "v"]
    bucketed.upsert("t", frame(spark, (7, "b", 1), (7, "c", 2)), ["k"], ["n"])
    assert seen(bucketed) == sorted((k, "c" if k == 7 else f"a{k}") for k in range(200))
    after = data_files(f"{bucketed.root}/t")
    assert before.items() <= after.items()  # nothing was touched, one folder came
    now = bucketed.version("t")
    assert len(set(version.folders) & set(now.folders)) == 7 and len(now.folders) == 8
    assert bucketed.spark.sql(f"SELECT count(*), max(v) FROM {bucketed.name('t')} WHERE k = 7").first()[:] == (1, "c")
    assert bucketed.drop_old_versions("t", keep=1) >= 1
    assert seen(bucketed)[7] == (7, "c") and bucketed.read("t").count() == 200


def test_two_upserts_overlap(spark, bucketed):
    """Into the same table, also into the same buckets: both are there in the end."""
    meet, real = threading.Barrier(2, timeout=60), bucketed._rows
    first = {"left": True, "right": True}

    def together(version, folders):
        name = threading.current_thread().name
        if first.pop(name, None):
            meet.wait()  # both have read the same version
        return real(version, folders)

    bucketed._rows = together
    work = lambda low, text: bucketed.upsert("t", frame(spark, *[(k, text, 1) for k in range(low, low + 60)]), ["k"], ["n"])
    threads = [threading.Thread(target=work, args=x, name=n) for n, x in (("left", (0, "left")), ("right", (100, "right")))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    bucketed._rows = real
    got = dict(seen(bucketed))
    assert len(got) == 200 and all(got[k] == "left" for k in range(60)) and all(got[k] == "right" for k in range(100, 160))


def test_keys_that_are_null_are_spread(spark, store):
    store.ensure_table("t", schema("k bigint, v string"), key=["k"], buckets=4)
    store.upsert("t", frame(spark, *[(None, f"v{k}", 1) for k in range(100)]), ["k"], ["n"])
    store.upsert("t", frame(spark, (None, "v1", 1), (5, "x", 1)), ["k"], ["n"])
    assert store.read("t").count() == 102 and len({f.split("/")[0] for f in store.version("t").folders}) == 4


def test_buckets_of_partitions(spark, store):
    ddl = "k bigint, v string, _database string, n int"
    store.ensure_table("t", schema("k bigint, v string, _database string"), partition_by=["_database"], key=["k", "_database"], buckets=2)
    rows = [(k, "a", d, 1) for k in range(20) for d in ("x=1/%", None, "tenant b")]
    store.upsert("t", frame(spark, *rows, ddl=ddl), ["k", "_database"], ["n"])
    store.append("t", frame(spark, (50, "new", None, 1), ddl=ddl))
    store.upsert("t", frame(spark, (3, "b", "x=1/%", 1), ddl=ddl), ["k", "_database"], ["n"])
    got = [tuple(r) for r in store.read("t").select("_database", "k", "v").collect()]
    assert len(got) == 61 and ("x=1/%", 3, "b") in got and ("tenant b", 3, "a") in got and (None, 50, "new") in got
    assert spark.table(f"{store.database}.t").filter("_database = 'x=1/%'").count() == 20
    assert store.compact("t") == 1 and store.compact("t") == 0 and store.read("t").count() == 61


def test_an_upsert_by_another_key_looks_everywhere(spark, bucketed):
    bucketed.upsert("t", frame(spark, (500, "a7", 1)), ["v"], ["n"])
    got = seen(bucketed)
    assert len(got) == 200 and (500, "a7") in got and (7, "a7") not in got


def test_evolve_keeps_partitions_buckets_and_defaults(spark, store):
    ddl = "k bigint, on boolean, _database string, n int"
    store.ensure_table("t", schema("k bigint, on boolean, _database string"), {"on": True}, ["_database"], key=["k", "_database"], buckets=2)
    store.append("t", frame(spark, (1, True, "a", 1), (2, False, "b", 1), ddl=ddl))
    assert store.evolve("t", schema("k string, on boolean, is_new boolean, _database string")) == ["is_new"]
    assert store.partition_columns("t") == ["_database"] and store.version("t").buckets == 2
    assert [tuple(r) for r in store.read("t").select("k", "on", "is_new", "_database").orderBy("k").collect()] == [("1", True, False, "a"), ("2", False, False, "b")]
    store.append("t", spark.createDataFrame([("3", "c")], "k string, _database string"))
    assert store.read("t").schema["on"].metadata["CURRENT_DEFAULT"].lower() == "true"
    assert spark.table(f"{store.database}.t").count() == 3
    store.evolve("t", schema("k bigint, on boolean, is_new boolean, _database string"), on_mismatch="recreate")
    assert store.read("t").isEmpty() and store.partition_columns("t") == ["_database"]
    store.append("t", frame(spark, (1, True, "a", 1), ddl=ddl))
    assert store.read("t").count() == spark.table(f"{store.database}.t").count() == 1


def test_added_columns_of_partitions(spark, store):
    store.ensure_table("t", schema("k bigint, p string"), partition_by=["p"])
    store.append("t", spark.createDataFrame([(1, "a")], "k bigint, p string"))
    store.evolve("t", schema("k bigint, is_on boolean, p string"))
    store.append("t", spark.createDataFrame([(2, True, "a")], "k bigint, is_on boolean, p string"))
    want = [(1, False), (2, True)]
    assert seen(store, "t", "k", "is_on") == want
    assert sorted(tuple(r) for r in spark.table(f"{store.database}.t").select("k", "is_on").collect()) == want


def test_clear_overwrite_and_recluster_of_partitions(spark, store):
    store.ensure_table("t", schema("k bigint, p string"), partition_by=["p"])
    rows = spark.range(40).select(F.col("id").alias("k"), (F.col("id") % 2).cast("string").alias("p"))
    store.append("t", rows)
    store.recluster("t", ["k"])
    assert store.read("t").count() == 40 and store.partition_columns("t") == ["p"]
    store.overwrite("t", rows.filter("k < 4"))
    assert store.read("t").count() == spark.table(f"{store.database}.t").count() == 4
    assert [tuple(r) for r in store.clear(["t"]).collect()] == [("t", 4, 0)]
    assert store.read("t").isEmpty() and spark.table(f"{store.database}.t").isEmpty() and store.partition_columns("t") == ["p"]
    store.append("t", rows)
    assert store.read("t").filter("p = '1'").count() == 20


def test_the_last_of_equal_rows_stays(spark, store):
    rows = spark.createDataFrame([(1, f"n{k}") for k in range(50)], "item_id bigint, name string").coalesce(1)
    from test_load import ITEMS

    load_table(store, "dim_item", rows, ITEMS, mode="upsert")
    assert seen(store, "dim_item", "name") == [("n49",)]
    load_table(store, "dim_item", rows.limit(10), ITEMS, mode="upsert", buckets=4)
    assert seen(store, "dim_item", "name") == [("n9",)]


def test_an_append_writes_its_rows_once(spark, store):
    from test_load import ITEMS, items

    rows = items(spark, ("1", "a", "1", 1700000000123), ("x", "b", None, None))
    for table, more in (("dim_item", {}), ("other", {"per_database": True})):
        frame_ = rows.withColumn("_database", F.lit("db")) if more else rows
        assert load_table(store, table, frame_, ITEMS, **more)[1] == "loaded"
    written = [p for p in Path(store.root).rglob("part-*.parquet") if "_rejects" not in str(p)]
    assert len(written) == len({os.path.basename(p) for p in written}) and not list(Path(store.root, "_staging").rglob("part-*"))
    assert store.read("dim_item").count() == 1 and spark.read.parquet(f"{store.root}/_rejects/dim_item").count() == 1


def test_loads_into_buckets(spark, store):
    from test_load import ITEMS, items

    rows = lambda text, *ids: items(spark, *[(str(k), text, "1", None) for k in ids])
    load_table(store, "dim_item", rows("a", *range(50)), ITEMS, mode="upsert", buckets=4)
    load_table(store, "dim_item", rows("b", 3, 77), ITEMS, mode="upsert", cluster=True)
    load_table(store, "dim_item", rows("c", 90), ITEMS)
    got = {r["item_id"]: r["name"] for r in store.read("dim_item").collect()}
    assert got == {k: "a" for k in range(50)} | {3: "b", 77: "b", 90: "c"} and store.version("dim_item").buckets == 4


def test_targets_are_found_by_another_session(spark, store, tmp_path):
    from test_load import ITEMS, items

    load_table(store, "dim_item", items(spark, ("1", "a", "1", None)), ITEMS)
    parts = spark.createDataFrame([(1, "a", "x"), (1, "b", "y")], "item_id bigint, name string, _database string")
    load_table(store, "dim_part", parts, None, per_database=True)
    code = f"""
        import sys
        sys.path[:0] = [{str(ROOT)!r}, {str(ROOT / 'tests')!r}]
        from pyspark.sql import SparkSession
        from starloom.session import SETTINGS
        b = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
        for k, v in {{**SETTINGS, "spark.sql.warehouse.dir": {str(tmp_path / 'w')!r}, "spark.checkpoint.dir": {str(tmp_path / 'c')!r}}}.items():
            b = b.config(k, v)
        spark = b.getOrCreate()
        from starloom.plans.run import load_table, recover
        from starloom.sinks.store import StarStore
        from test_load import ITEMS, items
        store = StarStore(spark, "again", {store.root!r})
        assert store.tables() == ["dim_item", "dim_part"], store.tables()
        assert spark.table("again.dim_part").filter("_database = 'y'").count() == 1
        load_table(store, "dim_item", items(spark, ("1", "A", "0", None), ("2", "b", "0", None)), ITEMS, mode="upsert")
        done = recover(store, {{"dim_item": spark.range(3), "dim_new": spark.range(4)}})
        assert done.names("loaded") == ["dim_new"]
        spark.sql("INSERT INTO again.dim_item (item_id, name) VALUES (9, 'sql')")
        assert store.read("dim_item").filter("item_id = 9").first()["is_new"] is False
        print("second session done")
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, timeout=300, env={**os.environ, "SPARK_LOCAL_IP": "127.0.0.1"})
    assert "second session done" in done.stdout, done.stderr[-2000:]
    assert {r["item_id"]: r["name"] for r in store.read("dim_item").collect()} == {1: "A", 2: "b", 9: "sql"}
    assert recover(store, {"dim_new": spark.range(9)}).rows == [] and store.read("dim_new").count() == 4


def test_a_batch_is_taken_in_once(spark, bucketed, tmp_path):
    rows = frame(spark, (1, "x", 1), (900, "y", 1))
    assert bucketed.upsert("t", rows, ["k"], ["n"], batch=("s", 3))
    number = bucketed.version("t").number
    assert not bucketed.upsert("t", frame(spark, (1, "again", 9)), ["k"], ["n"], batch=("s", 3))
    assert bucketed.version("t").number == number and dict(seen(bucketed))[1] == "x"
    assert bucketed.upsert("t", frame(spark, (1, "other stream", 9)), ["k"], ["n"], batch=("s2", 0))


@pytest.mark.parametrize("buckets", [0, 4])
def test_a_batch_that_died_runs_again(spark, store, tmp_path, buckets):
    """It dies after its files are written, and again after the commit; the table is as if it had not."""
    store.ensure_table("t", schema("k bigint, v string"), key=["k"], buckets=buckets)
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "cp")
    rows = frame(spark, *[(k, f"a{k}", 1) for k in range(30)])
    go = lambda **more: stream_upsert(read_landing(spark, landing, rows.schema), store, "t", ["k"], ["n"], checkpoint, **more).awaitTermination(120)
    rows.write.parquet(landing)
    real = store._commit

    def dies_before(table, made):
        raise OSError("gone before the commit")

    def dies_after(table, made):
        real(table, made)
        raise OSError("gone after the commit")

    for dying, there in ((dies_before, 0), (dies_after, 30)):
        store._commit = dying
        with pytest.raises(Exception, match="gone"):
            go()
        store._commit = real
        assert StarStore(spark, store.database, store.root).read("t").count() == there
    go()
    assert seen(store) == sorted((k, f"a{k}") for k in range(30)) and store.version("t").number == 1
    frame(spark, (3, "b", 2), (40, "n", 1)).write.mode("append").parquet(landing)
    go(compact_every=1)
    assert dict(seen(store))[3] == "b" and store.read("t").count() == 31


def test_a_name_is_taken_once(spark, tmp_path):
    path = str(tmp_path / "a" / "x.json")
    files.make_folder(spark, str(tmp_path / "a"))
    assert files.create_text(spark, path, "é1") and not files.create_text(spark, path, "2")
    assert files.read_text(spark, path) == "é1" and files.matching(spark, str(tmp_path / "a" / "*")) == [f"file:{path}"]


def test_rows_are_not_sorted_by_folder_before_they_are_written(spark, store, tmp_path):
    """The plans of partitioned writes have no sort, which held all rows of a task; the setting is taken back."""
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    rows = spark.range(2000).selectExpr("id", "concat('db', id % 20) AS _database")
    status = spark._jsparkSession.sharedState().statusStore()
    seen = status.executionsCount()
    load_table(store, "t", rows, None, per_database=True)
    store.append("t", rows)
    store.overwrite("t", rows)
    write_extract(spark, {"t": rows}, str(tmp_path / "extract"))
    plans = [status.executionsList().apply(k).physicalPlanDescription() for k in range(seen, status.executionsCount())]
    writes = [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p and "_database" in p]
    assert len(writes) >= 4 and not any("Sort (" in p or "Sort [" in p for p in writes)
    assert spark.conf.get(setting) == before
    # More folders than open files: the rest is sorted, and nothing is lost.
    want = sorted((r[0], r[1]) for r in rows.collect())
    assert sorted((r["id"], r["_database"]) for r in store.read("t").collect()) == want
    got = spark.read.parquet(str(tmp_path / "extract" / "t")).select("id", "_database")
    assert sorted((r[0], r[1]) for r in got.collect()) == want
