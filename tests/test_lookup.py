"""Lookup joins against a plain loop over small frames, and the plans they make."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from starloom.operators.sets import within
from starloom.operators.lookup import Lookup, broadcast_checked, first_per_key, last_per_key, lookup_join


def by_loop(main, related, on_miss):
    out = []
    for db, key in main:
        rows = sorted((r for r in related if r[0] == db), key=lambda r: r[2])
        hit = next((r for r in rows if r[1] == key), None)
        if hit is None and on_miss == "first" and rows:
            hit = rows[0]
        out.append((db, key, hit[3] if hit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("on_miss", ["first", "null"])
@pytest.mark.parametrize("scoped", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_like_a_loop(spark, on_miss, scoped, seed):
    rnd = random.Random(seed)
    databases = ["a", "b", "c"] if scoped else ["a"]
    keys = [None, 1, 2, 3, 4, 5]
    main = [(rnd.choice(databases), rnd.choice(keys)) for _ in range(60)]
    related = [(rnd.choice(databases[:2]), rnd.choice(keys[:4]), i, rnd.choice([None, f"v{i}"])) for i in range(40)]
    left = spark.createDataFrame(main, "_database string, k int")
    right = spark.createDataFrame(related, "_database string, k int, _pos int, v string")
    lookup = Lookup(right, {"v": "v"}, ["_pos"], key="k", on_miss=on_miss)
    got = lookup_join(left, {"r": lookup}, scope=("_database",) if scoped else ())
    rows = sorted(((r["_database"], r["k"], r["_hit_r"] and r["_hit_r"]["v"]) for r in got.collect()), key=repr)
    assert rows == by_loop(main, related, on_miss)


def test_match_with_null_fields_is_a_match(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(9, 0, "other"), (1, 1, None)], "k int, _pos int, v string")
    got = lookup_join(left, {"r": Lookup(right, {"v": "v"}, ["_pos"], key="k")})
    assert {(r["k"], r["_hit_r"]["v"]) for r in got.collect()} == {(1, None), (2, "other")}


def test_key_missing_on_one_side_gives_the_first_row(spark):
    left = spark.createDataFrame([(1,), (2,)], "id int")
    right = spark.createDataFrame([(2, 5, "later"), (1, 3, "first")], "k int, _pos int, v string")
    got = lookup_join(left, {"r": Lookup(right, {"v": "v"}, ["_pos"], key="k")})
    assert {r["_hit_r"]["v"] for r in got.collect()} == {"first"}


def test_empty_related_gives_null(spark):
    left = spark.createDataFrame([(1,)], "k int")
    right = spark.createDataFrame([], "k int, _pos int, v string")
    got = lookup_join(left, {"r": Lookup(right, {"v": "v"}, ["_pos"], key="k")})
    assert got.first()["_hit_r"] is None


def test_lookups_on_one_key_share_one_join(spark):
    left = spark.range(10).withColumnRenamed("id", "k")
    right = spark.range(20).select((F.col("id") % 7).alias("k"), F.col("id").alias("_pos"), F.col("id").alias("v"))
    lookups = {n: Lookup(right, {"v": "v"}, ["_pos"], key="k", on_miss="null") for n in ("p", "q", "r")}
    df = lookup_join(left, lookups)
    assert plan_of(df).count("Join") == 1
    assert df.count() == 10


def test_no_cross_or_nested_loop_join(spark):
    left = spark.range(10).withColumnRenamed("id", "k")
    right = spark.range(20).select((F.col("id") % 7).alias("k"), F.col("id").alias("_pos"), F.col("id").alias("v"))
    plan = plan_of(lookup_join(left, {"r": Lookup(right, {"v": "v"}, ["_pos"], key="k")}))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.fixture()
def small_skew(spark):
    """Thresholds so low that a hot key in little data counts as skew."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def hot_main(spark, hot):
    """A third of the rows share one key."""
    key = F.when(F.col("id") % 3 != 0, F.col("id") % 50_000).otherwise(F.lit(hot).cast("bigint"))
    return spark.range(0, 600_000, 1, 8).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


@pytest.mark.parametrize("hot", [None, 7])
def test_hot_key_is_split(spark, small_skew, hot):
    right = spark.range(40_000).select(F.col("id").alias("k"), F.col("id").alias("_pos"), F.col("id").alias("v"))
    joined = lookup_join(hot_main(spark, hot), {"r": Lookup(right, {"v": "v"}, ["_pos"], key="k", on_miss="null")})
    totals = joined.agg(F.count("*").alias("n"), F.max("pad"), F.count("_hit_r.v").alias("hits"))
    row = totals.collect()[0]
    assert "SortMergeJoin(skew=true)" in plan_of(totals)
    assert row["n"] == 600_000
    other = sum(1 for i in range(600_000) if i % 3 and i % 50_000 < 40_000)
    assert row["hits"] == other + (0 if hot is None else 200_000)


def test_hot_value_is_split_in_semi_joins(spark, small_skew):
    right = spark.range(40_000).select(F.col("id").alias("k"))
    totals = within(hot_main(spark, 7), right, "k").agg(F.count("*").alias("n"), F.max("pad"))
    row = totals.collect()[0]
    assert "SortMergeJoin(skew=true)" in plan_of(totals)
    assert row["n"] == 200_000 + sum(1 for i in range(600_000) if i % 3 and i % 50_000 < 40_000)


def test_broadcast_only_below_the_limit(spark):
    df = spark.range(1000)
    assert "broadcast" in broadcast_checked(df)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in broadcast_checked(df, limit=10)._jdf.queryExecution().logical().toString().lower()


def test_first_and_last_per_key(spark):
    rows = [(1, 2, "b"), (1, 1, "a"), (1, 3, None), (None, 1, "x"), (None, 2, "y")]
    df = spark.createDataFrame(rows, "k int, n int, v string")
    assert {tuple(r) for r in first_per_key(df, ["k"], ["n"]).collect()} == {(1, 1, "a"), (None, 1, "x")}
    assert {tuple(r) for r in last_per_key(df, ["k"], ["n"]).collect()} == {(1, 3, None), (None, 2, "y")}


@pytest.fixture()
def no_small_sides(spark):
    """Spark itself broadcasts next to nothing, so join sides are stored and measured."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("limit, join", [(32 * 1024 * 1024, "BroadcastHashJoin"), (10, "SortMergeJoin")])
def test_large_sides_are_measured(spark, no_small_sides, limit, join):
    """The real size of the reduced side picks the join."""
    left = spark.range(1000).withColumnRenamed("id", "k")
    right = spark.range(900).select((F.col("id") % 300).alias("k"), F.col("id").alias("_pos"), F.col("id").alias("v"))
    df = lookup_join(left, {"r": Lookup(right, {"v": "v"}, ["_pos"], key="k", on_miss="null")}, broadcast_bytes=limit)
    assert join in plan_of(df)
    assert df.count() == 1000 and df.filter("_hit_r.v = k").count() == 300


@pytest.mark.parametrize("on_miss", ["first", "null"])
@pytest.mark.parametrize("scoped", [True, False])
def test_measured_sides_like_a_loop(spark, no_small_sides, scoped, on_miss):
    test_like_a_loop(spark, on_miss, scoped, 3)


def test_first_row_comes_from_the_stored_side(spark, no_small_sides, tmp_path):
    """The related table is read once, for the reduction; the first row of all is found in its result."""
    right = spark.range(50).select(F.col("id").alias("k"), F.col("id").alias("_pos"), F.col("id").alias("v"))
    right.write.parquet(str(tmp_path / "r"))
    left = spark.range(100).withColumnRenamed("id", "k")
    lookup = Lookup(spark.read.parquet(str(tmp_path / "r")), {"v": "v"}, ["_pos"], key="k")
    df = lookup_join(left, {"r": lookup})
    assert "FileScan" not in plan_of(df)
    assert df.filter("_hit_r.v = 0").count() == 51


def test_keys_of_two_types(spark):
    left = spark.createDataFrame([(1,), (2,)], "k bigint")
    numbers = spark.createDataFrame([(1, 0, "n")], "k int, _pos int, v string")
    texts = spark.createDataFrame([("2", 0, "t")], "k string, _pos int, v string")
    lookups = {n: Lookup(df, {"v": "v"}, ["_pos"], key="k", on_miss="null") for n, df in (("a", numbers), ("b", texts))}
    got = {r["k"]: (r["_hit_a"], r["_hit_b"]) for r in lookup_join(left, lookups).collect()}
    assert got[1][0]["v"] == "n" and got[1][1] is None and got[2][0] is None and got[2][1]["v"] == "t"
