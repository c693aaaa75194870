"""Pages, layouts and splits by ranges of values."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from starloom.operators.sets import page
from starloom.sinks.store import write_clustered
from starloom.sources.scan import Source
from starloom.sources.splits import Split, count_sql, plan_frame, plan_query, predicates, splits, stats_sql

ROWS = "a bigint, b string, c int"


def rows(spark, n=4000):
    """A third of the rows on one value, some without one."""
    r = random.Random(2)
    made = [(None if k % 11 == 0 else 7 if k % 3 == 0 else r.randrange(10**6), r.choice("xyzé") + str(r.randrange(50)), k) for k in range(n)]
    return made, spark.createDataFrame(made, ROWS).repartition(4)


def in_order(made):
    return sorted(made, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))


@pytest.mark.parametrize("number", [0, 3, 20, 40, 66, 70, 133, 500])
def test_pages_at_any_depth(spark, number):
    made, df = rows(spark)
    want = in_order(made)[number * 30 : number * 30 + 30]
    assert [tuple(x) for x in page(df, ["a", "b", "c"], 30, number, shallow=50).collect()] == want


def test_pages_of_rare_values(spark):
    df = spark.range(0, 30_000, 1, 4).select((F.col("id") % 10_000 == 0).cast("int").alias("a"), F.col("id").alias("b"))
    for number in (0, 299, 2_999):
        got = [tuple(x) for x in page(df, ["a", "b"], 10, number, shallow=20).collect()]
        order = sorted(((k % 10_000 == 0), k) for k in range(30_000))[number * 10 : number * 10 + 10]
        assert got == [(int(x), k) for x, k in order]


def test_a_deep_page_sorts_what_is_around_it(spark, tmp_path):
    spark.range(0, 200_000, 1, 4).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = page(df, ["a"], 10, 10_000, shallow=2_000)
    assert [x["a"] for x in found.collect()] == list(range(100_000, 100_010))
    plan = plan_of(page(df, ["a"], 10, 10_000, shallow=2_000))
    assert "GreaterThanOrEqual(a," in plan and "LessThan(a," in plan and "Exchange SinglePartition" not in plan and "rangepartitioning" not in plan


def test_files_are_left_out_by_each_cluster_column(spark, tmp_path):
    df = spark.range(0, 64_000, 1, 8).select((F.col("id") % 251).alias("a"), F.xxhash64("id").alias("b"), F.col("id").alias("k"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        for name, together in (("one", False), ("all", True)):
            write_clustered(df, ["a", "b"], str(tmp_path / name), tie=["k"], together=together)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")

    def read(name, column, low, high):
        files = spark.read.parquet(str(tmp_path / name)).groupBy(F.col("_metadata.file_path")).agg(F.min(column).alias("x"), F.max(column).alias("y"))
        return files.filter((F.col("x") <= high) & (F.col("y") >= low)).count()

    middle = df.approxQuantile("b", [0.5, 0.52], 0.001)
    low, high = int(middle[0]), int(middle[1])
    assert spark.read.parquet(str(tmp_path / "all")).count() == 64_000
    assert read("one", "a", 100, 102) <= 4 and read("one", "b", low, high) >= 60
    assert read("all", "a", 100, 102) <= 32 and read("all", "b", low, high) <= 32


@pytest.mark.parametrize("number", [1, 4, 16])
def test_splits_of_uneven_keys(spark, number):
    made, df = rows(spark, 6000)
    found = plan_frame(df.withColumn("a", F.when(F.col("a") < 1000, F.col("a")).otherwise(F.col("a") * F.col("a"))), "a", number, ranges=20)
    far = df.withColumn("a", F.when(F.col("a") < 1000, F.col("a")).otherwise(F.col("a") * F.col("a")))
    counts = [far.filter(p).count() for p in predicates("a", found)]
    keyed = sum(counts[:-1])
    assert sum(counts) == 6000 and len(found) <= number and [x.rows for x in found] == counts[:-1]
    assert all(x.rows <= 2 * keyed / number or x.low <= 7 < x.high for x in found)


def test_splits_side_by_side():
    parts = [Split(k, k + 1, n) for k, n in enumerate([1, 1, 1, 50, 1, 1, 1, 1])]
    assert [(x.low, x.high, x.rows) for x in splits(parts, 4)] == [(0, 4, 53), (4, 8, 4)]
    assert splits([], 4) == [] and predicates("k", []) == ["k IS NULL"]


def test_counts_are_asked_for_in_sql(spark):
    _, df = rows(spark)
    df.createOrReplaceTempView("counted_rows")
    asked = []

    def ask(sql):
        asked.append(sql)
        return spark.sql(sql)

    found = plan_query(ask, "counted_rows", "a", 6, ranges=30)
    assert found[-1] == "a IS NULL" and sum(df.filter(p).count() for p in found) == 4000
    assert asked[0] == stats_sql("counted_rows", "a") and asked[1].startswith("SELECT FLOOR((a - 7) / ") and count_sql("t", "k", 5, 10, 3).endswith("k >= 5 AND k < 35 GROUP BY FLOOR((k - 5) / 10)")
    source = Source.jdbc({"tenant": "mysql://u:p@h/x"}, "tenant_1", split_by="id", splits=4)
    assert (source.split_by, source.splits) == ("id", 4) and "split_by" not in source.options
