"""What the plans of all registered queries must not hold."""

import re

import pytest

import __spark_entry__ as contract
from conftest import plan_of
from starloom.queries import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroupsInPandas")
# One row per table or database flows through a single partition here, or a limit is the feature.
GLOBAL_SORT = {"catalog_listing", "sample_limit", "page", "page_deep", "top_failed"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF))
    assert not [word for word in FORBIDDEN if word in plan]
    if name not in GLOBAL_SORT:
        assert "rangepartitioning" not in plan and "TakeOrdered" not in plan
    for line in plan.splitlines():
        if "Exchange SinglePartition" in line:
            # Only partial aggregates, one row per task, may meet in one partition.
            below = plan[plan.index(line):].splitlines()[1]
            assert re.search("Aggregate|Limit|TakeOrdered", below) or name in GLOBAL_SORT, below


def columns_read(plan: str, table: str) -> set[str]:
    found = set()
    for scan in re.findall(r"FileScan parquet [^\n]*", plan):
        if f"/{table}.parquet" in scan:
            schema = scan.split("ReadSchema: struct<")[1]
            found |= set(re.findall(r"(\w+):", schema))
    return found


@pytest.mark.parametrize(
    "name, table, columns",
    [
        ("lookup_first_match", "customer", {"c_custkey", "c_name"}),
        ("star_target", "customer", {"c_custkey", "c_nationkey", "c_name", "c_mktsegment"}),
        ("pk_duplicates", "lineitem", {"l_orderkey", "l_linenumber"}),
        ("high_water_mark", "lineitem", {"l_shipdate"}),
        ("window_new_range", "events", {"event_id", "ts"}),
        ("target_dim_features", "lineitem", {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"}),
        ("profile_targets", "documents", set()),
    ],
)
def test_only_needed_columns_are_read(spark, name, table, columns):
    assert columns_read(plan_of(contract.queries()[name](spark, SF)), table) == columns
