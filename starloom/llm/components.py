"""Connected components by alternating large-star and small-star steps, all of them joins and aggregations.

Each step replaces links by links to smaller ids: large-star ties a vertex's larger neighbours
to its least one, small-star ties the smaller ones (and itself). A vertex with many neighbours
never becomes one row: steps are a minimum per vertex, joined back. When two rounds leave the
same links, every vertex is tied to the least id of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import cut


def _least(both: DataFrame) -> DataFrame:
    """(u, m): each vertex with the least of itself and its neighbours; ``both`` has links in both directions."""
    return both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))


def large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """``links`` point from larger to smaller ids."""
    least = _least(links)
    tied = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (u, v) that isn't the least of its component."""
    # Once through the links themselves before anything of them is used twice.
    ordered = links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, before = cut(ordered), None
    while True:
        now = cut(small_star(large_star(now)))
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = state
