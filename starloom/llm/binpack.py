"""Sharding by best-fit decreasing: groups of equal texts, largest first, into the tightest shard that holds them.

All shards have one capacity, the mean load rounded up. Groups of one size are alike, so the
plan is made on the list of sizes: a run of equal groups enters the tightest open shard (found
in a sorted list of the room left) until it is full, then the next. Only this list, one row
per size class, is on the driver; which group goes where follows from its rank within its
class, and ranks come from counts per (class, part). Sizes above 2^10 are classed by their ten
leading bits, so there are at most some 16,000 classes up to 2^40 bytes, whatever the input.

Every group stays whole unless it is larger than a whole shard and so fits nowhere: that one is
divided into pieces of at most the capacity. What fits nowhere at the end goes to the shard
with most room.

Defined results: a null text counts as no bytes and its rows are a group; an empty text is the
group of no bytes too; repeated rows are rows of their own; equal sizes are ranked by group
key, rows of a group by doc_id; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import small
from starloom.session import cut

OVERHEAD = 16
#: Leading bits of a size that make its class; smaller sizes are classes of their own.
BITS = 10
#: Rows that one task ranks, about.
PART_ROWS = 50_000


def size_class(weight: str) -> Column:
    """The size rounded down to its leading bits."""
    low = f"cast(greatest(0, length(bin({weight})) - {BITS}) as int)"
    return F.expr(f"shiftleft(shiftright({weight}, {low}), {low})")


def plan(classes: list[tuple[int, int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """(size class, first rank, last rank, shard) runs from (class, groups, bytes), largest class first.

    The room left is kept sorted; the tightest shard that holds a group is a binary search away.
    """
    total = sum(b for _, _, b in classes)
    capacity = -(-total // shards) if shards else 0
    room = sorted((capacity, s) for s in range(shards))
    runs = []
    for size, groups, held in sorted(classes, reverse=True):
        mean = held / groups if groups else 0
        rank = 0
        while rank < groups:
            at = bisect.bisect_left(room, (mean, -1))
            # The tightest that fits; if none does, the one with most room takes one group.
            left, shard = room.pop(min(at, shards - 1))
            n = min(groups - rank, max(1, int(left // mean) if mean else groups))
            runs.append((size, rank, rank + n - 1, shard))
            rank += n
            bisect.insort(room, (left - n * mean, shard))
    return runs


def shard(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Per row: doc_id, size, text_crc32, group_key, shard, slot."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("group_key"),
    )
    groups = rows.groupBy("group_key", "size").agg(F.count(F.lit(1)).alias("copies"))
    totals = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    capacity = max(1, -(-totals[0] // shards))
    parts = max(1, -(-totals[1] // PART_ROWS))
    # Rows of one piece of a group that no shard holds: as many as fit, one at least.
    per_piece = F.when(
        F.col("size") * F.col("copies") > capacity, F.greatest(F.lit(1), F.floor(F.lit(capacity) / F.col("size")))
    ).otherwise(F.col("copies"))
    pieces = (
        groups.withColumn("per_piece", per_piece.cast("long"))
        .withColumn("piece", F.explode(F.expr("sequence(0L, (copies - 1) div per_piece)")))
        .withColumn("weight", F.least("per_piece", F.col("copies") - F.col("piece") * F.col("per_piece")) * F.col("size"))
        .withColumn("class", size_class("weight"))
        .withColumn("part", F.pmod(F.xxhash64("group_key", "piece"), F.lit(parts)))
    )
    counts = cut(pieces.groupBy("class", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("held")))
    listed = counts.groupBy("class").agg(F.sum("n"), F.sum("held")).collect()  # one row per size class
    runs = spark.createDataFrame(plan([tuple(r) for r in listed], shards), "class long, low long, high long, shard int")
    by_class = runs.groupBy("class").agg(F.collect_list(F.struct("low", "high", "shard")).alias("runs"))
    placed = (
        _ranked(pieces, counts, ["class"], ["group_key", "piece"])
        .join(F.broadcast(by_class), "class")
        .withColumn("shard", F.expr("filter(runs, r -> r.low <= rank and rank <= r.high)[0].shard"))
        .select("group_key", "size", "piece", "per_piece", "shard", (F.col("copies") > F.col("per_piece")).alias("divided"))
    )
    # Only rows of divided groups have to know their rank within the group.
    cuts = placed.where("divided").select("group_key", "size", "per_piece").distinct()
    parted = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
    whole = rows.join(placed.where("not divided").select("group_key", "size", "shard"), ["group_key", "size"])
    divided = parted.join(small(cuts), ["group_key", "size"])
    held = divided.groupBy("group_key", "part").agg(F.count(F.lit(1)).alias("n"))
    pieced = (
        _ranked(divided, held, ["group_key"], ["doc_id"])
        .withColumn("piece", F.expr("rank div per_piece"))
        .join(placed.where("divided").select("group_key", "size", "piece", "shard"), ["group_key", "size", "piece"])
    )
    columns = ["doc_id", "size", "text_crc32", "group_key", "shard"]
    sharded = cut(whole.select(columns).unionByName(pieced.select(columns)))
    parted = sharded.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
    slots = _ranked(parted, parted.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n")), ["shard"], ["doc_id"])
    return slots.select(*columns, F.col("rank").alias("slot"))


def _ranked(rows: DataFrame, counts: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds ``rank``, gapless from 0 within ``keys``: by a window within each part, plus the counts of the parts before."""
    before = counts.select(
        *keys, "part", (F.sum("n").over(Window.partitionBy(*keys).orderBy("part")) - F.col("n")).alias("before")
    )
    own = F.row_number().over(Window.partitionBy(*keys, "part").orderBy(*order)) - 1
    return (
        rows.withColumn("rank", own)
        .join(before, [*keys, "part"])
        .withColumn("rank", (F.col("rank") + F.col("before")).cast("long"))
        .drop("before")
    )
