"""The trie of conversations' common beginnings: union-find over sorted-neighbour LCP edges.

A conversation is a path of turns; every distinct beginning of d turns is a node of depth d.

1. A turn becomes a unit of 24 bytes: the MD5 of role and text, and the text's size. Paths are
   sorted as bytes over range partitions, so conversations with a common beginning are neighbours;
   equal paths go on by conv_id, so a group of copies of any size is split.
2. In a partition, neighbours are tied by an edge as deep as their common beginning. Edges are
   taken in descending depth; union-find ties the components of both ends, and where two meet,
   the node of that depth is made (or joined, if one of them is it). A component that meets a
   shallower edge is contracted: its nodes down to there have the same members and are a chain.
3. Nodes whose members include neither the first nor the last path of the partition are complete.
   The others are beginnings of these two paths, the partition's spines: they alone, with what
   hangs on them summed up, are merged across boundaries by a fingerprint of their path. What
   a merged node adds to those above it goes up one spine that it is on.

On the driver there are the sizes of the table alone; spines are a table of twice the partitions
times the length of a path. The digest of a node's members is a stream over them in order, by one
task if they are over several partitions, in rows of at most ``CHUNK`` ids; sums are not.

Defined results: turns are ordered by turn, null first, ties by the MD5 of role and text; null
role or text is empty; rows without conv_id belong to no conversation; an empty table gives
no nodes, not even the root; extra columns are ignored. A path is one value, as a text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

from starloom.llm.common import fields, packed
from starloom.session import cut

#: Bytes of a unit.
UNIT = 24
#: Turns and paths in a partition, about.
PART = 250_000
#: Ids in a row of a digest that is put together across partitions.
CHUNK = 400
#: Conversations that share openings in ``rebuilt``, and a bound of how many turns.
FAMILY, OPENING = 5, 9
_EMPTY = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, units): every conversation's units in order, as hexadecimal text."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    said = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    unit = F.concat(said, F.lpad(F.hex(F.octet_length(text)), 16, "0"))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", unit.alias("unit"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "unit")))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda x: x["unit"]).alias("units"))


def paths(lists: DataFrame) -> DataFrame:
    """(conv_id, path) of (conv_id, units)."""
    return lists.select("conv_id", F.unhex(F.array_join("units", "")).alias("path"))


def rebuilt(lists: DataFrame) -> DataFrame:
    """(conv_id, units): the first h turns of the family's first conversation, then the own ones after the first h."""
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    opening = lists.where(base == F.col("conv_id")).select(F.col("conv_id").alias("base"), F.slice("units", 1, OPENING).alias("opening"))
    h = (F.crc32(F.col("conv_id").cast("string")) % OPENING).cast("int")
    rows = lists.withColumn("base", base).join(opening, "base", "left").withColumn("h", h)
    first = F.coalesce("opening", F.array().cast("array<string>"))
    return rows.select("conv_id", F.concat(F.slice(first, F.lit(1), F.col("h")), F.slice("units", F.col("h") + 1, F.size("units"))).alias("units"))


def neighbours(flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """How many units each path and the next one have in common at their beginning."""
    most = np.minimum(length[:-1], length[1:])
    at = np.cumsum(most) - most
    inner = np.arange(most.sum()) - np.repeat(at, most)
    a, b = np.repeat(begin[:-1], most) + inner, np.repeat(begin[1:], most) + inner
    unlike = np.where((flat[a] == flat[b]).all(axis=1), np.iinfo(np.int64).max, inner)
    out = most.copy()
    have = np.flatnonzero(most)
    if len(have):
        out[have] = np.minimum(most[have], np.minimum.reduceat(unlike, at[have]))
    return out


class Forest:
    """Nodes of sorted paths, as chains of nodes with the same members.

    A chain covers the depths over ``above`` up to ``depth`` for the paths ``low`` to ``high``. What
    it sums up (``children``, ``leaves``, ``saved``) comes from complete nodes below its deepest one.
    """

    def __init__(self, conv: np.ndarray, begin: np.ndarray, length: np.ndarray, flat: np.ndarray) -> None:
        n = self.n = len(conv)
        self.begin = begin
        # Sizes summed up: what a chain's turns hold is a difference.
        self.sizes = np.concatenate(([0], np.cumsum(flat[:, 2].astype(np.int64)))).tolist()
        self.names = "low high above depth count least children leaves saved ends_low ends_high".split()
        self.chains: list[tuple] = []
        self.parent: list[int] = []
        # The open node of each component, held at the component's root.
        self.up = list(range(n))
        self.low, self.high = list(range(n)), list(range(1, n + 1))
        self.depth, self.count, self.least = length.tolist(), [1] * n, conv.tolist()
        self.children, self.leaves, self.saved = [0] * n, [0] * n, [0] * n
        self.ends = [(k, k + 1) for k in range(n)]
        self.kids: list[list[int]] = [[] for _ in range(n)]
        common = neighbours(flat, begin, length)
        for edge in np.argsort(-common, kind="stable").tolist():
            self._tie(self._root(edge), self._root(edge + 1), int(common[edge]))
        self._contract(self._root(0), -1)

    def _root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def complete(self, low: int, high: int) -> bool:
        return low > 0 and high < self.n

    def _contract(self, x: int, above: int) -> None:
        """Closes the open node of a component and opens one of depth ``above`` over it."""
        low, high, depth, count = self.low[x], self.high[x], self.depth[x], self.count[x]
        chain = len(self.chains)
        self.chains.append((low, high, above, depth, count, self.least[x], self.children[x], self.leaves[x], self.saved[x], *self.ends[x]))
        self.parent.append(-1)
        for kid in self.kids[x]:
            self.parent[kid] = chain
        if self.complete(low, high):
            at = int(self.begin[low])
            self.leaves[x] = self.leaves[x] if self.children[x] else 1
            self.saved[x] += (count - 1) * (self.sizes[at + depth] - self.sizes[at + above])
            self.children[x] = 1
        else:
            self.children[x] = 0
        self.depth[x], self.kids[x], self.ends[x] = above, [chain], (0, 0)

    def _tie(self, a: int, b: int, depth: int) -> None:
        for x in (a, b):
            if self.depth[x] > depth:
                self._contract(x, depth)
        if self.count[a] < self.count[b]:
            a, b = b, a
        self.up[b] = a
        self.low[a], self.high[a] = min(self.low[a], self.low[b]), max(self.high[a], self.high[b])
        self.least[a] = min(self.least[a], self.least[b])
        for values in (self.count, self.children, self.leaves, self.saved):
            values[a] += values[b]
        if len(self.kids[a]) < len(self.kids[b]):
            self.kids[a], self.kids[b] = self.kids[b], self.kids[a]
        self.kids[a] += self.kids[b]
        self.kids[b] = []
        (i, j), (k, m) = self.ends[a], self.ends[b]
        self.ends[a] = (k, m) if i == j else (i, j) if k == m else (min(i, k), max(j, m))


COLUMNS = (
    "kind part side depth conv_id parent_conv_id n_convs n_children n_leaves saved_tokens n_bytes seq".split()
    + "ends key parent".split()
)
#: Rows of a partition: complete nodes, complete nodes below a spine, spine nodes, parts of spine nodes' ends.
COMPLETE, HANGING, SPINE, ENDS = range(4)


def _ids(conv: np.ndarray, low: int, high: int) -> str:
    return ",".join(map(str, conv[low:high].tolist()))


def _part(part: int, conv: np.ndarray, begin: np.ndarray, length: np.ndarray, data: bytes) -> Iterator[dict[str, list]]:
    """The rows of a partition's sorted paths, as columns."""
    flat = (np.frombuffer(data, ">u8") if data else np.zeros(0, ">u8")).reshape(-1, 3)
    forest = Forest(conv, begin, length, flat)
    sizes, n = np.array(forest.sizes), forest.n
    c = {name: np.array(x, np.int64) for name, x in zip(forest.names, zip(*forest.chains))}
    parent = np.array(forest.parent)
    complete = (c["low"] > 0) & (c["high"] < n)

    # Complete chains, node by node.
    pick = np.flatnonzero(complete)
    if len(pick):
        count = (c["depth"] - c["above"])[pick]
        chain = np.repeat(pick, count)
        depth = c["above"][chain] + 1 + np.arange(len(chain)) - np.repeat(np.cumsum(count) - count, count)
        bottom, top = depth == c["depth"][chain], depth == c["above"][chain] + 1
        above = parent[chain]
        hanging = top & ~complete[above]
        at = begin[c["low"][chain]]
        known = np.where(top, c["least"][above], c["least"][chain])
        ends = [_EMPTY] * len(chain)
        for k in np.flatnonzero(bottom & (c["ends_high"] > c["ends_low"])[chain]).tolist():
            x = chain[k]
            ends[k] = hashlib.sha256(_ids(conv, c["ends_low"][x], c["ends_high"][x]).encode()).hexdigest()
        yield {
            "kind": np.where(hanging, HANGING, COMPLETE), "part": np.full(len(chain), part),
            # A spine parent is known by the side it is on; both sides share what holds all paths.
            "side": (c["low"][above] > 0).astype(np.int64), "depth": depth, "conv_id": c["least"][chain],
            "parent_conv_id": pa.array(known, mask=hanging), "n_convs": c["count"][chain],
            "n_children": np.where(bottom, c["children"][chain], 1),
            "n_leaves": np.where(c["children"][chain] > 0, c["leaves"][chain], 1),
            "saved_tokens": c["saved"][chain] + (c["count"][chain] - 1) * (sizes[at + c["depth"][chain]] - sizes[at + depth - 1]),
            "ends": ends,
        }

    # Spines: the nodes of the first path, then those of the last one.
    rows: list[dict] = []
    for side, path in ((0, 0), (1, n - 1))[: min(n, 2)]:
        digest, keys = hashlib.blake2b(digest_size=16), []
        at = int(begin[path])
        for k in range(int(length[path]) + 1):
            keys.append(digest.digest())
            digest.update(data[(at + k) * UNIT : (at + k + 1) * UNIT])
        for x in np.flatnonzero((c["low"] <= path) & (c["high"] > path) & ~complete).tolist():
            own = (c["low"][x] == 0) == (side == 0)
            for k in range(int(c["above"][x]) + 1, int(c["depth"][x]) + 1):
                bottom = k == c["depth"][x]
                row = {"kind": SPINE, "part": part, "side": side, "depth": k, "key": keys[k], "parent": keys[k - 1] if k else None}
                row["n_bytes"] = int(sizes[at + k] - sizes[at + k - 1]) if k else 0
                values = ("least", "count", "children", "leaves", "saved") if own else ()
                names = ("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
                rows.append(row | {name: int(c[v][x]) for name, v in zip(names, values) if bottom or v != "children"})
                if own and bottom:
                    for seq, low in enumerate(range(int(c["ends_low"][x]), int(c["ends_high"][x]), CHUNK)):
                        ids = _ids(conv, low, min(low + CHUNK, int(c["ends_high"][x])))
                        rows.append({"kind": ENDS, "part": part, "seq": seq, "key": keys[k], "ends": ids})
    yield {name: [r.get(name) for r in rows] for name in COLUMNS}


def _parts(sorted_paths: DataFrame) -> DataFrame:
    schema = StructType([*fields(" ".join(COLUMNS[:12]), "ends"), *fields(key=BinaryType(), parent=BinaryType())])
    kinds = [pa.int64()] * 12 + [pa.string(), pa.binary(), pa.binary()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, length, data = [], [], []
        for batch in batches:
            raw, offsets = packed(batch.column("path").cast(pa.large_binary()))
            conv.append(batch.column("conv_id").to_numpy())
            length.append(np.diff(offsets) // UNIT)
            data.append(raw[offsets[0] : offsets[-1]].tobytes())
        if not conv or not sum(map(len, conv)):
            return
        conv, length = np.concatenate(conv), np.concatenate(length)
        for columns in _part(TaskContext.get().partitionId(), conv, np.cumsum(length) - length, length, b"".join(data)):
            size = len(columns["kind"])
            arrays = [
                (x if isinstance(x, pa.Array) else pa.array(x, kind)) if (x := columns.get(name)) is not None else pa.nulls(size, kind)
                for name, kind in zip(COLUMNS, kinds)
            ]
            whole = pa.RecordBatch.from_arrays(arrays, COLUMNS)
            for k in range(0, size, 50_000):
                yield whole.slice(k, 50_000)

    return sorted_paths.mapInArrow(work, schema)


def _digests(ends: DataFrame) -> DataFrame:
    """(key, ends): the digest over all parts of a node's ends, in order."""
    schema = StructType([*fields(key=BinaryType()), *fields(strings="ends")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends"])
        for batch in batches:
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
                if key != now:
                    if now is not None:
                        yield row()
                    now, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(f",{ids}".encode())
        if now is not None:
            yield row()

    ordered = ends.select("key", "part", "seq", "ends").repartition("key").sortWithinPartitions("key", "part", "seq")
    return ordered.mapInArrow(work, schema)


def nodes(table: DataFrame) -> DataFrame:
    """The nodes of (conv_id, path): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = table.sparkSession
    table = cut(table)
    units, rows = table.agg(F.sum(F.octet_length("path")), F.count(F.lit(1))).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ((units or 0) // UNIT + rows) // PART + 1)
    ordered = table.repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    made = cut(_parts(ordered))

    spine = made.where(F.col("kind") == SPINE)
    chain = F.col("part") * 2 + F.col("side")
    merged = spine.groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.min(chain).alias("owner"), F.max("parent").alias("parent"), F.max("n_bytes").alias("n_bytes"),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    inner = merged.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_spine"))
    children = F.col("n_children") + F.coalesce("n_spine", F.lit(0))
    merged = cut(merged.join(inner, "key", "left").withColumn("n_children", children).drop("n_spine"))
    # A merged node's own part goes up the first spine it is on; there, these nodes are the deepest ones.
    own = spine.select("key", chain.alias("chain"), "part", "side", "depth").join(
        merged.select("key", "conv_id", "owner", "n_bytes", "n_convs", "n_children"), "key"
    )
    mine = F.col("chain") == F.col("owner")
    up = Window.partitionBy("chain").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    own = cut(own.select(
        "key", "part", "side", "depth", "conv_id",
        F.sum(F.when(mine & (F.col("n_children") == 0), 1).otherwise(0)).over(up).alias("leaves"),
        F.sum(F.when(mine, (F.col("n_convs") - 1) * F.col("n_bytes")).otherwise(0)).over(up).alias("saved"),
    ))
    sums = own.groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    parents = merged.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    spines = merged.join(sums, "key").join(parents, "parent", "left").join(_digests(made.where(F.col("kind") == ENDS)), "key", "left")

    plain = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256")]
    hanging = made.where(F.col("kind") == HANGING).withColumn("above", F.col("depth") - 1).drop("parent_conv_id")
    above = own.select("part", "side", F.col("depth").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    out = made.where(F.col("kind") == COMPLETE).select(*plain)
    out = out.unionByName(hanging.join(above, ["part", "side", "above"]).select(*plain))
    return out.unionByName(
        spines.select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("n_leaves") + F.col("leaves")).alias("n_leaves"),
            (F.col("saved_tokens") + F.col("saved")).alias("saved_tokens"), F.coalesce("ends", F.lit(_EMPTY)).alias("ends_sha256"),
        )
    )
