"""The trie of conversations against a plain one, over one and many partitions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from starloom.llm import prefix_trie
from starloom.llm.queries import ORACLES, QUERIES

CONV = "conv_id long, turn long, role string, text string, depth long, units string, path string"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], CONV)


def lists_of(rows):
    said = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            said[c].append((turn is not None, turn or 0, tie, role, text))
    return {c: [x[3:] for x in sorted(v)] for c, v in said.items()}


def rebuilt(lists):
    out = {}
    for c, own in lists.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = lists.get(c - c % 5, [])[:h] + own[h:]
    return out


def plain(lists):
    members = defaultdict(list)
    for c, path in sorted(lists.items()):
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in cs if len(lists[c]) == len(p))
        parent = members[p[:-1]][0] if p else None
        out.append((cs[0], len(p), parent, len(cs), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def found(df):
    assert df.columns == "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return Counter(tuple(r) for r in df.collect())


def cases():
    r = random.Random(4)
    rows = []
    for c in range(160):
        for turn in range(r.randrange(12)):
            rows.append((c, turn, "user" if turn % 2 else "bot", r.choice("aéb漢")))
    # Copies in families of their own, one the beginning of another, a long one, one with nothing but the base's turns.
    for c in range(200, 260):
        rows += [(c, t, "user", f"same{t}") for t in range(12 if c % 3 else 14)]
    rows += [(300, t, "user", f"long{t}") for t in range(600)] + [(301, 0, None, None), (302, None, "user", "first"), (302, 0, "user", "second")]
    rows += [(302, 0, "user", "tie"), (302, 0, "user", "tie"), (303, 0, "", ""), (None, 0, "user", "nobody"), (7, None, None, "x")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_against_a_plain_trie(spark, parts, monkeypatch):
    rows = cases()
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    try:
        lists = prefix_trie.turns(table_of(spark, rows).repartition(4))
        assert found(prefix_trie.nodes(prefix_trie.paths(lists))) == plain(lists_of(rows))
        assert found(prefix_trie.nodes(prefix_trie.paths(prefix_trie.rebuilt(lists)))) == plain(rebuilt(lists_of(rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_copies_over_many_partitions(spark):
    rows = [(c, t, "user", f"same{t}") for c in range(3000) for t in range(3)] + [(5000 + c, 0, "user", f"x{c}") for c in range(20)]
    lists = prefix_trie.turns(table_of(spark, rows))
    assert found(prefix_trie.nodes(prefix_trie.paths(lists))) == plain(lists_of(rows))


@pytest.mark.parametrize("rows", [[], [(4, 0, "user", "one")], [(5, None, None, None)], [(None, 1, "user", "x")]])
def test_few_rows(spark, rows):
    lists = prefix_trie.turns(table_of(spark, rows))
    assert found(prefix_trie.nodes(prefix_trie.paths(prefix_trie.rebuilt(lists)))) == plain(rebuilt(lists_of(rows)))


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(x) for x in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op12_prefix_trie"](spark, sf)
    assert found(got) == plain(rebuilt(lists_of(rows)))
    assert compare(got, connect(sf), ORACLES["op12_prefix_trie"]) is None


def test_units_are_unambiguous(spark):
    rows = spark.createDataFrame([(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, None, "abc")], "conv_id long, turn long, role string, text string")
    assert prefix_trie.turns(rows).select(F.explode("units")).distinct().count() == 3
