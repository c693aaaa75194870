"""URL filter: variable-order Markov models of accepted and rejected URLs, compared by likelihood.

Rules on host and path decide the URLs they cover and label the examples: URLs that a rule
allows train one character model, those it blocks the other. A character's probability
blends the orders 0 to 2, each weighed by the number of different followers of its context
(Witten and Bell), above a uniform floor. The score is the mean log likelihood ratio per
character; the cut is the one that parts the labelled URLs best.

The alphabet has 40 classes, so a model has at most 40^3 entries whatever the input, and
travels as one constant array. Scoring is a fold over the characters inside the row: no
shuffle, no Python.

Defined results: null or no ``://`` gives empty host and path, no rule and the verdict of an
empty string (allow, as is everything if there are no examples of both kinds); rows that
repeat are judged each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (host suffix, path prefix, verdict); fixed values of the contract.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789./-"
SIZE = len(LETTERS) + 1
ORDER = 3
#: Resolution of the histogram on which the cut is chosen.
BIN = 0.02


def parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a URL."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(
        F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null if none fits."""
    name = verdict = None
    for suffix, prefix, kind in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(prefix)
        name = F.when(fits, suffix + prefix) if name is None else name.when(fits, suffix + prefix)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return name, verdict


def with_codes(urls: DataFrame) -> DataFrame:
    """Adds ``_codes``: every character of host and path as a number with the two before it."""
    symbols = F.expr(
        "concat(array(0, 0), transform(filter(split(concat(host, lower(path)), ''), c -> c != ''),"
        f" c -> locate(c, '{LETTERS}')))"
    )
    codes = F.expr(
        "if(size(_symbols) > 2, transform(sequence(2, size(_symbols) - 1),"
        f" i -> (_symbols[i - 2] * {SIZE} + _symbols[i - 1]) * {SIZE} + _symbols[i]), array())"
    )
    return urls.withColumn("_symbols", symbols).withColumn("_codes", codes).drop("_symbols")


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Blended log probabilities from counts by (two before, one before, character)."""
    below = np.full(SIZE, 1.0 / SIZE)
    for order in range(ORDER):
        level = counts.sum(axis=tuple(range(ORDER - 1 - order))) if order < ORDER - 1 else counts
        followers = (level > 0).sum(axis=-1, keepdims=True)
        total = level.sum(axis=-1, keepdims=True)
        below = np.where(total > 0, (level + followers * below) / np.maximum(total + followers, 1), below)
    return np.log(below)


def train(labelled: DataFrame) -> np.ndarray | None:
    """Log ratio, accepted over rejected, of each of the 40^3 codes; None without both kinds."""
    rows = (
        labelled.select("verdict", F.explode("_codes").alias("code"))
        .groupBy("code")
        .agg(F.count_if(F.col("verdict") == "allow").alias("yes"), F.count_if(F.col("verdict") == "block").alias("no"))
        .collect()  # at most 40^3 rows
    )
    counts = np.zeros((2, SIZE**ORDER))
    for code, yes, no in rows:
        counts[:, code] = yes, no
    if not counts.sum(axis=1).all():
        return None
    shaped = counts.reshape((2,) + (SIZE,) * ORDER)
    return (log_probabilities(shaped[0]) - log_probabilities(shaped[1])).ravel()


def score(ratios: np.ndarray) -> Column:
    """Mean log ratio per character; 0 for an empty string."""
    # A constant array: folded once when the plan is optimized.
    text = json.dumps([round(float(x), 6) for x in ratios])
    table = f"from_json('{text}', 'array<double>')"
    return F.expr(f"aggregate(_codes, 0D, (a, c) -> a + {table}[c]) / greatest(size(_codes), 1)")


def best_cut(scored: DataFrame) -> float:
    """The cut with the highest sum of both kinds' shares on their own side."""
    bins = (
        scored.groupBy(F.floor(F.greatest(F.lit(-10.0), F.least(F.lit(10.0), "score")) / BIN).alias("bin"))
        .agg(F.count_if(F.col("verdict") == "allow").alias("yes"), F.count_if(F.col("verdict") == "block").alias("no"))
        .orderBy("bin")
        .collect()  # at most 20 / BIN rows
    )
    yes, no = sum(r["yes"] for r in bins), sum(r["no"] for r in bins)
    below_yes = below_no = 0
    best, cut, last = -math.inf, 0.0, None
    for r in bins:
        right = (yes - below_yes) / max(yes, 1) + below_no / max(no, 1)
        if right > best:
            # In the middle of the gap below.
            edge = r["bin"] * BIN
            best, cut = right, edge if last is None else (last + edge) / 2
        last = (r["bin"] + 1) * BIN
        below_yes, below_no = below_yes + r["yes"], below_no + r["no"]
    return cut


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, score (null where a rule decides)."""
    host, path = parts(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = split.select("*", rule.alias("rule"), verdict.alias("verdict"))
    coded = with_codes(ruled)
    labelled = coded.where(F.col("verdict").isNotNull())
    ratios = train(labelled)
    if ratios is None:
        return ruled.select(
            "page_id", "host", "path", "rule",
            F.coalesce("verdict", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("score"),
        )
    cut = best_cut(labelled.withColumn("score", score(ratios)))
    own = F.when(F.col("rule").isNull(), score(ratios))
    return (
        coded.withColumn("score", own)
        .withColumn("verdict", F.coalesce("verdict", F.when(F.col("score") >= cut, "allow").otherwise("block")))
        .select("page_id", "host", "path", "rule", "verdict", "score")
    )
