"""Quality rules as a bitmask ledger: measure once, store failures as bits, decide by versioned policies.

``ledger`` reads each text once and stores the measurements and, per rule, one bit that is set
where the rule fails. A policy is a mask of rules: a row passes if it shares no bit with it, so
policies and their ablations are bit operations on the ledger and never read a text again.

Words are maximal runs of bytes other than space and 0x09 to 0x0D. Measuring runs on the
UTF-8 bytes of many texts at once, in slices of bounded size; there is no shuffle.

Defined results: null and empty texts have measurements of 0 and fail ``short``; repeated rows
are rows of their own; an empty table gives an empty ledger; other columns are carried along,
unless they have the name of a measurement, which then replaces them. Words and windows of
words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from starloom.llm.common import SPACE, mix, sliced, span_hashes, sums_by, window_hashes, words

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letters", "n_upper", "n_marks",
)
#: Bit k is set where the k-th condition holds; the order is part of the format.
RULES = (
    ("short", "n_words < 50"),
    ("repeats", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "5 * n_symbols > n_words"),
    ("dup_lines", "100 * n_dup_lines > 60 * n_lines"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    ("shouting", "2 * n_upper > n_letters"),
    ("marks", "2 * n_marks > n_words"),
)
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}
#: Policies by version: the rules that reject.
POLICIES = {
    "base": ("short", "repeats"),
    "v1": ("short", "repeats", "symbols", "shouting"),
    "v2": ("short", "repeats", "symbols", "dup_lines", "word_length", "shouting", "marks"),
}

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_LETTER = _UPPER | np.isin(np.arange(256), np.arange(97, 123))
_MARK = np.isin(np.arange(256), list(b"!?"))


def mask(policy: str) -> int:
    return sum(BIT[r] for r in POLICIES[policy])


def repeated_words(hashes: np.ndarray, first: np.ndarray, window: int = 3) -> np.ndarray:
    """Per text, how many words are in windows that the text has twice or more."""
    keys = window_hashes(hashes, window)
    covered = np.zeros(len(hashes), bool)
    if len(keys):
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        own = text[: len(keys)] == text[window - 1 :]
        at = np.flatnonzero(own)
        keys = mix(keys[at] + mix(text[at].astype(np.uint64)))
        ordered = np.sort(keys)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(twice):
            place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
            hit = at[twice[place] == keys]
            for k in range(window):
                covered[hit + k] = True
    return sums_by(covered, first)


def line_counts(text: bytes) -> tuple[int, int]:
    """Lines that have a word, and how many of them equal an earlier one."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines), len(lines) - len(set(lines))


def measured(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    starts, ends, first = words(data, offsets)
    inside = ~SPACE[data]
    raw = data.tobytes()
    lines = np.array([line_counts(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], np.int64).reshape(-1, 2)
    return {
        "n_words": np.diff(first),
        "word_chars": sums_by(inside & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": sums_by(_SYMBOL[data], offsets),
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": repeated_words(span_hashes(data, starts, ends), first),
        "n_lines": lines[:, 0],
        "n_letters": sums_by(_LETTER[data], offsets),
        "n_upper": sums_by(_UPPER[data], offsets),
        "n_marks": sums_by(_MARK[data], offsets),
    }


def ledger(docs: DataFrame, rules=RULES) -> DataFrame:
    """The columns of ``docs`` but the text, the measurements, and ``failures``, one bit per failed rule."""
    kept = [f for f in docs.schema.fields if f.name not in ("text", "failures", *MEASURES)]
    schema = StructType([*kept, *(StructField(m, LongType()) for m in MEASURES)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in sliced(batches):
            found = measured(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(f.name) for f in kept), *(pa.array(found[m], pa.int64()) for m in MEASURES)],
                [f.name for f in schema.fields],
            )

    bits = F.lit(0).cast("long")
    for k, (_, condition) in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    columns = [*(f.name for f in kept), "text"]
    return docs.select(*columns).mapInArrow(work, schema).withColumn("failures", bits)


def passes(policy: str) -> Column:
    """Whether a row of the ledger passes a policy."""
    return F.col("failures").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: rows that fail it, rows that only it rejects, rows kept without it, and what else failed.

    The ledger is first counted by its bits, so that all rules are worked out on at most
    2^rules rows.
    """
    whole = mask(policy)
    counted = rows.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    inside = F.col("failures").bitwiseAND(F.lit(whole))
    of = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in POLICIES[policy]))
    return (
        counted.withColumn("inside", inside)
        .withColumn("of", F.explode(of))
        .groupBy("of.rule", "of.bit")
        .agg(
            F.sum(F.when(F.expr("inside & of.bit != 0"), F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.expr("inside = of.bit"), F.col("n")).otherwise(0)).alias("n_only_this"),
            F.sum(F.when(F.expr("inside & ~of.bit = 0"), F.col("n")).otherwise(0)).alias("n_kept_without"),
            F.bit_or(F.expr("case when inside & of.bit != 0 then inside & ~of.bit else 0L end")).alias("failed_with"),
        )
    )
