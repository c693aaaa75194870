"""Removal of repeated word sequences by seed and extend.

A word goes if a window of ``WINDOW`` consecutive words covers it whose words also start
anywhere else, in the same document or another.

1. Seeds. The anchor of a window is its least word ``GRAM``-gram by a hash, the leftmost of
   equals. It depends on the window's words alone, so equal windows have equal anchors at equal
   places. Neighbouring windows share one: a run, one for about a dozen words.
2. Join. Anchors that occur once have no partner and end here. The others are joined with the
   count of their anchor, and members of one anchor whose whole runs are equal (same anchor, same
   words around it as far as the run reaches) are told at once: all their windows are repeats.
3. Extend. Of the rest, runs that are unlike all others of their anchor and one leading member of
   each set of equal runs are extended: by l words to the left and ``WINDOW - GRAM - l`` to the
   right of the anchor, for every l the run allows, which is one fingerprint each. Equal extensions
   are repeats. Members are never paired, so a group of any size costs its number of rows.
4. Neighbouring repeats grow together to maximal ones when they are cut out of their text.

Equality is that of two 64-bit fingerprints of the words. Texts are known by a fingerprint of all
their words (87 bits), so copies get one answer, and nothing depends on how rows are numbered.

Every exchange is by a fingerprint below an aggregation that combines before it or a join that
Spark splits where a key is hot. Runs that recur inside one text are one row, with their number.

Defined results: null texts have no words; texts of fewer than ``WINDOW`` words lose nothing;
every row is a document, rows that share a doc_id or have none as well, so a row repeated as a
whole is repeated elsewhere; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructField, StructType

from starloom.llm.common import fields, mix, powers, sliced, span_hashes, words
from starloom.session import cut

WINDOW = 35
GRAM = 8
#: Windows worked on at once.
STEP = 1 << 20
#: Rows in an Arrow batch that leaves a task, and bytes of text that are worked on together.
ROWS, TOGETHER = 50_000, 1 << 20

_OTHER = np.uint64(0xA0761D6478BD642F)
_COUNT = np.uint64(0xD6E8FEB86659FD93)
#: A run's place: 23 bits of the text's fingerprint, 32 of its first word, 8 of its number of windows.
_AT, _TAG = 8, 40


class Sums:
    """Fingerprints of any stretch of words, from sums of their hashes."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.n = len(hashes)
        self.total = np.zeros(self.n + 1, np.uint64)
        np.cumsum(hashes * powers(self.n), out=self.total[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.total[end] - self.total[begin]) * powers(self.n + 1, True)[begin]
        return mix(raw + (end - begin).astype(np.uint64) * _COUNT)


def second(hashes: np.ndarray) -> np.ndarray:
    """Word hashes for another, independent fingerprint."""
    return mix(hashes ^ _OTHER)


def runs_of(hashes: np.ndarray, first: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first window, number of windows, anchor, whole run) of every run; ``first`` are the texts' first words and the end."""
    width, parts = window - gram + 1, []
    text_end = np.repeat(first[1:], np.diff(first))
    for low in range(0, len(hashes), STEP):
        high = min(len(hashes), low + STEP + window - 1)
        size = high - low
        if size < window:
            break
        sums = Sums(hashes[low:high])
        place = np.arange(size - gram + 1)
        grams = sums.of(place, place + gram)
        least, have = (grams & np.uint64(0xFFFFFFFF00000000)) | place.astype(np.uint64), 1
        while have * 2 <= width:
            least, have = np.minimum(least[:-have], least[have:]), have * 2
        if width > have:
            least = np.minimum(least[: have - width], least[width - have :])
        starts = np.arange(min(STEP, len(least)))
        starts = starts[starts + low + window <= text_end[starts + low]]
        if not len(starts):
            continue
        anchor = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # A new anchor, or a gap between texts, begins a run.
        new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
        begin = starts[np.concatenate(([0], new))]
        count = starts[np.concatenate((new, [len(starts)])) - 1] - begin + 1
        anchor = anchor[np.concatenate(([0], new))]
        whole = sums.of(begin, begin + count + window - 1) ^ mix((anchor - begin).astype(np.uint64) + _OTHER)
        parts.append((begin + low, count, grams[anchor], whole))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def texts_of(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two fingerprints of every text's words, the second of 23 bits."""
    key = Sums(hashes).of(first[:-1], first[1:]) if len(hashes) else mix(np.diff(first).astype(np.uint64))
    tag = Sums(second(hashes)).of(first[:-1], first[1:]) if len(hashes) else key
    return key.view(np.int64), (tag >> np.uint64(41)).astype(np.int64)


def first_of_equals(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that are the first of their equals, how many these are, and for each row whether there are others."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
    at = np.flatnonzero(new)
    counts = np.diff(np.concatenate((at, [len(order)])))
    several = np.zeros(len(order), bool)
    several[order] = np.repeat(counts, counts) > 1
    return order[at], counts, several


def turned(key: str) -> Column:
    """Another expression for a key. Spark splits a hot key of a join only if both sides are dealt for it; groups of the key itself would be joined as they lie."""
    return F.bitwise_not(key).alias("turned")


def regrouped(groups: DataFrame, key: str) -> DataFrame:
    """Groups of the turned key, by the key."""
    return groups.withColumn(key, F.bitwise_not("turned")).drop("turned")


def batches_of(columns: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(columns[0]), ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c[k : k + ROWS]) for c in columns], names)


def seeds(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(key, place, anchor, whole, n): the runs of every text, those that recur in it once."""
    schema = StructType(fields("key place anchor whole n"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in sliced(batches, limit=TOGETHER):
            starts, ends, first = words(data, offsets)
            hashes = span_hashes(data, starts, ends)
            begin, count, anchor, whole = runs_of(hashes, first, window, gram)
            if not len(begin):
                continue
            key, tag = texts_of(hashes, first)
            text = np.searchsorted(first, begin, "right") - 1
            pick, n, _ = first_of_equals(text, anchor, whole)
            text, begin, count = text[pick], begin[pick], count[pick]
            place = (tag[text] << _TAG) | ((begin - first[text]) << _AT) | count
            columns = [key[text], place, anchor[pick].view(np.int64), whole[pick].view(np.int64), n.astype(np.int64)]
            yield from batches_of(columns, schema.fieldNames())

    return docs.select("text").mapInArrow(work, schema)


def held(docs: DataFrame) -> DataFrame:
    """(doc_id, key, tag, n_words, zipped): texts as they travel, their words parted by one space."""
    # Keys that can't be null need no filter before an inner join, so it reads the same exchange as an outer one.
    keys = [StructField(name, LongType(), False) for name in ("key", "tag")]
    schema = StructType([*fields("doc_id"), *keys, *fields("n_words"), *fields(zipped=BinaryType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=5)
        for part, data, offsets in sliced(batches, limit=TOGETHER):
            starts, ends, first = words(data, offsets)
            key, tag = texts_of(span_hashes(data, starts, ends), first)
            raw = data.tobytes()
            rows = [press.compress(b" ".join(raw[a:b].split())) for a, b in zip(offsets[:-1], offsets[1:])]
            columns = [part.column("doc_id"), *map(pa.array, (key, tag, np.diff(first))), pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, schema)


def opened(batch: pa.RecordBatch, unzip: zstandard.ZstdDecompressor) -> Iterator[tuple[int, bytes, np.ndarray | None]]:
    """(row, text, spans) of a batch of ``held`` texts, one at a time."""
    spans = batch.column("spans")
    for k, zipped in enumerate(batch.column("zipped")):
        yield k, unzip.decompress(zipped.as_py()), np.array(spans[k].as_py(), np.int64) if spans[k].is_valid else None


def answers(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(key, tag, spans) of texts with an anchor that occurs again; a span's lowest bits: repeated, to be extended, recurs."""
    runs = seeds(docs, window, gram)
    often = regrouped(runs.groupBy(turned("anchor")).agg(F.sum("n").alias("of_anchor")).where("of_anchor > 1"), "anchor")
    # Another expression than the anchor, so that equal runs are brought together anew and a hot anchor is not.
    met = runs.join(often, "anchor").select("key", "place", "n", "of_anchor", "whole", F.expr("anchor ^ whole").alias("side"))
    equal = regrouped(met.groupBy(turned("side"), "whole").agg(F.sum("n").alias("of_run"), F.min("key").alias("lead")), "side")
    rows = met.join(equal, ["side", "whole"]).select(
        "key",
        F.shiftright("place", _TAG).alias("tag"),
        (
            F.shiftleft(F.col("place").bitwiseAND(F.lit((1 << _TAG) - 1)), 3)
            + F.when(F.col("of_run") > 1, 4).otherwise(0)
            + F.when((F.col("of_run") == 1) | ((F.col("of_run") < F.col("of_anchor")) & (F.col("key") == F.col("lead"))), 2).otherwise(0)
            + F.when(F.col("n") > 1, 1).otherwise(0)
        ).alias("span"),
    )
    return rows.groupBy("key", "tag").agg(F.collect_set("span").alias("spans"))


def extended(texts: DataFrame, told: DataFrame, window: int) -> DataFrame:
    """(key, tag, spans): windows of runs unlike the others of their anchor that occur elsewhere all the same."""
    schema = StructType([*fields("one two key place"), *fields(leads=BooleanType())])
    asked = told.select("key", "tag", F.filter("spans", lambda s: s.bitwiseAND(F.lit(2)) != 0).alias("spans")).where(F.size("spans") > 0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            keys, tags = (batch.column(c).to_numpy() for c in ("key", "tag"))
            for row, text, spans in opened(batch, unzip):
                data = np.frombuffer(text, np.uint8)
                starts, ends, _ = words(data, np.array([0, len(data)]))
                hashes = span_hashes(data, starts, ends)
                begin, count = spans >> (_AT + 3), (spans >> 3) & 0xFF
                inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                start = np.repeat(begin, count) + inner
                one, two = (Sums(h).of(start, start + window).view(np.int64) for h in (hashes, second(hashes)))
                place = (tags[row] << _TAG) | (start << _AT) | 1
                columns = [one, two, np.full(len(one), keys[row]), place, np.repeat(spans & 4 > 0, count)]
                yield from batches_of(columns, schema.fieldNames())

    # All columns of the texts, as later, so that both joins read the same exchange.
    windows = texts.join(asked, ["key", "tag"]).mapInArrow(work, schema)
    # An unequal run stands once in the whole corpus; leading ones, repeated as a whole, come once for every copy of their text.
    again = windows.groupBy(turned("one"), "two").agg(F.count(F.lit(1)).alias("n"), F.max("leads").alias("leads")).where("n > 1 or leads")
    found = windows.where("not leads").join(regrouped(again, "one").select("one", "two"), ["one", "two"]).select(
        "key",
        F.shiftright("place", _TAG).alias("tag"),
        (F.shiftleft(F.col("place").bitwiseAND(F.lit((1 << _TAG) - 1)), 3) + 4).alias("span"),
    )
    return found.groupBy("key", "tag").agg(F.collect_list("span").alias("spans"))


def covered(text: bytes, n_words: int, spans: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Which words are inside a repeated window."""
    begin, end = spans >> (_AT + 3), (spans >> (_AT + 3)) + ((spans >> 3) & 0xFF) + window - 1
    if (spans & 1).any():
        # Runs that recur in this text came as one row: here are all their places.
        data = np.frombuffer(text, np.uint8)
        starts, ends, first = words(data, np.array([0, len(data)]))
        at, count, anchor, whole = runs_of(span_hashes(data, starts, ends), first, window, gram)
        _, _, several = first_of_equals(anchor, whole)
        begin = np.concatenate((begin, at[several]))
        end = np.concatenate((end, (at + count + window - 1)[several]))
    steps = np.zeros(n_words + 1, np.int64)
    np.add.at(steps, begin, 1)
    np.add.at(steps, end, -1)
    return np.cumsum(steps[:-1]) > 0


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, texts: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, and the words that are left if asked for."""
    out = StructType(fields("doc_id n_words n_removed", "kept_sha256 text" if texts else "kept_sha256"))
    carried = held(docs)
    told = cut(answers(docs, window, gram))
    repeated = told.select("key", "tag", F.filter("spans", lambda s: s.bitwiseAND(F.lit(4)) != 0).alias("spans"))
    both = repeated.unionByName(extended(carried, told, window)).groupBy(turned("key"), "tag")
    spans = regrouped(both.agg(F.flatten(F.collect_list("spans")).alias("spans")), "key")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            counts = batch.column("n_words").to_pylist()
            removed, hashes, left = [], [], []
            for row, text, found in opened(batch, unzip):
                n = 0
                if found is not None and len(found):
                    gone = covered(text, counts[row], found, window, gram)
                    n = int(gone.sum())
                    text = b" ".join(w for w, g in zip(text.split(b" "), gone.tolist()) if not g) if n < counts[row] else b""
                removed.append(n)
                hashes.append(hashlib.sha256(text).hexdigest())
                if texts:
                    left.append(text.decode())
            columns = [batch.column("doc_id"), batch.column("n_words"), pa.array(removed, pa.int64()), pa.array(hashes, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(left, pa.string())] if texts else []), out.fieldNames())

    return carried.join(spans, ["key", "tag"], "left").mapInArrow(work, out)
