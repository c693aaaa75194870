"""What the operators share: packed texts, words and their hashes, and sizes checked before a broadcast.

Texts reach Python as Arrow batches and are handled as one array of UTF-8 bytes with
offsets, in slices of bounded size, so that no batch decides how much memory is used.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType

#: The bytes that part words: space and 0x09 to 0x0D.
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)
#: Bytes of text that one slice holds, unless a single text is longer.
SLICE = 4 << 20
#: Bytes whose hashes are worked out together; they take 8 bytes each in every array.
BLOCK = 1 << 18
#: Bytes of rows that Spark sends to a task's Python at once; both sides keep a batch of them in memory.
BATCH = 4 << 20
#: Rows of 8 to 16 bytes up to which a measured side is broadcast.
BROADCAST_ROWS = 1_000_000

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row's begin and end; null has none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), ends


def joined(column: pa.Array) -> np.ndarray:
    """The bytes of all rows of a column, one after the other."""
    data, ends = packed(column)
    return data[ends[0] : ends[-1]]


def slices(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer text is a range of its own."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end
        row = end


def sliced(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE) -> Iterator[tuple]:
    """(part of a batch, its bytes, its offsets from 0) for all batches."""
    for batch in batches:
        data, offsets = packed(batch.column(text))
        for a, b in slices(offsets, limit):
            yield batch.slice(a, b - a), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words before each text (and in all)."""
    inside = ~SPACE[data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers, modulo 2^64, of the base of the rolling hash or of its inverse."""
    have = _POWERS.get(inverse)
    if have is None or len(have) < n:
        step = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        have = np.full(max(n, 2 * BLOCK), step, np.uint64)
        have[0] = 1
        _POWERS[inverse] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every span; starts ascend. Prefix sums make it one pass."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        to = max(at + 1, int(np.searchsorted(starts, low + BLOCK)))
        high = int(ends[at:to].max())
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * powers(high - low), out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        raw = (sums[e] - sums[s]) * powers(high - low, True)[s]
        out[at:to] = mix(raw + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        at = to
    return out


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive values; empty if there are fewer."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0xFF51AFD7ED558CCD) + hashes[k : k + count])
    return out


def sums_by(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (small numbers or booleans) between consecutive offsets."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:], dtype=np.int64)
    return np.diff(total[offsets])


def spans_of(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all spans, one after the other, and where each ends."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat((begin - (ends - size)).astype(np.int32), size) + np.arange(total, dtype=np.int32)], ends


def same_texts(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Which texts are equal on both sides; the ends are offsets that begin with 0."""
    same = np.diff(a_ends) == np.diff(b_ends)
    if same.all():
        same[np.searchsorted(a_ends[1:], np.flatnonzero(a != b), "right")] = False
    else:
        for k in np.flatnonzero(same).tolist():
            same[k] = np.array_equal(a[a_ends[k] : a_ends[k + 1]], b[b_ends[k] : b_ends[k + 1]])
    return same


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it was counted to have at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` that gives its memory back at its end: a process serves many tasks and keeps what it once had."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform.startswith("linux") else None
        if trim:
            trim(0)

    return tidied


def mapped(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType) -> DataFrame:
    """``df`` through ``work``, tidied, in batches of about ``BATCH`` bytes.

    Counted by rows alone, a batch of texts has any size, and the executor holds it outside its heap, up to
    twice as large. A result is planned when it is read, so the setting stays in the session; a user's own is left.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_BYTES, None) is None:
        conf.set(_BATCH_BYTES, str(BATCH))
    return df.mapInArrow(tidy(work), schema)


def fields(longs: str = "", strings: str = "", **more: DataType) -> list[StructField]:
    """Fields by name: 64-bit numbers, strings, then any others."""
    named = [(n, LongType()) for n in longs.split()] + [(n, StringType()) for n in strings.split()]
    return [StructField(n, kind) for n, kind in [*named, *more.items()]]
