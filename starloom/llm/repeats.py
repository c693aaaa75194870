"""Removal of repeated passages by a sparse, range-partitioned suffix array.

A byte goes if it is inside a string of ``WINDOW`` bytes that also starts in a document with a
smaller id. To find such strings not every suffix is sorted: a window is represented by the
suffix at its least 16-gram (by a hash, the leftmost of equals), which depends on nothing but
the window's bytes. So equal windows have equal anchors, and a run of neighbouring windows
shares one anchor; there is about one per 18 bytes.

1. Every task finds the anchors of its texts and, for each, the bytes of its run of windows.
   Runs that are equal within a task are told apart at once: all but those of the smallest
   document are repeats. So a passage of any number of copies leaves a task once.
2. Splitters from a sample part the anchors' suffixes by their leading bytes into buckets of
   about ``BUCKET``. Equal leading bytes meet in one bucket, so nothing has to be compared
   across a boundary.
3. In a bucket a multikey sort (eight bytes at a time, later ones among ties only) brings equal
   16-grams together. Where they come from several documents, their windows are compared, by a
   hash first and by all bytes then.
4. Spans go back to the texts, which travel compressed.

Results are exact. Defined results: null and empty texts have no bytes; rows without doc_id
neither lose nor cause anything; rows that share a doc_id are no repeats of each other and
lose the spans found in any of them; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

from starloom.llm.common import fields, mix, sliced, span_hashes

WINDOW = 50
GRAM = 16
#: Positions at which a window's 16-grams begin.
PLACES = WINDOW - GRAM + 1
#: Anchors in a bucket, about.
BUCKET = 120_000
#: Bytes of text whose anchors are put together before they leave a task.
BLOCK = 8 << 20
#: Window starts worked on at once.
STEP = 1 << 20
#: Documents from which the splitters are drawn, and bytes of each.
SAMPLE, SAMPLE_BYTES = 2_000, 20_000


def leading(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one number, zeros behind the end."""
    padded = np.concatenate((data, np.zeros(32, np.uint8)))
    out = np.empty(len(data) + 8, np.uint64)
    for r in range(8):
        n = len(out[r::8])
        out[r::8] = padded[r : r + 8 * n].view(">u8")
    return out


def words_at(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; all are inside ``data``."""
    out = np.zeros(len(places), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | data[places + k]
    return out


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window start, past-last start, anchor) of every run of windows of one anchor."""
    parts = []
    owner_end = np.repeat(offsets[1:], np.diff(offsets))
    for low in range(0, len(data), STEP):
        high = min(len(data), low + STEP + WINDOW)
        words = leading(data[low:high])
        size = high - low
        # ``leading`` goes eight positions beyond the end.
        hashed = mix(words[:size] ^ (words[8 : size + 8] * np.uint64(0xD6E8FEB86659FD93)))
        key = (hashed & np.uint64(0xFFFFFFFF00000000)) | np.arange(size, dtype=np.uint64)
        least, width = key, 1
        while width * 2 <= PLACES:
            least = np.minimum(least[:-width], least[width:]) if len(least) > width else least[:0]
            width *= 2
        rest = PLACES - width
        least = np.minimum(least[: len(least) - rest], least[rest:]) if len(least) > rest else least[:0]
        starts = np.arange(min(STEP, size, len(least)))
        starts = starts[starts + low + WINDOW <= owner_end[starts + low]]
        if not len(starts):
            continue
        at = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        change = np.flatnonzero((at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
        first, last = np.concatenate(([0], change)), np.concatenate((change, [len(starts)])) - 1
        parts.append((starts[first] + low, starts[last] + low + 1, at[first] + low))
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*parts))


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of all spans, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return data[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def multikey(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order by all columns, the first decides, and which rows in it begin a group of equals."""
    order = np.argsort(columns[0], kind="stable")
    value = columns[0][order]
    new = np.concatenate(([True], value[1:] != value[:-1])) if len(order) else np.zeros(0, bool)
    for column in columns[1:]:
        group = np.cumsum(new)
        tied = np.flatnonzero(np.bincount(group)[group] > 1) if len(group) else np.zeros(0, np.int64)
        inner = order[tied]
        order[tied] = inner[np.lexsort((column[inner], group[tied]))]
        value = column[order]
        new[1:] |= value[1:] != value[:-1]
    return order, new


def merged(docs: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each document without overlaps or adjacent ones."""
    if not len(docs):
        return docs, begins, ends
    order = np.lexsort((begins, docs))
    docs, begins, ends = docs[order], begins[order], ends[order]
    # Within a document no span is inside another by much: ends only grow if taken as running maximum.
    first = np.concatenate(([True], docs[1:] != docs[:-1]))
    group = np.cumsum(first) - 1
    span = int(ends.max()) + 1
    reach = np.maximum.accumulate(ends + group * span) - group * span
    new = first.copy()
    new[1:] |= begins[1:] > reach[:-1]
    at = np.flatnonzero(new)
    last = np.concatenate((at[1:], [len(docs)])) - 1
    return docs[at], begins[at], reach[last]


class _Block:
    """Anchors of some texts, as they leave a task."""

    def __init__(self) -> None:
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, ids: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
        begin, past, anchor = anchors(data, offsets)
        doc = np.searchsorted(offsets, begin, "right") - 1
        length = past - begin + WINDOW - 1
        hashes = span_hashes(data, begin, begin + length) ^ mix((anchor - begin).astype(np.uint64))
        self.parts.append((ids[doc], begin - offsets[doc], anchor - begin, length, hashes, gather(data, begin, length)))
        self.size += len(data)

    def rows(self, splitters: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
        """(bucket, kind, payload): anchors by bucket as kind 0, spans that are known to go as kind 1."""
        doc, begin, anchor, length, hashes, flat = (np.concatenate(x) for x in zip(*self.parts))
        self.parts = []
        if not len(doc):
            return
        at = np.cumsum(length) - length
        # Equal runs: the first of the smallest document stands for those of larger ones.
        order = np.lexsort((begin, doc, hashes))
        new = np.concatenate(([True], hashes[order][1:] != hashes[order][:-1]))
        head = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        repeat = (doc[order] > doc[head]) & (length[order] == length[head]) & (anchor[order] == anchor[head])
        rows, heads = order[repeat], head[repeat]
        equal = np.ones(len(rows), bool)
        for k in range(0, len(rows), 20_000):
            a, b, n = rows[k : k + 20_000], heads[k : k + 20_000], length[rows[k : k + 20_000]]
            same = gather(flat, at[a], n) == gather(flat, at[b], n)
            equal[k : k + 20_000] = np.logical_and.reduceat(same, np.cumsum(n) - n)
        gone = rows[equal]
        spans = merged(doc[gone], begin[gone], begin[gone] + length[gone])
        if len(spans[0]):
            yield int(doc[gone[0]] % (len(splitters) + 1)), 1, b"".join(x.astype(np.int64).tobytes() for x in spans)
        stay = np.ones(len(doc), bool)
        stay[gone] = False
        stay = np.flatnonzero(stay)
        high, low = words_at(flat, (at + anchor)[stay]), words_at(flat, (at + anchor + 8)[stay])
        bucket = np.searchsorted(splitters, high, "right")
        order = np.lexsort((low, high))
        stay, bucket = stay[order], bucket[order]
        press = zstandard.ZstdCompressor(level=5)
        edges = np.searchsorted(bucket, np.arange(len(splitters) + 2))
        for k in np.flatnonzero(np.diff(edges)).tolist():
            pick = stay[edges[k] : edges[k + 1]]
            ids, number = np.unique(doc[pick], return_inverse=True)
            # Halves apart, because the upper ones are mostly zero; a text has less than 2^32 bytes.
            halves = [x for v in (number, begin[pick]) for x in ((v & 0xFFFF).astype(np.uint16), (v >> 16).astype(np.uint16))]
            head = (np.array([len(pick), len(ids)], np.int64), ids.astype(np.int64), *halves)
            head += (anchor[pick].astype(np.uint8), length[pick].astype(np.uint8))
            raw = b"".join(x.tobytes() for x in head) + gather(flat, at[pick], length[pick]).tobytes()
            yield k, 0, press.compress(raw)


def unpacked(payload: bytes) -> tuple[np.ndarray, ...]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n, m = np.frombuffer(raw, np.int64, 2).tolist()
    ids = np.frombuffer(raw, np.int64, m, 16)
    at, out = 16 + 8 * m, []
    for kind in (np.uint16, np.uint16, np.uint16, np.uint16, np.uint8, np.uint8):
        out.append(np.frombuffer(raw, kind, n, at).astype(np.int64))
        at += n * np.dtype(kind).itemsize
    number, begin = out[0] | (out[1] << 16), out[2] | (out[3] << 16)
    return ids[number], begin, out[4], out[5], np.frombuffer(raw, np.uint8, offset=at)


def repeated(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, begin, end) of windows in a bucket that a smaller document has too."""
    doc, begin, anchor, length, flat = (np.concatenate(x) for x in zip(*map(unpacked, payloads)))
    at = np.cumsum(length) - length
    order, new = multikey([words_at(flat, at + anchor), words_at(flat, at + anchor + 8)])
    heads = np.flatnonzero(new)
    several = np.minimum.reduceat(doc[order], heads) < np.maximum.reduceat(doc[order], heads)
    pick = np.sort(order[several[np.cumsum(new) - 1]])
    if not len(pick):
        return (np.zeros(0, np.int64),) * 3
    # All windows of these runs, by a hash; those of groups with one document alone are no repeats.
    flat = gather(flat, at[pick], length[pick])
    doc, begin, length = doc[pick], begin[pick], length[pick]
    at = np.cumsum(length) - length
    count = length - WINDOW + 1
    run = np.repeat(np.arange(len(pick)), count)
    inner = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    place = at[run] + inner
    hashes = span_hashes(flat, place, place + WINDOW)
    order = np.lexsort((doc[run], hashes))
    new = np.concatenate(([True], hashes[order][1:] != hashes[order][:-1]))
    head = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = doc[run[order]] > doc[run[head]]
    rows, heads = order[later], head[later]
    equal = np.ones(len(rows), bool)
    for k in range(0, len(rows), 50_000):
        a, b = rows[k : k + 50_000], heads[k : k + 50_000]
        inside = np.arange(WINDOW)
        equal[k : k + 50_000] = (flat[place[a][:, None] + inside] == flat[place[b][:, None] + inside]).all(axis=1)
    found = rows[equal]
    if not equal.all():
        # Windows of equal hash and unequal bytes, if ever: by their bytes.
        mixed = np.isin(hashes, hashes[rows[~equal]])
        least: dict[bytes, int] = {}
        texts = {int(w): flat[place[w] : place[w] + WINDOW].tobytes() for w in np.flatnonzero(mixed)}
        for w, text in texts.items():
            least[text] = min(least.get(text, int(doc[run[w]])), int(doc[run[w]]))
        exact = [w for w, text in texts.items() if doc[run[w]] > least[text]]
        found = np.concatenate((found[~mixed[found]], np.array(exact, np.int64)))
    start = begin[run[found]] + inner[found]
    return merged(doc[run[found]], start, start + WINDOW)


def _splitters(docs: DataFrame) -> np.ndarray:
    """Leading bytes that part the anchors into buckets; from a sample, so they only decide the balance."""
    size, rows = docs.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    buckets = int((size or 0) / ((PLACES + 1) / 2) / BUCKET)
    if buckets < 1:
        return np.zeros(0, np.uint64)
    texts = docs.sample(min(1.0, SAMPLE / rows), 1).select(F.substring("text", 1, SAMPLE_BYTES).alias("text"))
    seen = []
    for (text,) in texts.limit(2 * SAMPLE).collect():
        data = np.frombuffer((text or "").encode(), np.uint8)
        _, _, anchor = anchors(data, np.array([0, len(data)]))
        seen.append(leading(data)[anchor])
    values = np.sort(np.concatenate(seen)) if seen else np.zeros(0, np.uint64)
    if not len(values):
        return np.zeros(0, np.uint64)  # texts too short for a window
    return np.unique(values[(np.arange(1, buckets + 1) * len(values)) // (buckets + 1)])


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, span): bytes to be removed, begin and end in the halves of one number; spans may overlap."""
    docs = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), "text")
    splitters = _splitters(docs)
    packed_rows = StructType([*fields("bucket kind"), *fields(payload=BinaryType())])
    found = StructType(fields("doc_id span"))

    def rows_of(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[pa.RecordBatch]:
        both = (begin.astype(np.int64) << 32) | end.astype(np.int64)
        for k in range(0, len(doc), 50_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[k : k + 50_000].astype(np.int64)), pa.array(both[k : k + 50_000])], found.fieldNames()
            )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()

        def flushed() -> Iterator[pa.RecordBatch]:
            rows = list(block.rows(splitters)) if block.parts else []
            for k in range(0, len(rows), 50):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows[k : k + 50]), (pa.int64(), pa.int64(), pa.binary()))],
                    ["bucket", "kind", "payload"],
                )

        for part, data, offsets in sliced(batches, limit=STEP):
            block.add(part.column("doc_id").to_numpy(), data, offsets)
            if block.size >= BLOCK:
                yield from flushed()
                block = _Block()
        yield from flushed()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets: dict[int, list[bytes]] = defaultdict(list)
        for batch in batches:
            for bucket, kind, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if kind:
                    yield from rows_of(*np.frombuffer(payload, np.int64).reshape(3, -1))
                else:
                    buckets[bucket].append(payload)
        for bucket in sorted(buckets):
            yield from rows_of(*repeated(buckets.pop(bucket)))

    dealt = docs.mapInArrow(split, packed_rows).repartition(len(splitters) + 1, "bucket")
    return dealt.mapInArrow(compare, found)


def without_repeats(docs: DataFrame, texts: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the text that is left if asked for."""
    zipped_rows = StructType([*fields("doc_id"), *fields(zipped=BinaryType())])
    out = StructType(fields("doc_id n_bytes n_removed n_spans", "kept_sha256 text" if texts else "kept_sha256"))

    def zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for part, data, offsets in sliced(batches):
            raw = data.tobytes()
            rows = [press.compress(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, pa.binary())], ["doc_id", "zipped"])

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for doc, raw, packed in zip(*(batch.column(c) for c in ("doc_id", "zipped", "found"))):
                data, n = unzip.decompress(raw.as_py()), 0
                size, kept = len(data), [data]
                if packed.is_valid:
                    both = np.array(packed.as_py(), np.int64)
                    _, begin, end = merged(np.zeros(len(both), np.int64), both >> 32, both & 0xFFFFFFFF)
                    begin, end = begin[begin < size], np.minimum(end[begin < size], size)
                    n = len(begin)
                    edges = [0, *np.column_stack((begin, end)).ravel().tolist(), size]
                    kept = [data[a:b] for a, b in zip(edges[0::2], edges[1::2])]
                left = b"".join(kept)
                row = (doc.as_py(), size, size - len(left), n, hashlib.sha256(left).hexdigest())
                rows.append((*row, left.decode("utf-8", "replace")) if texts else row)
            columns = list(zip(*rows)) if rows else [()] * len(out)
            kinds = [pa.int64()] * 4 + [pa.string()] * (len(out) - 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], out.fieldNames())

    found = spans(docs).groupBy("doc_id").agg(F.collect_list("span").alias("found"))
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(zipped, zipped_rows)
    return rows.join(found, "doc_id", "left").mapInArrow(cleaned, out)
