"""JSON documents of any size, read in byte ranges by many tasks.

Spark splits a text file at any delimiter; here that is the opening brace, which begins every
row of a document. Where a range begins, it is not known whether that is inside a string, how
deep, and below which keys. So there are two passes:

1. Every range sums up what it does to the state before it, once for a beginning outside and
   once for one inside a string: how many brackets it closes that it didn't open, which ones it
   leaves open and below which keys, and how many commas it adds to the innermost list that stays
   open. Such summaries are joined by a prefix, one row for each range (as long as the list of
   the files), and give every range's state at its beginning. They also tell a document that
   is cut short or closes too much, which is an error.
2. Every range reads its rows, knowing where it is. A row that goes on in the next range is
   emitted in parts, two for each boundary, which are put together by its place.

Rows are parsed one by one, so neither a document nor a file has to fit into one value or task.
Compressed files are one range each, read as a stream.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.operators.sets import DATABASE
from starloom.plans.build import POSITION

FILE = "_file"
METADATA = "extraction_metadata"
#: Bytes of text before a bracket in which its key is looked for; a longer key is an error.
KEY_BYTES = 1 << 16

_CANDIDATE = np.isin(np.arange(256), [ord(c) for c in "{}[],"])
_DELTA = np.zeros(256, np.int64)
_DELTA[[ord("{"), ord("[")]], _DELTA[[ord("}"), ord("]")]] = 1, -1
_BLANK = b" \t\r\n\xef\xbb\xbf"
_KEY = re.compile(rb'("(?:[^"\\]|\\.)*")\s*:\s*\Z', re.DOTALL)
#: Path of an open list: (bracket, key) of all containers from the document on.
Path = Sequence[tuple[str, str | None]]


@dataclass(frozen=True)
class Stretch:
    """What a stretch of text does to the state before it.

    ``opened`` holds (bracket, text before it, whether that text begins in this stretch, commas)
    of the containers it leaves open; ``commas`` is what it adds to the innermost one that was open
    before and stays so. ``tail`` is the text behind its last bracket or comma, None if that is too
    long to be a key; ``through`` says that there is no bracket or comma.
    """

    inside: bool
    closed: int = 0
    opened: tuple[tuple[str, bytes | None, bool, int], ...] = ()
    commas: int = 0
    tail: bytes | None = b""
    through: bool = True

    def then(self, other: Stretch) -> Stretch:
        """Both, one after the other."""
        opened, closed, commas = list(self.opened), self.closed, self.commas
        if other.closed > len(opened):
            closed, opened, commas = closed + other.closed - len(opened), [], other.commas
        else:
            del opened[len(opened) - other.closed :]
            if opened:
                bracket, text, own, n = opened[-1]
                opened[-1] = (bracket, text, own, n + other.commas)
            else:
                commas += other.commas
        # What stands before the first bracket may have begun in the stretch before.
        first = [(b, t if own else _joined(self.tail, t), own or not self.through, n) for b, t, own, n in other.opened]
        tail = _joined(self.tail, other.tail) if other.through else other.tail
        return Stretch(other.inside, closed, (*opened, *first), commas, tail, self.through and other.through)


def _joined(a: bytes | None, b: bytes | None) -> bytes | None:
    return None if a is None or b is None or len(a) + len(b) > KEY_BYTES else a + b


def _quotes(data: np.ndarray) -> np.ndarray:
    """Places of the quotes that begin or end a string; the text doesn't begin behind a backslash."""
    quotes = np.flatnonzero(data == ord('"'))
    slash = data == ord("\\")
    if len(quotes) and slash.any():
        last = np.maximum.accumulate(np.where(slash, -1, np.arange(len(data))))
        before = quotes - 1
        run = np.where(before >= 0, before - last[before], 0)
        quotes = quotes[run % 2 == 0]
    return quotes


def _tokens(data: np.ndarray, quotes: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of brackets and commas outside strings, and how deep it is behind each, from 0 at the beginning."""
    place = np.flatnonzero(_CANDIDATE[data])
    place = place[(np.searchsorted(quotes, place) + inside) % 2 == 0]
    return place, np.cumsum(_DELTA[data[place]])


def stretches(raw: bytes) -> tuple[Stretch, Stretch]:
    """The summaries of a text that begins outside and inside a string."""
    data = np.frombuffer(raw, np.uint8)
    quotes = _quotes(data)
    return tuple(_stretch(raw, data, quotes, inside) for inside in (False, True))


def _stretch(raw: bytes, data: np.ndarray, quotes: np.ndarray, inside: bool) -> Stretch:
    place, level = _tokens(data, quotes, inside)
    ends = (len(quotes) + inside) % 2 == 1
    text = lambda a, b: raw[a:b] if b - a <= KEY_BYTES else None
    if not len(place):
        return Stretch(ends, tail=text(0, len(raw)))
    kind = data[place]
    least, last = min(0, int(level.min())), int(level[-1])
    comma = kind == ord(",")
    opened = []
    for depth in range(least + 1, last + 1):
        at = int(np.flatnonzero((level == depth) & (_DELTA[kind] == 1))[-1])
        before = int(place[at - 1]) + 1 if at else 0
        commas = int((comma[at:] & (level[at:] == depth)).sum())
        opened.append((chr(kind[at]), text(before, int(place[at])), at > 0, commas))
    return Stretch(ends, -least, tuple(opened), int((comma & (level == least)).sum()), text(int(place[-1]) + 1, len(raw)), False)


def key_of(text: bytes | None) -> str | None:
    """The key at the end of the text before a bracket; None below a list."""
    if text is None:
        raise ValueError(f"a key of more than {KEY_BYTES} bytes")
    found = _KEY.search(text)
    return json.loads(found[1]) if found else None


# Reading


def fragments(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(value, file, start): the files' text between opening braces; ``start`` is the range's."""
    text = spark.read.option("lineSep", "{").text(paths)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """(file, start, text) for consecutive fragments of a range; braces are back in their places."""
    now = None
    for batch in batches:
        files, starts = batch.column("file").to_pylist(), batch.column("start").to_numpy()
        edges = [0, *(k for k in range(1, len(files)) if starts[k] != starts[k - 1] or files[k] != files[k - 1]), len(files)]
        for a, b in zip(edges, edges[1:]):
            where = (files[a], int(starts[a]))
            text = "{".join(batch.column("value").slice(a, b - a).to_pylist()).encode()
            # The first text of a file stands before its first brace, every other one behind a brace.
            yield (*where, text if where != now and where[1] == 0 else b"{" + text)
            now = where


def summaries(text: DataFrame) -> DataFrame:
    """One row for each range: its summary for both beginnings."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pair = None, None
        row = lambda: pa.RecordBatch.from_pylist([{"file": now[0], "start": now[1], "both": json.dumps([_plain(x) for x in pair])}])
        for file, start, raw in _chunks(batches):
            both = stretches(raw)
            if (file, start) == now:
                pair = [x.then(both[x.inside]) for x in pair]
            else:
                if now:
                    yield row()
                now, pair = (file, start), both
        if now:
            yield row()

    return text.mapInArrow(work, "file string, start bigint, both string")


def _plain(x: Stretch) -> list:
    text = lambda t: None if t is None else t.decode("latin-1")
    return [x.inside, x.closed, [[b, text(t), own, n] for b, t, own, n in x.opened], x.commas, text(x.tail), x.through]


def _stored(x: list) -> Stretch:
    text = lambda t: None if t is None else t.encode("latin-1")
    opened = tuple((b, text(t), own, n) for b, t, own, n in x[2])
    return Stretch(x[0], x[1], opened, x[3], text(x[4]), x[5])


def states(text: DataFrame) -> dict[tuple[str, int], Stretch]:
    """The state at the beginning of every range, from the beginning of its file on.

    A document that is cut short, closes what it did not open or holds nothing is an error.
    """
    ranges: dict[str, list] = defaultdict(list)
    # One row for each range, as long as the list of the files.
    for row in summaries(text).collect():
        ranges[row["file"]].append((row["start"], [_stored(x) for x in json.loads(row["both"])]))
    out: dict[tuple[str, int], Stretch] = {}
    for file, parts in ranges.items():
        now, held = Stretch(False), False
        for start, both in sorted(parts, key=lambda part: part[0]):
            out[file, start] = now
            now = now.then(both[now.inside])
            held |= not now.through
            if now.closed:
                raise ValueError(f"malformed JSON: {file} closes more than it opens")
        if now.inside or now.opened or not held:
            raise ValueError(f"malformed JSON: {file} ends before its document does")
    return out


class _Reader:
    """The entries of wanted lists, or the fields of the document itself, from a range's beginning on.

    ``place`` says what a path is wanted for, if it is; no wanted list is deeper than ``depth``.
    """

    def __init__(self, state: Stretch, place: Callable[[Path], tuple | None], depth: int) -> None:
        self.place, self.depth = place, depth
        self.inside, self.tail, self.level = state.inside, state.tail, len(state.opened)
        self.begun = not state.through
        self.stack: list[list] = []
        self.found: tuple | None = None
        # What is inside an entry, or deeper than any wanted list, is not told apart.
        for bracket, text, _, commas in state.opened[:depth]:
            if not self.found:
                self._push(bracket, key_of(text), commas)
        #: The entry at hand: its text so far, and whether its beginning is in this range.
        self.entry: list[bytes] = []
        self.own = False

    def _push(self, bracket: str, key: str | None, commas: int = 0) -> None:
        self.stack.append([bracket, key, commas])
        self.found = self.place([(b, k) for b, k, _ in self.stack])

    def _take(self, text: bytes = b"") -> tuple:
        out = (*self.found, self.stack[-1][2], self.own, b"".join([*self.entry, text]))
        self.entry, self.own = [], True
        return out

    def read(self, raw: bytes, fields: Callable[[bytes | None, str], None] | None = None) -> Iterator[tuple]:
        """(database, table, wrapped, index, whole, text) of the entries that end in this text."""
        data = np.frombuffer(raw, np.uint8)
        quotes = _quotes(data)
        place, level = _tokens(data, quotes, self.inside)
        level = level + self.level
        kind = data[place]
        near = np.flatnonzero(np.where(_DELTA[kind] < 0, level < self.depth, level <= self.depth))
        at = 0
        for p, code, depth in zip(place[near].tolist(), kind[near].tolist(), level[near].tolist()):
            delta, height = int(_DELTA[code]), len(self.stack)
            if self.found and depth - (delta > 0) >= height + (delta == 0):
                continue  # inside an entry
            if delta > 0:
                text = _joined(self.tail, raw[at:p])
                if not height and (self.begun or text is None or text.strip(_BLANK)):
                    raise ValueError("malformed JSON: a file holds one document and nothing else")
                if fields and height == 1:
                    fields(text, chr(code))
                self.begun = True
                self._push(chr(code), key_of(text))
                self.entry, self.own = [], True
            else:
                if self.found:
                    yield self._take(raw[at:p])
                elif fields and height == 1:
                    fields(_joined(self.tail, raw[at:p]), "")
                if delta:
                    self.stack.pop()
                    self.found, self.entry = None, []
                elif height:
                    self.stack[-1][2] += 1
            at, self.tail = p + 1, b""
        if self.found:
            self.entry.append(raw[at:])
        else:
            self.tail = _joined(self.tail, raw[at:])
            if self.begun and not self.stack and raw[at:].strip(_BLANK):
                raise ValueError("malformed JSON: a file holds one document and nothing else")
        self.inside = (len(quotes) + self.inside) % 2 == 1
        self.level = int(level[-1]) if len(level) else self.level

    def rest(self) -> tuple | None:
        """The entry at hand as far as this range has it; its end is in a later one."""
        if not self.found:
            return None
        self.own = False
        return self._take()


_ROWS = "file string, start bigint, database string, table string, wrapped boolean, pos bigint, whole boolean, text string"


def entries(text: DataFrame, known, place: Callable[[Path], tuple | None], depth: int, parts: bool) -> DataFrame:
    """The entries of the lists that ``place`` finds, whole ones, or with ``parts`` those cut by a boundary."""
    columns = [name.split(" ")[0] for name in _ROWS.split(", ")]
    schema = pa.schema([
        ("file", pa.string()), ("start", pa.int64()), ("database", pa.string()), ("table", pa.string()), ("wrapped", pa.bool_()),
        ("pos", pa.int64()), ("whole", pa.bool_()), ("text", pa.string()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reader, rows = None, None, []

        def add(found: tuple | None) -> None:
            if found and found[4] != parts and (parts or found[5].strip()):
                rows.append((*now, *found[:5], found[5].decode()))

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({c: [r[k] for r in rows] for k, c in enumerate(columns)}, schema=schema)
            rows.clear()
            return out

        for file, start, raw in _chunks(batches):
            if (file, start) != now:
                if reader:
                    add(reader.rest())
                now, reader = (file, start), _Reader(known.value[file, start], place, depth)
            for found in reader.read(raw):
                add(found)
            if len(rows) >= 2_000:
                yield batch()
        if reader:
            add(reader.rest())
        if rows:
            yield batch()

    return text.mapInArrow(work, _ROWS)


def root_fields(text: DataFrame, known, names: Sequence[str]) -> DataFrame:
    """(file, key, value): the document's own fields of these names; a bracket stands for a container."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reader = None, None
        for file, start, raw in _chunks(batches):
            if (file, start) != now:
                now, reader = (file, start), _Reader(known.value[file, start], lambda path: None, 2)
            found: list[tuple[bytes | None, str]] = []
            for _ in reader.read(raw, lambda before, bracket: found.append((before, bracket))):
                pass
            rows = []
            for before, bracket in found:
                if before is None:
                    continue  # longer than a key or a name can be
                if bracket:
                    key, value = key_of(before), bracket
                else:
                    pair = json.loads(b"{" + before + b"}") if before.strip() else {}
                    key, value = next(iter(pair.items()), (None, None))
                if key in names and value is not None:
                    rows.append({"file": file, "key": key, "value": value if isinstance(value, str) else json.dumps(value)})
            if rows:
                yield pa.RecordBatch.from_pylist(rows)

    return text.mapInArrow(work, "file string, key string, value string")


def _together(text: DataFrame, known, place, depth: int) -> DataFrame:
    """All entries as (file, database, table, wrapped, pos, text); those cut by boundaries put together."""
    whole = entries(text, known, place, depth, False)
    key = ["file", "database", "table", "wrapped", "pos"]
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda x: x["text"]), "")
    cut_ = entries(text, known, place, depth, True).groupBy(*key).agg(joined.alias("text"))
    return whole.select(*key, "text").unionByName(cut_.filter(F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))


def _opened(spark: SparkSession, paths: str | Sequence[str]):
    text = fragments(spark, paths)
    return text, spark.sparkContext.broadcast(states(text))


def _parsed(rows: DataFrame, *passing: str) -> DataFrame:
    place = F.struct("file", "pos").alias(POSITION)
    return rows.select(*passing, place, F.parse_json("text").alias("row"))


def _extract_place(path: Path) -> tuple | None:
    """``{database: {table: {"sample": [rows]}}}``, the metadata entry left out."""
    if [b for b, _ in path] == ["{", "{", "{", "["] and path[3][1] == "sample" and path[1][1] != METADATA:
        return path[1][1], path[2][1], False
    return None


def _single_place(path: Path) -> tuple | None:
    """``{"database": ..., "table": ..., "data": [rows]}``."""
    return (None, None, False) if [b for b, _ in path] == ["{", "["] and path[1][1] == "data" else None


def _transformed_place(path: Path) -> tuple | None:
    """``{table: [rows]}``, or the same below ``tables``."""
    if [b for b, _ in path] == ["{", "["]:
        return None, path[1][1], False
    if [b for b, _ in path] == ["{", "{", "["] and path[1][1] == "tables":
        return None, path[2][1], True
    return None


def read_extract(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(_database, table, _pos, row) for each row of each database's tables; the position counts within file and table."""
    text, known = _opened(spark, paths)
    rows = _together(text, known, _extract_place, 4)
    return _parsed(rows, F.col("database").alias(DATABASE), "table")


def read_single(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(_database, table, _pos, row) for each row of documents that hold one table."""
    text, known = _opened(spark, paths)
    named = root_fields(text, known, ("database", "table")).groupBy("file").agg(
        *[F.max(F.when(F.col("key") == name, F.col("value"))).alias(alias) for name, alias in (("database", DATABASE), ("table", "table"))]
    )
    rows = _together(text, known, _single_place, 2).drop("database", "table")
    return _parsed(rows.join(named, "file", "left"), DATABASE, "table")


def read_transformed(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(table, _pos, row) for each row of transformed documents, with or without the ``tables`` wrapper."""
    text, known = _opened(spark, paths)
    wrapped = root_fields(text, known, ("tables",)).select("file", F.lit(True).alias("wraps")).distinct()
    rows = _together(text, known, _transformed_place, 3).join(wrapped, "file", "left")
    return _parsed(rows.filter(F.col("wrapped") == F.coalesce("wraps", F.lit(False))), "table")
