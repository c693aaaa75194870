"""Benchmark decontamination: one Aho-Corasick automaton over all windows, each text scanned once.

Texts become their words, lower-cased and joined by single spaces; so do the benchmark items.
Every ten consecutive words of an item are a pattern (a shorter item is one pattern). The
automaton finds all patterns in one pass over a text; offsets in the joined words lead back to
words, and these to code points of the original text.

The automaton holds the benchmark, which is measured first: each takes at most ``SHARD``
patterns, and a larger benchmark is scanned shard by shard, what is found so far travelling
with the text (stored in the shared folder between shards).

Defined results: null and empty texts have no words and are clean; items without words match
nothing; items that repeat are one if they share item_id; a null item_id is left out; repeated
documents are judged each; extra columns are ignored; an empty benchmark hits nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from starloom.llm.common import fields
from starloom.session import cut

WINDOW = 10
#: Patterns in one automaton: some 60 bytes each as text, some 300 MB as an automaton at most.
SHARD = 200_000

#: One byte to one: A-Z lower-cased, what parts words to a space, all else kept.
TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
# The same in a text as it was, capitals included.
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_LONGS = ArrayType(LongType())
_SPANS = ArrayType(StructType([StructField("begin", IntegerType()), StructField("end", IntegerType())]))
_FOUND = StructType(fields("n_words n_hit", item_ids=_LONGS, hit_from=_LONGS, hit_to=_LONGS, spans=_SPANS))


def normal(text: str | None) -> list[bytes]:
    """The words of a text, in UTF-8: only ASCII bytes are mapped, so longer characters stay whole."""
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()


def joined(words: list[bytes]) -> str:
    return f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "


def patterns(rows: list[tuple[int, str]], window: int) -> dict[str, list[int]]:
    """Every window, with a space at either end, and the items it is from."""
    found: dict[str, set[int]] = {}
    for item, text in rows:
        words = normal(text)
        for k in range(max(1, len(words) - window + 1) if words else 0):
            found.setdefault(joined(words[k : k + window]), set()).add(item)
    return {k: sorted(v) for k, v in found.items()}


def automaton(found: dict[str, list[int]]) -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for pattern, items in found.items():
        made.add_word(pattern, (len(pattern), pattern.count(" ") - 1, items))
    made.make_automaton()
    return made


def scan(text: str, machine: ahocorasick.Automaton | None) -> tuple[int, np.ndarray, list[int]]:
    """Number of words, which of them are hit, and the items found."""
    words = normal(text)
    if not words or machine is None:
        return len(words), np.zeros(0, bool), []
    line = joined(words)
    items: set[int] = set()
    ends: list[tuple[int, int]] = []
    for end, (_, count, of) in machine.iter(line):
        ends.append((end, count))
        items.update(of)
    if not ends:
        return len(words), np.zeros(0, bool), []
    # The k-th space follows the k-th word, so the space that ends a match tells its last word.
    spaces = np.flatnonzero(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32) == 0x20)
    last = np.searchsorted(spaces, np.array([e for e, _ in ends]))
    counts = np.array([c for _, c in ends])
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, last - counts, 1)
    np.add.at(marks, last, -1)
    return len(words), np.cumsum(marks[:-1]) > 0, sorted(items)


def runs(hit: np.ndarray) -> np.ndarray:
    """First and past-last index of every run of hits."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return edges.reshape(-1, 2)


def original_spans(text: str, found: np.ndarray) -> list[dict]:
    """Runs of words as code points of the text as it was."""
    places = [m.span() for m in WORD.finditer(text)]
    return [{"begin": places[a][0], "end": places[b - 1][1]} for a, b in found]


def _shards(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[int, str]]]:
    """The items in shards of about ``limit`` patterns at most, parted by a hash; one at a time is on the driver."""
    items = benchmark.where("item_id is not null and text is not null").select(
        F.col("item_id").cast("long").alias("item_id"), "text"
    )
    # A pattern begins at each word; words take five bytes or more on average.
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-int(size) // (limit * 5)))
    for k in range(parts):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == k).collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = SHARD) -> DataFrame:
    """The rows of ``docs`` with n_words, n_hit, item_ids and spans (code points of the hit runs of words)."""
    seen = None
    for rows in _shards(benchmark, limit):
        seen = _scanned(docs if seen is None else cut(seen), rows, window, seen is not None)
    return seen


def _scanned(docs: DataFrame, rows: list[tuple[int, str]], window: int, again: bool) -> DataFrame:
    """Adds the findings, or adds to them if ``docs`` has those of another shard; they replace columns of their names."""
    kept = [f for f in docs.schema.fields if f.name not in _FOUND.fieldNames()]
    found = patterns(rows, window)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(found) if found else None
        for batch in batches:
            columns: dict[str, list] = {f: [] for f in _FOUND.fieldNames()}
            for row, text in enumerate(batch.column("text").to_pylist()):
                n, hit, items = scan(text or "", machine)
                if again:
                    items = sorted({*items, *batch.column("item_ids")[row].as_py()})
                    before = np.zeros(n, bool)
                    for a, b in zip(*(batch.column(c)[row].as_py() for c in ("hit_from", "hit_to"))):
                        before[a:b] = True
                    hit = before | hit if len(hit) else before
                at = runs(hit) if len(hit) else np.zeros((0, 2), np.int64)
                values = (n, int(hit.sum()), items, at[:, 0], at[:, 1], original_spans(text, at) if len(at) else [])
                for to, value in zip(columns.values(), values):
                    to.append(value)
            arrays = [pa.array(v, to_arrow_type(_FOUND[k].dataType)) for k, v in columns.items()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), *arrays], [*(f.name for f in kept), *columns]
            )

    return docs.mapInArrow(work, StructType([*kept, *_FOUND.fields]))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows that hold no window, with their own columns."""
    packed = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return contaminated(packed, benchmark, window).where("n_hit = 0").select("row.*")
