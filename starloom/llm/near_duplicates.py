"""Near duplicates by MinHash: many universal hash minima, banding, verification, components.

A document's set is its distinct word n-grams (64-bit hashes; the whole sequence if there are
fewer words). ``BANDS * ROWS`` multiply-add hashes of the set, each a permutation of 32-bit
numbers, give a signature of minima. Documents with equal sets are one class, led by the
smallest doc_id, so copies of any number are one row from there on. Classes that share a band
of minima are candidates; two sets with a similarity of 0.8 share none of 52 bands of 7 in 5 of
a million cases, with 0.85 in 2 of a billion. Fewer rows would be cheaper, but documents that
share a long passage and little else would meet in groups of thousands.

Candidates aren't paired with each other. First, in every band's group, members are held
against one centre, the least: if the signatures agree enough (a similarity of 0.8 agrees less
in one of ten million cases), the full sets decide. Links make components, by large-star and
small-star. Groups whose members are still of several components go on: the members outside the
group's largest component are compared with all others, in cells of at most about ``BLOCK`` by
``BLOCK`` documents that are dealt over all tasks. In a cell, pairs of different components
that agree are held against each other by their full sets, the best first, until a document
is linked with a component; a pair is compared in the first band it shares alone, and only
links leave a cell.

Texts of candidates alone are read again, compressed, for the full sets.

Defined results: null and empty texts have an empty set and are linked with nothing; rows that
share a doc_id are one document if their sets are equal, and ``groups`` links their classes by
the id if not, while ``deduplicated`` judges texts and keeps one row of each; a null
doc_id is a document of its own, with itself as component (null); ties go to the smaller
doc_id; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructType

from starloom.llm.common import LOWER, SLICE, fields, joined, mapped, mix, sliced, small, span_hashes, window_hashes, words
from starloom.llm.components import components
from starloom.session import cut
from starloom.sinks.files import shuffles_dropped

BANDS, ROWS = 52, 7
#: Bytes to compare signatures by, one of each minimum.
SKETCH = BANDS * ROWS
#: In hundredths.
SIMILAR = 80
#: Standard deviations below the expected share of equal minima at which full sets aren't compared.
DEVIATIONS = 5.2
#: Signatures on either side of a cell, on average.
BLOCK = 256
#: Bytes of text that are worked on together; texts of short words take many times as much while they become sets.
TOGETHER = SLICE // 4
#: Shingles that a task keeps at hand while it compares.
HELD = 4_000_000

_SEEDS = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64)).astype(np.uint32)
FACTORS, SHIFTS = _SEEDS[0::2, None] | np.uint32(1), _SEEDS[1::2, None]
_NUMBERS = mix(np.arange(BANDS, dtype=np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's word n-grams."""
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    hashes = span_hashes(data, starts, ends)
    windows = window_hashes(hashes, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(windows[a : b - n + 1]))
        elif b > a:
            # A short sequence is unlike any n-gram.
            out.append(mix(window_hashes(hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minima(values: np.ndarray) -> np.ndarray:
    """The least of each hash function over a set."""
    short = (values >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(FACTORS), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(short), 256):
        np.minimum(least, (short[None, at : at + 256] * FACTORS + SHIFTS).min(axis=1), out=least)
    return least


def band_keys(signs: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band's number and minima; a row per signature."""
    shaped = signs.reshape(-1, BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(_NUMBERS, shaped.shape[:2])
    for k in range(ROWS):
        keys = mix(keys * np.uint64(0xFF51AFD7ED558CCD) + shaped[:, :, k])
    return keys


def set_hashes(sets: list[np.ndarray]) -> list[pa.Array]:
    """The size of each set, and two halves of a hash of the whole of it."""
    low = [int(mix(s).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
    high = [int(mix(s + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
    return [pa.array(x, pa.int64()) for x in ([len(s) for s in sets], low, high)]


def class_of() -> Column:
    """The number of a class of equal sets."""
    return F.xxhash64("low", "high", "n_shingles")


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """Per row: doc_id, n_shingles, two halves of a hash of the whole set, the bands and a sketch of the minima."""
    schema = StructType([*fields("doc_id n_shingles low high"), *fields(bands=BinaryType(), sketch=BinaryType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in sliced(batches, limit=TOGETHER):
            sets = shingle_sets(data, offsets, n)
            signs = np.array([minima(s) for s in sets]).reshape(-1, BANDS * ROWS)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), *set_hashes(sets), pa.array([x.tobytes() for x in band_keys(signs)], pa.binary()),
                    pa.array([x.tobytes() for x in signs.astype(np.uint8)], pa.binary()),
                ],
                schema.fieldNames(),
            )

    return mapped(docs.select(F.col("doc_id").cast("long"), "text"), work, schema)


def banded(leaders: DataFrame) -> DataFrame:
    """(band, doc_id): a row for each band of a class leader."""
    schema = StructType(fields("band doc_id"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                keys = joined(part.column("bands")).view(np.int64)
                docs = part.column("doc_id").take(pa.array(np.repeat(np.arange(part.num_rows), BANDS)))
                yield pa.RecordBatch.from_arrays([pa.array(keys), docs], ["band", "doc_id"])

    return mapped(leaders.select("doc_id", "bands"), work, schema)


def _zipped(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, zipped): texts as they travel to be compared, by the number of their class."""
    schema = StructType([*fields("n_shingles low high"), *fields(zipped=BinaryType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for _, data, offsets in sliced(batches, limit=TOGETHER):
            raw = data.tobytes()
            texts = [press.compress(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([*set_hashes(shingle_sets(data, offsets, n)), pa.array(texts, pa.binary())], schema.fieldNames())

    return mapped(docs.select("text"), work, schema).select(class_of().alias("doc_id"), "zipped")


def least_equal(similar: int) -> int:
    """Equal bytes of two sketches below which full sets aren't compared."""
    share = similar / 100
    return math.ceil(SKETCH * (share - DEVIATIONS * math.sqrt(share * (1 - share) / SKETCH)))


def _agreeing(pairs: DataFrame, sketches: DataFrame, similar: int) -> DataFrame:
    """Of ``pairs`` those whose sizes allow it and whose signatures agree enough."""
    schema = StructType(fields("u v"))
    least = least_equal(similar)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = (joined(batch.column(c)).reshape(-1, SKETCH) for c in ("u_sketch", "v_sketch"))
            keep = pa.array((u == v).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(keep)

    sized = _beside(pairs, sketches, "n_shingles", "sketch")
    near = f"100 * least(u_n_shingles, v_n_shingles) >= {similar} * greatest(u_n_shingles, v_n_shingles)"
    return mapped(sized.where(near).select("u", "v", "u_sketch", "v_sketch"), work, schema)


def _beside(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` with columns of ``table`` for both sides."""
    u, v = (table.select(F.col("doc_id").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in columns)) for x in "uv")
    return pairs.join(v, "v").join(u, "u")


class _Sets:
    """Full sets at hand in a task, as many as ``HELD`` allows."""

    def __init__(self, n: int, similar: int) -> None:
        self.n, self.similar = n, similar
        self.unzip = zstandard.ZstdDecompressor()
        self.held: dict[int, np.ndarray] = {}
        self.size = 0

    def make_room(self) -> None:
        if self.size > HELD:
            self.held.clear()
            self.size = 0

    def hold(self, docs: list[int], zipped: pa.Array) -> None:
        """Sets of documents that aren't held yet, worked out together."""
        new = {d: k for k, d in enumerate(docs) if d not in self.held}
        texts, size = {}, 0
        for d, k in new.items():
            texts[d] = self.unzip.decompress(zipped[k].as_py())
            size += len(texts[d])
            if size > SLICE or d == next(reversed(new)):
                ends = np.cumsum([0, *map(len, texts.values())])
                sets = shingle_sets(np.frombuffer(b"".join(texts.values()), np.uint8), ends, self.n)
                self.held.update(zip(texts, sets))
                self.size += sum(map(len, sets))
                texts, size = {}, 0

    def link(self, u: int, v: int) -> bool:
        a, b = self.held[u], self.held[v]
        both = np.intersect1d(a, b, assume_unique=True).size
        return 100 * both >= self.similar * (len(a) + len(b) - both)


def _linked(pairs: DataFrame, texts: DataFrame, n: int, similar: int) -> DataFrame:
    """Of ``pairs`` those that are similar enough on full sets."""
    schema = StructType(fields("u v"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(n, similar)
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                us, vs = part.column("u").to_pylist(), part.column("v").to_pylist()
                sets.make_room()
                sets.hold(us, part.column("u_zipped"))
                sets.hold(vs, part.column("v_zipped"))
                out += [at + k for k, (u, v) in enumerate(zip(us, vs)) if sets.link(u, v)]
            rows = pa.array(out, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("u").take(rows), batch.column("v").take(rows)], ["u", "v"])

    return mapped(_beside(pairs, texts, "zipped"), work, schema)


def _cells(known: DataFrame) -> DataFrame:
    """(cell, band, doc_id, component, centre): members of groups of several components, each met by every centre in one cell."""
    sizes = known.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = F.max(F.struct("n", "component"))
    grids = (
        sizes.groupBy("band")
        .agg(F.count(F.lit(1)).alias("components"), F.sum("n").alias("members"), largest.alias("largest"))
        .where("components > 1")
        .select(
            "band",
            F.col("largest.component").alias("home"),
            F.ceil(F.col("members") / BLOCK).alias("n_rows"),
            F.ceil((F.col("members") - F.col("largest.n")) / BLOCK).alias("n_columns"),
        )
    )
    dealt = known.join(grids, "band")
    place = F.xxhash64("doc_id")
    members = dealt.select(
        "band", "doc_id", "component", F.lit(False).alias("centre"),
        F.pmod(place, "n_rows").alias("row"), F.explode(F.sequence(F.lit(1), "n_columns")).alias("column"),
    )
    centres = dealt.where("component != home").select(
        "band", "doc_id", "component", F.lit(True).alias("centre"),
        F.explode(F.expr("sequence(0, n_rows - 1)")).alias("row"), (F.pmod(place, "n_columns") + 1).alias("column"),
    )
    # Should two cells share a hash, more pairs than needed are compared.
    return members.unionByName(centres).select(F.xxhash64("band", "row", "column").alias("cell"), "band", "doc_id", "component", "centre")


def _met(cells: DataFrame, sketches: DataFrame, texts: DataFrame, n: int, similar: int) -> DataFrame:
    """(u, v): links of full sets that tie each centre to every component it is similar to in a cell."""
    schema = StructType(fields("u v"))
    least = least_equal(similar)

    def linked(cell: pa.Table, sets: _Sets) -> Iterator[pa.RecordBatch]:
        docs, parts, sizes, band = (cell.column(c).to_numpy() for c in ("doc_id", "component", "n_shingles", "band"))
        signs = joined(cell.column("sketch").combine_chunks()).reshape(-1, SKETCH)
        bands = joined(cell.column("bands").combine_chunks()).view(np.int64).reshape(-1, BANDS)
        zipped = cell.column("zipped").combine_chunks()
        is_centre = cell.column("centre").to_numpy()
        centres, others = np.flatnonzero(is_centre), np.flatnonzero(~is_centre)
        step = max(1, SLICE // (SKETCH * max(1, len(others))))
        for at in range(0, len(centres), step):
            some = centres[at : at + step]
            low, high = np.minimum.outer(sizes[some], sizes[others]), np.maximum.outer(sizes[some], sizes[others])
            u, v = np.nonzero((parts[some][:, None] != parts[others]) & (100 * low >= similar * high))
            u, v = some[u], others[v]
            equal = (signs[u] == signs[v]).sum(axis=1)
            u, v, equal = (x[equal >= least] for x in (u, v, equal))
            # A pair of two centres is met from both sides, any other pair in each band it shares.
            first = (bands[u] == bands[v]).argmax(axis=1)
            now = bands[u, first] == band[u]
            u, v, equal = u[now], v[now], equal[now]
            if not len(u):
                continue
            sets.make_room()
            used = np.unique(np.concatenate((u, v)))
            sets.hold(docs[used].tolist(), zipped.take(pa.array(used)))
            tied, out = set(), []
            for k in np.argsort(-equal, kind="stable").tolist():
                a, b = int(docs[u[k]]), int(docs[v[k]])
                if (a, int(parts[v[k]])) not in tied and sets.link(a, b):
                    tied.add((a, int(parts[v[k]])))
                    out.append((max(a, b), min(a, b)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema.fieldNames())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, sets = None, _Sets(n, similar)
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            keys = table.column("cell").to_numpy()
            bounds = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()]
            for a, b in zip(bounds, bounds[1:]):
                yield from linked(table.slice(a, b - a), sets)
            # The last cell may go on in the next batch.
            rest = table.slice(bounds[-1])
        if rest is not None:
            yield from linked(rest, sets)

    signed = cells.join(sketches, "doc_id").join(texts, "doc_id")
    return mapped(signed.repartition("cell").sortWithinPartitions("cell"), work, schema)


def _labelled(df: DataFrame, labels: DataFrame, doc: str, name: str) -> DataFrame:
    """``df`` with the component of its column ``doc``, itself if nothing tied it."""
    own = small(labels.select(F.col("id").alias(doc), F.col("component").alias(name)))
    return df.join(own, doc, "left").withColumn(name, F.coalesce(name, doc))


def connected(leaders: DataFrame, docs: DataFrame, n: int, similar: int) -> DataFrame:
    """(id, component): the classes, by number, that verified links tie to one of a smaller number.

    ``leaders`` has a row for each class: its number as doc_id, its least document, bands and sketch.
    """
    bands = banded(leaders)
    crowded = bands.groupBy("band").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("b")).where("centre < b")
    members = cut(bands.join(crowded.select("band", "centre"), "band"))
    candidates = cut(members.select("doc_id").distinct())
    signed = leaders.join(small(candidates), "doc_id", "left_semi")
    sketches = cut(signed.select("doc_id", "n_shingles", "sketch", "bands"))
    # A class's text is that of its least document; a document with several texts has one of each of its classes.
    own = cut(signed.select(F.col("least").alias("doc_id")).distinct())
    texts = cut(_zipped(docs.join(small(own), "doc_id", "left_semi"), n).join(small(candidates), "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    # The least of each group is its first centre.
    first = members.where("doc_id != centre").select(F.col("doc_id").alias("u"), F.col("centre").alias("v")).distinct()
    labels = components(_linked(cut(_agreeing(first, sketches, similar)), texts, n, similar))
    known = cut(_labelled(members.select("band", "doc_id"), labels, "doc_id", "component"))
    links = _met(_cells(known), sketches, texts, n, similar).distinct()
    return components(links.unionByName(labels.select(F.col("id").alias("u"), F.col("component").alias("v"))))


class _Classes:
    """Documents by the class of their set, and the links between classes."""

    def __init__(self, docs: DataFrame, n: int, similar: int) -> None:
        alone = F.expr("n_shingles = 0 or doc_id is null")
        self.signed = cut(signatures(docs, n).withColumn("class", class_of()))
        #: Rows with a set and an id, and the others.
        self.rows = self.signed.where(~alone).select("doc_id", "n_shingles", "class")
        self.rest = self.signed.where(alone).select("doc_id", "n_shingles")
        # Copies are one row for each task before they meet, so that no class is hot, whatever it holds. The
        # turned number lets the joins with this table split the rows of a class.
        own = self.signed.where(~alone).groupBy(F.bitwise_not("class").alias("turned"))
        own = own.agg(F.min("doc_id").alias("least"), *(F.first(c).alias(c) for c in ("n_shingles", "bands", "sketch")))
        self.leaders = cut(own.select(F.bitwise_not("turned").alias("doc_id"), "least", "n_shingles", "bands", "sketch"))
        self.labels = connected(self.leaders, docs, n, similar)

    def by_id(self) -> DataFrame:
        """(u, v): classes that have a document in common, because its id stands beside several texts."""
        of = self.rows.select("doc_id", "class").distinct()
        least = of.groupBy("doc_id").agg(F.min("class").alias("v"), F.max("class").alias("w")).where("v < w").select("doc_id", "v")
        return cut(of.join(small(least), "doc_id").where("class != v").select(F.col("class").alias("u"), "v"))

    def components(self, labels: DataFrame) -> DataFrame:
        """(class, component, class_id, component_id): of all classes, their least document and the least of their component."""
        tied = labels.select(F.col("id").alias("doc_id"), "component")
        tied = tied.unionByName(labels.select(F.col("component").alias("doc_id"), "component").distinct())
        least = self.leaders.select("doc_id", "least")
        inside = cut(least.join(small(tied), "doc_id"))
        named = inside.groupBy("component").agg(F.min("least").alias("component_id"))
        named = inside.join(small(cut(named)), "component").select("doc_id", "component", "component_id")
        out = least.join(small(cut(named)), "doc_id", "left")
        return out.select(
            F.col("doc_id").alias("class"), F.coalesce("component", "doc_id").alias("component"),
            F.col("least").alias("class_id"), F.coalesce("component_id", "least").alias("component_id"),
        )


def groups(docs: DataFrame, n: int = 4, similar: int = SIMILAR) -> DataFrame:
    """Per row: doc_id, n_shingles, class_id (smallest doc_id with an equal set), component_id, kept."""
    with shuffles_dropped(docs.sparkSession):
        classes = _Classes(docs, n, similar)
        labels, by_id = classes.labels, classes.by_id()
        if not by_id.isEmpty():
            labels = components(labels.select(F.col("id").alias("u"), F.col("component").alias("v")).unionByName(by_id))
        named = classes.components(labels)
    linked = classes.rows.join(named, "class").select("doc_id", "n_shingles", "class_id", "component_id")
    rest = classes.rest.select("doc_id", "n_shingles", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(rest).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, n: int = 5, similar: int = SIMILAR) -> DataFrame:
    """One row of each component of equal and similar texts, that of its smallest doc_id; rows without words or id stay.

    Texts that only have a doc_id in common are no copies of each other, and both stay.
    """
    keep = (F.col("doc_id") == F.col("component_id")) & (F.col("doc_id") == F.col("class_id"))
    with shuffles_dropped(docs.sparkSession):
        classes = _Classes(docs, n, similar)
        named = cut(classes.rows.join(classes.components(classes.labels), "class").select("doc_id", "class", "component", "class_id", "component_id"))
        # Ids of several rows: which of them stays is a matter of the row, not of the id.
        several = cut(classes.signed.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"))
        dropped = cut(named.where(~keep).select("doc_id").distinct())
    once = docs.join(small(dropped), "doc_id", "left_anti").select(*docs.columns)
    if several.isEmpty():
        return once
    once = once.join(small(several), "doc_id", "left_anti").select(*docs.columns)
    # The least class of those that lead a component, and of its rows one.
    wanted = named.join(small(several), "doc_id", "left_semi").where(keep).groupBy("component")
    wanted = wanted.agg(F.min("class").alias("__class"), F.first("component_id").alias("__least"))
    wanted = small(cut(wanted.select("__class", "__least")))
    rows = _classed(docs.join(small(several), "doc_id", "left_semi").select(*docs.columns), n)
    leading = rows.join(wanted, "__class").where("doc_id = __least").dropDuplicates(["__class"])
    return once.unionByName(leading.select(*docs.columns)).unionByName(rows.where("__class is null").select(*docs.columns))


def _classed(docs: DataFrame, n: int) -> DataFrame:
    """``docs`` with the class of each row's text, null without words."""
    schema = StructType([*docs.schema.fields, *fields("__n __low __high")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in sliced(batches, limit=TOGETHER):
            yield pa.RecordBatch.from_arrays([*part.columns, *set_hashes(shingle_sets(data, offsets, n))], schema.fieldNames())

    number = F.when(F.col("__n") > 0, F.xxhash64("__low", "__high", "__n"))
    return mapped(docs, work, schema).select(*docs.columns, number.alias("__class"))
