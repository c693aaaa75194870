"""Alignment of two tokenizers: divide and conquer at shared cuts.

A text is encoded by a byte-level BPE (A) and by a SentencePiece model (B). Where tokens of both
end at the same byte is a cut; between cuts, tokens of both sides form a group.

1. Divide and conquer. An interval of A's tokens is cut at the shared end nearest to its middle:
   ends there are looked up among B's by bisection, first the middle one, then rings around it
   that double in width. Both halves go on; an interval without a shared end inside is a leaf, a
   group. All intervals of one depth are handled together in numpy.
2. Links are pairs of an A and a B token whose byte ranges overlap. For every pair of ids, a task
   counts the texts that hold it, by blocks of about ``BLOCK`` bytes of text; the counts are summed
   by pair, compared by A id, and sent back to the blocks that hold the pair. So what is shuffled
   is one row for each pair and block, not for each text, and no key has more rows than there are
   blocks. Blocks wait in the shared folder, compressed.

Long texts are encoded in stretches, cut at a blank between two ASCII letters or digits, where no
token of either side reaches over; without such a place a stretch is as long as it must be.

Both vocabularies are read once by path on the driver and broadcast (2 MB; a model's size).

Defined results: null and empty texts have no tokens, nor do texts that a side's tokens don't
spell exactly: all numbers 0 and an empty digest. Rows that share a doc_id are documents of their
own, repeated rows count as often as they stand; an empty table gives no rows; extra columns are
ignored. Strings of special tokens inside texts are ordinary text.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructType

from starloom.llm.common import fields, sliced
from starloom.session import cut

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text in a block.
BLOCK = 8 << 20
#: Bytes of text that are encoded together, and characters of a stretch of a long text.
TOGETHER, STRETCH = 1 << 18, 1 << 16
#: Where a long text may be cut.
_PLACE = re.compile(r"(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")
#: Fixed value: how a byte-level BPE parts a text before it merges.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NUMBERS = "n_a n_b n_groups n_links"


class Side:
    """A tokenizer's ids of texts and the bytes that each id spells."""

    def __init__(self, spelled: list[bytes]) -> None:
        self.spelled = spelled
        self.size = np.array([len(x) for x in spelled], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(spelled), np.uint8)

    def spells(self, ids: list[np.ndarray], raw: list[bytes]) -> np.ndarray:
        """For which texts the tokens' bytes, one after the other, are the text's."""
        have = np.array([int(self.size[x].sum()) == len(r) for x, r in zip(ids, raw)], bool)
        pick = np.flatnonzero(have).tolist()
        if pick:
            got, _ = spans(self.flat, *(c[np.concatenate([ids[k] for k in pick])] for c in (self.begin, self.size)))
            unlike = np.flatnonzero(got != np.frombuffer(b"".join(raw[k] for k in pick), np.uint8))
            ends = np.cumsum([len(raw[k]) for k in pick])
            have[np.array(pick)[np.searchsorted(ends, unlike, "right")]] = False
        return have


class ByteSide(Side):
    """A byte-level BPE. Where ids follow the order of the merges, as ranks do, they are encoded by rank, which is faster."""

    def __init__(self, model: bytes) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_buffer(model)
        self.model.encode_special_tokens = True
        rules = json.loads(model)
        # Byte-level vocabularies write printable bytes as themselves, the others as the characters from 256 on.
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte_of = {chr(b): b for b in printable}
        byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(printable))}
        names = {k: name for name, k in self.model.get_vocab(with_added_tokens=True).items()}
        # Only added tokens, which texts never get, have characters that stand for no byte.
        spell = lambda name: bytes(byte_of.get(c, 0) for c in name)
        super().__init__([spell(names.get(k, "")) for k in range(max(names) + 1)])
        self.ranked = self._ranked(rules)

    def _ranked(self, rules: dict):
        import tiktoken

        vocabulary, merges = rules["model"]["vocab"], rules["model"]["merges"]
        pairs = ("".join(x if isinstance(x, list) else x.split(" ")) for x in merges)
        first = len(vocabulary) - len(merges) - sum(x["id"] in vocabulary.values() for x in rules["added_tokens"])
        if any(vocabulary[x] != first + k for k, x in enumerate(pairs)) or rules["pre_tokenizer"].get("use_regex") is not True:
            return None
        ranks = {self.spelled[k]: k for k in vocabulary.values() if k < first + len(merges)}
        return tiktoken.Encoding("ranked", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})

    def ids(self, texts: list[str]) -> list:
        if self.ranked:
            return [self.ranked.encode_to_numpy(" " + t, disallowed_special=()) for t in texts]
        return [x.ids for x in self.model.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class PieceSide(Side):
    def __init__(self, model: bytes) -> None:
        import sentencepiece

        m = self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [m.id_to_piece(k) for k in range(m.get_piece_size())]
        super().__init__([bytes([int(p[3:5], 16)]) if m.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(names)])

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def spans(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all spans, one after the other, and where each ends."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat((begin - (ends - size)).astype(np.int32), size) + np.arange(total, dtype=np.int32)], ends


_SIDES: dict[int, tuple[ByteSide, PieceSide]] = {}


def sides_of(models: tuple[bytes, bytes]) -> tuple[ByteSide, PieceSide]:
    """The tokenizers of a task's process, made once."""
    key = hash(models)
    if key not in _SIDES:
        _SIDES.clear()
        _SIDES[key] = ByteSide(models[0]), PieceSide(models[1])
    return _SIDES[key]


def stretches(text: str, size: int) -> list[str]:
    """The text in parts of about ``size`` characters that tokenize by themselves; each but the first had a blank before it."""
    parts, at = [], 0
    while len(text) - at > size:
        place = _PLACE.search(text, at + size)
        if not place:
            break
        parts.append(text[at : place.start()])
        at = place.end()
    return [*parts, text[at:]]


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers of several ranges, and which range each is of."""
    count = np.maximum(0, high - low)
    owner = np.repeat(np.arange(len(low)), count)
    return low[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count), owner


def _among(values: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which values are in ``others``, by bisection."""
    return others[np.minimum(np.searchsorted(others, values), len(others) - 1)] == values


def near_middle(ends: np.ndarray, others: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each range of ``ends`` the place nearest to its middle whose value is among ``others`` too, or -1."""
    middle = (low + high - 1) // 2
    out = np.where(_among(ends[middle], others), middle, -1)
    todo = np.flatnonzero((out < 0) & (high - low > 1))
    inner, outer = 1, 3
    while len(todo):
        a, b, m = low[todo], high[todo], middle[todo]
        left, left_of = _ranges(np.maximum(a, m - outer + 1), np.maximum(a, np.minimum(b, m - inner + 1)))
        right, right_of = _ranges(np.minimum(b, m + inner), np.minimum(b, m + outer))
        place, of = np.concatenate((left, right)), np.concatenate((left_of, right_of))
        hit = np.flatnonzero(_among(ends[place], others))
        place, of = place[hit], of[hit]
        order = np.lexsort((place, np.abs(place - m[of]), of))
        found, first = np.unique(of[order], return_index=True)
        out[todo[found]] = place[order][first]
        # Rings go on where nothing was found and something is left outside.
        more = (m - outer >= a) | (m + outer < b)
        more[found] = False
        todo, inner, outer = todo[more], outer, 2 * outer + 1
    return out


def shared_cuts(ends: np.ndarray, others: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which tokens of one side, in texts that are its tokens ``low`` to ``high``, end where one of the other side ends."""
    cuts = np.zeros(len(ends), bool)
    some = high > low
    low, high = low[some], high[some]
    cuts[high - 1] = True
    while len(low):
        wide = high - low > 1
        low, high = low[wide], high[wide]
        at = near_middle(ends, others, low, high - 1)
        found = at >= 0
        low, high, at = low[found], high[found], at[found] + 1
        cuts[at - 1] = True
        # Both halves next to each other, so that the intervals stay in order.
        low, high = np.column_stack((low, at)).ravel(), np.column_stack((at, high)).ravel()
    return cuts


@lru_cache(maxsize=4)
def _decimals(most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the decimal text of each number up to ``most``, and room for a mark, begins, how long it is, and all of them."""
    texts = [b"%d " % k for k in range(most + 1)]
    size = np.array([len(t) for t in texts], np.int64)
    return np.cumsum(size) - size, size, np.frombuffer(b"".join(texts), np.uint8)


class Aligned:
    """Groups and links of some texts, one after the other; ``have`` says which texts have tokens."""

    def __init__(self, a: Side, b: Side, texts: list[str]) -> None:
        raw = [(" " + t).encode() for t in texts]
        ids = [side.ids(texts) for side in (a, b)]
        ids = [[np.asarray(x, np.uint32) for x in side] for side in ids]
        self.have = np.array([bool(t) for t in texts], bool) & a.spells(ids[0], raw) & b.spells(ids[1], raw)
        ids = [[x if h else x[:0] for x, h in zip(side, self.have.tolist())] for side in ids]
        self.count_a, self.count_b = (np.array([len(x) for x in side], np.int64) for side in ids)
        self.a, self.b = (np.concatenate(side).astype(np.int64) for side in ids)
        size_a = a.size[self.a]
        ends_a, ends_b = np.cumsum(size_a), np.cumsum(b.size[self.b])
        high = np.cumsum(self.count_a)
        cuts = np.flatnonzero(shared_cuts(ends_a, ends_b, high - self.count_a, high))
        self.text_a = np.repeat(np.arange(len(texts)), self.count_a)
        #: Past the last token of each group, on both sides, and each group's text.
        self.group_a, self.group_b = cuts + 1, np.searchsorted(ends_b, ends_a[cuts]) + 1
        self.group_text = self.text_a[cuts]
        first = np.searchsorted(ends_b, ends_a - size_a, "right")
        past = np.searchsorted(ends_b, ends_a) + 1
        self.link_b, self.link_a = _ranges(first, past)

    def n_groups(self) -> np.ndarray:
        return np.bincount(self.group_text, minlength=len(self.have))

    def n_links(self) -> np.ndarray:
        return np.bincount(self.text_a[self.link_a], minlength=len(self.have))

    def written(self) -> list[bytes]:
        """Each text's groups as ``a1,a2|b1;a3|b2``, ids in decimal."""
        if not len(self.a):
            return [b""] * len(self.have)
        group = lambda ends, n: np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[:n]
        # Where each token stands when groups follow each other, their A tokens first.
        before_b = np.concatenate(([0], self.group_b[:-1]))
        at_a = np.arange(len(self.a)) + before_b[group(self.group_a, len(self.a))]
        at_b = np.arange(len(self.b)) + self.group_a[group(self.group_b, len(self.b))]
        token = np.empty(len(self.a) + len(self.b), np.int64)
        token[at_a], token[at_b] = self.a, self.b
        mark = np.full(len(token), ord(","), np.uint8)
        mark[at_a[self.group_a - 1]], mark[at_b[self.group_b - 1]] = ord("|"), ord(";")
        begin, size, flat = _decimals(1 << int(token.max()).bit_length())
        out, ends = spans(flat, begin[token], size[token])
        out[ends - 1] = mark
        edges = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(self.count_a + self.count_b)))]
        flat = out.tobytes()
        return [flat[x : y - 1] if y > x else b"" for x, y in zip(edges[:-1].tolist(), edges[1:].tolist())]

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, links) for every pair of ids of a text, a pair being a * width + b."""
        pair = self.a[self.link_a] * width + self.b[self.link_b]
        text = self.text_a[self.link_a]
        order = np.lexsort((pair, text))
        pair, text = pair[order], text[order]
        new = np.flatnonzero(np.concatenate(([True], (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])))) if len(pair) else np.zeros(0, np.int64)
        return text[new], pair[new], np.diff(new, append=len(pair))


class _Block:
    """Aligned texts until they leave a task as one row."""

    def __init__(self, width: int) -> None:
        self.width, self.bytes = width, 0
        self.ids: list[pa.Array] = []
        self.numbers, self.digests, self.whole, self.links = [], [], [], []

    def open(self, ids: pa.Array) -> int:
        """Room for more texts; the number of the first."""
        first = len(self.digests)
        self.ids.append(ids)
        self.numbers += [np.zeros(4, np.int64) for _ in range(len(ids))]
        self.digests += [None] * len(ids)
        self.whole += [True] * len(ids)
        return first

    def add(self, numbers: list[int], aligned: Aligned) -> None:
        """Stretches of texts, in order."""
        counts = np.column_stack((aligned.count_a, aligned.count_b, aligned.n_groups(), aligned.n_links()))
        for text, have, count, groups in zip(numbers, aligned.have.tolist(), counts, aligned.written()):
            if not have:
                self.whole[text] = False
            elif self.digests[text] is None:
                self.digests[text] = hashlib.sha256(groups)
            else:
                self.digests[text].update(b";" + groups)
            self.numbers[text] += count
        text, pair, n = aligned.pairs(self.width)
        self.links.append((np.array(numbers, np.int64)[text], pair, n))

    def row(self) -> pa.RecordBatch:
        """Pairs, in how many texts each is, and the texts with their pairs by number."""
        whole = np.array(self.whole, bool)
        text, pair, n = (np.concatenate(x) for x in zip(*self.links)) if self.links else (np.zeros(0, np.int64),) * 3
        keep = whole[text]
        text, pair, n = text[keep], pair[keep], n[keep]
        # Stretches of one text may hold the same pair.
        order = np.lexsort((pair, text))
        text, pair, n = text[order], pair[order], n[order]
        if len(pair):
            new = np.flatnonzero(np.concatenate(([True], (pair[1:] != pair[:-1]) | (text[1:] != text[:-1]))))
            text, pair, n = text[new], pair[new], np.add.reduceat(n, new)
        pairs, number, docs = np.unique(pair, return_inverse=True, return_counts=True)
        numbers = np.where(whole[:, None], np.array(self.numbers, np.int64).reshape(-1, 4), 0)
        edges = pa.array(np.searchsorted(text, np.arange(len(whole) + 1)).astype(np.int32))
        batch = pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays(self.ids), *(pa.array(numbers[:, k]) for k in range(4)),
                pa.array([d.hexdigest() if d and w else "" for d, w in zip(self.digests, self.whole)], pa.string()),
                pa.ListArray.from_arrays(edges, pa.array(number.astype(np.int32))), pa.ListArray.from_arrays(edges, pa.array(n.astype(np.int32))),
            ],
            ["doc_id", *_NUMBERS.split(), "groups_sha256", "number", "n"],
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(batch)
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x.astype(np.int64))) for x in (pairs, docs)]
        return pa.RecordBatch.from_arrays([*lists, pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["pairs", "docs", "payload"])


def aligned_blocks(docs: DataFrame, models, stretch: int = STRETCH, block: int = BLOCK) -> DataFrame:
    """One row for each block of texts: its pairs, in how many texts each is, and the texts' own results."""
    schema = StructType([*fields(pairs=ArrayType(LongType()), docs=ArrayType(LongType()), payload=BinaryType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides_of(models.value)
        now = _Block(len(b.spelled))
        for part, _, offsets in sliced(batches, limit=TOGETHER):
            first = now.open(part.column("doc_id"))
            texts, numbers, size = [], [], 0
            for k, text in enumerate(part.column("text")):
                for x in stretches(text.as_py() or "", stretch):
                    texts.append(x)
                    numbers.append(first + k)
                    size += 4 * len(x)
                    if size > 4 * TOGETHER:
                        now.add(numbers, Aligned(a, b, texts))
                        texts, numbers, size = [], [], 0
            if texts:
                now.add(numbers, Aligned(a, b, texts))
            now.bytes += int(offsets[-1])
            if now.bytes >= block:
                yield now.row()
                now = _Block(len(b.spelled))
        if now.ids:
            yield now.row()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, schema)


def align(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, stretch: int = STRETCH, block: int = BLOCK) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    with open(byte_bpe, "rb") as x, open(piece_bpe, "rb") as y:
        read = x.read(), y.read()
    width = len(PieceSide(read[1]).spelled)
    models = docs.sparkSession.sparkContext.broadcast(read)
    blocks = cut(aligned_blocks(docs, models, stretch, block).withColumn("block", F.monotonically_increasing_id()))
    rows = blocks.select("block", F.inline(F.arrays_zip("pairs", "docs")).alias("pair", "docs"))
    counts = rows.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.expr(f"pair div {width}"))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    # The highest count of an A id is told by the sign.
    scored = counts.join(most, "a").select("pair", F.when(F.col("n") == F.col("most"), -F.col("n")).otherwise(F.col("n")).alias("n"))
    told = rows.join(scored, "pair").groupBy("block").agg(F.collect_list(F.struct("pair", "n")).alias("told"))
    out = StructType(fields(f"doc_id {_NUMBERS} n_best count_sum", "groups_sha256"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, told_ in zip(batch.column("payload"), batch.column("told")):
                texts = pa.ipc.open_stream(payload.as_py()).read_next_batch()
                if told_.is_valid:
                    pair, n = (told_.values.field(k).to_numpy() for k in (0, 1))
                    n = n[np.argsort(pair)]
                else:
                    n = np.zeros(0, np.int64)
                number, links = (texts.column(c).values.to_numpy() for c in ("number", "n"))
                edges = texts.column("number").offsets.to_numpy()
                count = n[number]
                sums = [np.diff(np.concatenate(([0], np.cumsum(x)))[edges]) for x in (np.where(count < 0, links, 0), np.abs(count) * links)]
                columns = [texts.column(c) for c in ("doc_id", *_NUMBERS.split())]
                columns += [*(pa.array(x.astype(np.int64)) for x in sums), texts.column("groups_sha256")]
                rows = pa.RecordBatch.from_arrays(columns, out.fieldNames())
                for k in range(0, rows.num_rows, 10_000):
                    yield rows.slice(k, 10_000)

    return blocks.select("block", "payload").join(told, "block", "left").select("payload", "told").mapInArrow(work, out)
