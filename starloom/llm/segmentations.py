"""SentencePiece encoding and decoding with distinct sampled segmentations: Gumbel top-k over the lattice.

A text's lattice has its characters as places and every vocabulary piece that fits as an edge.
Pieces never reach over white space, so a lattice is a row of small ones, one per word (with
the blanks before it), and words are kept at hand with their probabilities.

The k segmentations are drawn without replacement by a perturbed A-star search: a node is all
segmentations that begin in one way; its bound is the largest Gumbel-perturbed log probability
among them, drawn for the node as a whole. The best node is opened: its best segmentation is
drawn piece by piece, and the rest of it falls into nodes that leave that path at one place
each, with bounds drawn below its own. All texts of a batch take each step together in numpy.
A segmentation's inclusion score is the probability that its perturbed value beats the
(k+1)-th one. Random numbers are a hash of seed, doc_id and a counter, so a row's result
depends on nothing else.

The vocabulary is read from a model file by path. Scores of byte-pair models are ranks, so a
piece of rank r has a weight of 1 / (r + 10). A character without a piece is spelled in bytes.

Decoding joins pieces and is exact for every segmentation; encoding checks that for each of them.
A word of any length is worked on: its last characters with the others in arrays, the rest of it
place by place. Defined results: null and empty
texts have one empty segmentation with probability 1; texts with fewer than k segmentations
give as many as there are; repeated rows give equal results; null doc_id counts as -1; texts
of any length are encoded whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StructType

from starloom.llm.common import fields, mapped, mix, same_texts, sliced, spans_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
SEED = 7
#: Words kept at hand in a task, and their characters; when there are more, all but a core go, which has so many at most.
WORDS, PLACES = 80_000, 600_000
CORE, CORE_PLACES = 50_000, 400_000
#: Characters of a word, or pieces, that are worked on in arrays, all words together; the rest of longer ones goes step by step.
LONG = 96
#: Leading bits of a hash that find a piece.
SLOTS = 20
#: Lengths of beginnings by which places are left out that no longer piece can begin at, and leading bits of their hashes.
BEGINNINGS, BEGINNING_SLOTS = (2, 3, 5), 18
#: Bytes of text that are worked on together.
TOGETHER = 1 << 18
UNIT = re.compile(r"\n| *[^ \n]+| +")
_STEP = 0x9E3779B97F4A7C15
#: The mark that pieces have for a blank, and what stands for the mark itself in a text.
_MARK, _OWN_MARK = 0x2581, 0x110001


def uniform(keys: np.ndarray, counters: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from a key and a counter each."""
    x = mix(keys ^ mix(counters.astype(np.uint64) * np.uint64(_STEP) + np.uint64(SEED)))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


class Vocabulary:
    """Pieces by the hash of their characters, with log weights. It travels to the tasks as arrays, the model file does not."""

    def __init__(self, path: str) -> None:
        self.path = path
        m = self.model
        ids = [
            i for i in range(m.get_piece_size())
            if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))
        ]
        pieces = [m.id_to_piece(i) for i in ids]
        weight = 1.0 / (10.0 - np.minimum(0.0, [m.get_score(i) for i in ids]))
        logs = np.log(weight / weight.sum())
        self.longest = max(map(len, pieces))
        self.bytes = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.spelled = [
            bytes([int(p[3:5], 16)]) if m.is_byte(i) else b"" if m.is_control(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(map(m.id_to_piece, range(m.get_piece_size())))
        ]
        self.flat = np.frombuffer(b"".join(self.spelled), np.uint8)
        self.width = np.array([len(x) for x in self.spelled], np.int64)
        self.at = np.cumsum(self.width) - self.width
        # Spelling costs as much per byte as the rarest piece.
        self.spell = float(logs.min())
        hashes = np.array([self.hash_of(p) for p in pieces], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids, self.logs = hashes[order], np.array(ids, np.int32)[order], logs[order]
        # Slots by the leading bits of the mixed hash; a taken slot sends to the next one.
        self.slots = np.full((1 << SLOTS) + 64, -1, np.int32)
        self.probes = 1
        for k, slot in enumerate(self._slot(self.hashes).tolist()):
            at = slot
            while self.slots[at] >= 0:
                at += 1
            self.slots[at] = k
            self.probes = max(self.probes, at - slot + 1)
        # The longest piece of each beginning; beginnings that share a slot have the longest of all.
        self.reach = np.zeros(1 << BEGINNING_SLOTS, np.int8)
        for length in BEGINNINGS:
            longer = [p for p in pieces if len(p) > length]
            np.maximum.at(self.reach, self._slot(np.array([self.hash_of(p[:length]) for p in longer], np.uint64), BEGINNING_SLOTS), np.array(list(map(len, longer)), np.int8))

    @staticmethod
    def _slot(hashes: np.ndarray, bits: int = SLOTS) -> np.ndarray:
        return (mix(hashes) >> np.uint64(64 - bits)).astype(np.int64)

    @property
    def model(self):
        """The model itself, from its file."""
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=self.path)

    def decoded(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that the ids of texts spell, and their offsets."""
        out, edges = spans_of(self.flat, self.at[ids], self.width[ids])
        return out, np.concatenate(([0], edges))[ends]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``hashes`` are pieces', and the number of each of these pieces."""
        slot = self._slot(hashes)
        got = self.slots[slot]
        open_ = np.flatnonzero(got >= 0)
        hits, numbers = [], []
        for probe in range(self.probes):
            if probe:
                got = self.slots[slot[open_] + probe]
                open_, got = open_[got >= 0], got[got >= 0]
            else:
                got = got[open_]
            right = self.hashes[got] == hashes[open_]
            hits.append(open_[right])
            numbers.append(got[right])
            open_ = open_[~right]
            if not len(open_):
                break
        return np.concatenate(hits), np.concatenate(numbers)

    @staticmethod
    def hash_of(piece: str) -> int:
        out = 0
        for c in reversed(piece):
            out = (out * _STEP + ord(c) + 1) % (1 << 64)
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Words:
    """Lattices of words: per place its edges, shortest first, with piece, log chance given the place, and cumulated chances."""

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self.index = _Numbers()
        #: The first place of each word, and the first edge of each place.
        self.begin, self.first = np.zeros(1, np.int64), np.zeros(1, np.int64)
        #: How often each word came.
        self.came = np.zeros(0, np.int64)
        self.forgets = self.core = 0
        # With room for more edges behind those that are there.
        self.size, self.piece = np.zeros(1 << 16, np.int8), np.zeros(1 << 16, np.int32)
        self.log, self.cum = np.zeros(1 << 16), np.zeros(1 << 16)

    def numbers(self, units: list[str]) -> np.ndarray:
        """The number of each word's lattice, made if it isn't there."""
        if len(self.index) > WORDS or len(self.begin) and self.begin[-1] > PLACES:
            self._forget()
        known = len(self.index)
        out = np.array(list(map(self.index.__getitem__, units)), np.int64)
        if len(self.index) > known:
            self._add(list(islice(self.index, known, None)))
        came = np.bincount(out, minlength=len(self.index))
        came[:known] += self.came
        self.came = came
        return out

    def _forget(self) -> None:
        """Keep the core, chosen the first, second, fourth time and so on: the words that came most often, in the order they are in."""
        self.forgets += 1
        if self.forgets & (self.forgets - 1):
            self.index = _Numbers(islice(self.index.items(), self.core))
            self.begin = self.begin[: self.core + 1]
            self.first = self.first[: self.begin[-1] + 1]
            self.came = self.came[: self.core]
            return
        often = np.argsort(-self.came, kind="stable")[:CORE]
        often = often[np.cumsum(np.diff(self.begin)[often]) <= CORE_PLACES]
        stays = np.zeros(len(self.came), bool)
        stays[often] = True
        places = np.repeat(stays, np.diff(self.begin))
        counts = np.diff(self.first)
        edges = np.flatnonzero(np.repeat(places, counts))
        for name in ("size", "piece", "log", "cum"):
            old = getattr(self, name)
            old[: len(edges)] = old[edges]
        self.index = _Numbers(zip(compress(self.index, stays.tolist()), count()))
        self.begin = np.concatenate(([0], np.cumsum(np.diff(self.begin)[stays])))
        self.first = np.concatenate(([0], np.cumsum(counts[places])))
        self.came = self.came[stays]
        self.core = len(self.came)

    def _keep(self, **edges: np.ndarray) -> None:
        """Add edges behind the others."""
        used = int(self.first[-1])
        for name, new in edges.items():
            old = getattr(self, name)
            if used + len(new) > len(old):
                grown = np.zeros(max(used + len(new), len(old) * 3 // 2), old.dtype)
                grown[:used] = old[:used]
                setattr(self, name, old := grown)
            old[used : used + len(new)] = new

    def _add(self, words: list[str]) -> None:
        v = self.v
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        # A blank is the mark that pieces have for it; the mark itself, in a text, is spelled in bytes.
        points[points == _MARK] = _OWN_MARK
        points[points == 0x20] = _MARK
        lengths = np.array([len(w) for w in words])
        n = len(points)
        left = np.repeat(np.cumsum(lengths), lengths) - np.arange(n)
        place, size, piece, log, nth = [], [], [], [], []
        hashed, scale = np.zeros(n, np.uint64), np.uint64(1)
        at, room, edges = np.arange(n), left.copy(), np.zeros(n, np.int64)
        for length in range(1, v.longest + 1):
            at = at[room[at] >= length]
            if not len(at):
                break
            hashed[at] += (points[at + length - 1].astype(np.uint64) + np.uint64(1)) * scale
            scale = np.uint64(int(scale) * _STEP % (1 << 64))
            hit, number = v.find(hashed[at])
            if length == 1:
                # A character without a piece is spelled: its negative code point stands for the bytes.
                bare = np.ones(n, bool)
                bare[hit] = False
                bare = np.flatnonzero(bare)
                code = np.where(points[bare] == _OWN_MARK, _MARK, points[bare])
                place.append(bare)
                piece.append(-code.astype(np.int32) - 1)
                log.append(v.spell * (1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)))
                size.append(np.ones(len(bare), np.int8))
                nth.append(edges[bare])
                edges[bare] = 1
            place.append(at[hit])
            nth.append(edges[at[hit]])
            edges[at[hit]] += 1
            if length in BEGINNINGS:
                room[at] = np.minimum(room[at], v.reach[v._slot(hashed[at], BEGINNING_SLOTS)])
            piece.append(v.ids[number])
            log.append(v.logs[number])
            size.append(np.full(len(hit), length, np.int8))
        # Edges came by size: each goes behind the shorter ones of its place.
        first = np.concatenate(([0], np.cumsum(edges)))
        goes = first[np.concatenate(place)] + np.concatenate(nth)
        place = np.repeat(np.arange(n), edges)
        size, piece, log = (_put(np.concatenate(x), goes) for x in (size, piece, log))
        # Where each edge leads to; behind all places is the end of every word.
        to = place + size
        to[size == left[place]] = n
        total = _totals(left, first, to, log)
        log += total[to] - total[place]
        chance = np.cumsum(np.exp(log))
        chance -= np.concatenate(([0.0], chance))[first[place]]
        # The last edge is what is left, whatever rounding says.
        chance[first[1:] - 1] = 1.0
        self.begin = np.concatenate((self.begin, self.begin[-1] + np.cumsum(lengths)))
        self._keep(size=size, piece=piece, log=log, cum=chance)
        self.first = np.concatenate((self.first, self.first[-1] + first[1:]))

    def pick(self, place: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The edge of each place that a number in (0, 1) falls to."""
        edge = self.first[place]
        todo = np.flatnonzero(self.cum[edge] < number)
        while len(todo):
            edge[todo] += 1
            todo = todo[self.cum[edge[todo]] < number[todo]]
        return edge

    def edges(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All edges of some places, one place after the other, and where each place's begin and the last's end."""
        count = self.first[place + 1] - self.first[place]
        ends = np.concatenate(([0], np.cumsum(count)))
        return np.repeat(self.first[place] - ends[:-1], count) + np.arange(ends[-1]), ends


def _put(values: np.ndarray, goes: np.ndarray) -> np.ndarray:
    """``values``, each at its place."""
    out = np.empty_like(values)
    out[goes] = values
    return out


class _Numbers(dict):
    """Words by number, in the order they come."""

    def __missing__(self, word: str) -> int:
        self[word] = out = len(self)
        return out


def _totals(left: np.ndarray, first: np.ndarray, to: np.ndarray, log: np.ndarray) -> np.ndarray:
    """Per place the log sum over all ways to the end of its word, from the back, and 0 for the end itself."""
    total = np.zeros(len(left) + 1)
    short = np.flatnonzero(left <= LONG)
    # Edges in the order of their places, those next to the end first.
    order = short[np.argsort(left[short].astype(np.int16), kind="stable")]
    bounds = np.searchsorted(left[order], np.arange(1, LONG + 2))
    count = np.diff(first)[order]
    ends = np.concatenate(([0], np.cumsum(count)))
    edge = np.repeat(first[order] - ends[:-1], count) + np.arange(ends[-1])
    leads, logs = to[edge], log[edge]
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if low == high:
            continue
        a, b = ends[low], ends[high]
        begin = ends[low:high] - a
        value = logs[a:b] + total[leads[a:b]]
        top = np.maximum.reduceat(value, begin)
        total[order[low:high]] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, count[low:high])), begin))
    # What a long word has before its last places: a step for each place, without arrays.
    long = np.flatnonzero(left > LONG)[::-1]
    if len(long):
        sums, exp, ln = total.tolist(), math.exp, math.log
        for k in long.tolist():
            a, b = first[k], first[k + 1]
            value = [x + sums[y] for x, y in zip(log[a:b].tolist(), to[a:b].tolist())]
            top = max(value)
            sums[k] = top + ln(sum(exp(x - top) for x in value))
        total = np.array(sums)
    return total


class Path:
    """One segmentation per text, texts one after the other: where each piece begins (word, place), its edge, and log chances."""

    FIELDS = ("text", "word", "place", "edge", "log")

    def __init__(self, text, word, place, edge, log) -> None:
        self.text, self.word, self.place, self.edge, self.log = text, word, place, edge, log


def draw(w: Words, text: np.ndarray, word: np.ndarray, place: np.ndarray, end: np.ndarray, keys: np.ndarray, salt: int) -> Path:
    """A fresh segmentation of every stretch (text, word number in the batch, place, end of the word).

    ``keys`` are the words' own, so that a text's result does not depend on the texts beside it.
    """
    at = np.flatnonzero(place < end)
    text, word, place, end = text[at], word[at], place[at], end[at]
    own = keys[word]
    count = np.zeros(len(at), np.int64)
    parts, rest = [], []
    row, now, step = np.arange(len(at)), place, 0
    while len(row):
        if step >= LONG:
            rest = [(k, *_drawn_on(w, int(p), int(end[k]), own[k], step, salt)) for k, p in zip(row.tolist(), now.tolist())]
            for k, places, _ in rest:
                count[k] += len(places)
            break
        edge = w.pick(now, uniform(own[row], np.full(len(row), step + (salt << 56), np.uint64)))
        parts.append((row, now, edge))
        count[row] += 1
        now = now + w.size[edge]
        go = now < end[row]
        row, now = row[go], now[go]
        step += 1
    # A word's pieces follow each other: the n-th piece of each came in the n-th step.
    begin = np.cumsum(count) - count
    out_place, out_edge = np.empty(count.sum(), np.int64), np.empty(count.sum(), np.int64)
    for step, (row, now, edge) in enumerate(parts):
        out_place[begin[row] + step] = now
        out_edge[begin[row] + step] = edge
    for k, places, edges in rest:
        low = begin[k] + LONG
        out_place[low : low + len(places)], out_edge[low : low + len(places)] = places, edges
    return Path(np.repeat(text, count), np.repeat(word, count), out_place, out_edge, w.log[out_edge])


def _drawn_on(w: Words, place: int, end: int, key: np.uint64, step: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and edges of the rest of one long word, piece by piece without arrays."""
    edges, places = [], []
    low = int(w.first[place])
    cum, size = w.cum[low : int(w.first[end])].tolist(), w.size[low : int(w.first[end])].tolist()
    first = (w.first[place : end + 1] - low).tolist()
    begin, at, have = place, place, []
    while at < end:
        if not have:
            numbers = np.arange(step, step + 10_000, dtype=np.uint64) + np.uint64(salt << 56)
            have = uniform(np.full(len(numbers), key), numbers)[::-1].tolist()
            step += 10_000
        number, edge = have.pop(), first[at - begin]
        while cum[edge] < number:
            edge += 1
        edges.append(low + edge)
        places.append(at)
        at += size[edge]
    return np.array(places, np.int64), np.array(edges, np.int64)


def below(first: np.ndarray, log_mass: np.ndarray, u: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Largest perturbed value of a node of log probability ``first + log_mass``, given that it is under ``bound``."""
    with np.errstate(divide="ignore"):
        return -np.logaddexp(-bound, np.log(-np.log(u)) - (first + log_mass))


def top_k(w: Words, units: list[list[str]], keys: np.ndarray, k: int) -> list[tuple[Path, np.ndarray, np.ndarray, np.ndarray]]:
    """The k segmentations of all texts: path, which texts have it, log probability and inclusion score of each text."""
    n = len(units)
    counts = np.array([len(u) for u in units], np.int64)
    numbers = w.numbers([x for u in units for x in u])
    owner = np.repeat(np.arange(n), counts)
    begin, end = w.begin[numbers], w.begin[numbers + 1]
    occurrence = np.arange(len(numbers))
    # Random numbers of a word come from its text's key and its place in the text.
    nth = occurrence - np.repeat(np.cumsum(counts) - counts, counts)
    own_keys = mix(keys[owner] + nth.astype(np.uint64) * np.uint64(_STEP))
    texts = np.arange(n)
    bound = -np.log(-np.log(uniform(keys, np.full(n, 1))))
    path = draw(w, owner, occurrence, begin, end, own_keys, 0)
    rounds: list[dict] = []
    found = []
    alive = np.ones(n, bool)
    branch = np.full(n, -1)  # first own piece of the path, within the text
    for r in range(k):
        # log probability before each piece of the path
        edges = np.searchsorted(path.text, np.arange(n + 1))
        sums = np.concatenate(([0.0], np.cumsum(path.log)))
        before = sums[:-1] - sums[edges[path.text]]
        whole = sums[edges[1:]] - sums[edges[:-1]]
        found.append((path, alive.copy(), whole))
        index = np.arange(len(path.text)) - edges[path.text]
        own = np.flatnonzero(index > branch[path.text])
        text, at = path.text[own], path.edge[own]
        taken = np.exp(path.log[own])
        u = uniform(keys[text], index[own].astype(np.uint64) + np.uint64((r + 1) << 44) + np.uint64(1 << 62))
        with np.errstate(divide="ignore"):
            rest = np.log(np.maximum(0.0, 1.0 - taken))
            # Next to 1 the difference says nothing: the sum of the other edges, none only if there is no other.
            near = np.flatnonzero(taken > 1 - 1e-6)
            if len(near):
                edge, ends = w.edges(path.place[own[near]])
                others = np.where(edge == np.repeat(at[near], np.diff(ends)), 0.0, np.exp(w.log[edge]))
                rest[near] = np.log(np.add.reduceat(others, ends[:-1]))
        value = np.full(len(index), -np.inf)
        value[own] = below(before[own], rest, u, bound[text])
        # Of a node that is opened the sizes of the pieces that it no longer has, apart from its path's own.
        rounds.append({"path": path, "edges": edges, "before": before, "value": value, "used": np.zeros(len(index), np.int64)})
        # The best node of every text over all paths so far.
        best, which, where = np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for q, node in enumerate(rounds):
            lead = _first_largest(node["value"], node["edges"])
            got = np.where(lead >= 0, node["value"][np.maximum(lead, 0)] if len(node["value"]) else -np.inf, -np.inf)
            better = got > best
            best[better], which[better], where[better] = got[better], q, lead[better]
        bound, alive = best, np.isfinite(best)
        if r == k - 1:
            break
        parts, branch = [], np.full(n, np.iinfo(np.int64).max)
        for q, node in enumerate(rounds):
            mine = texts[alive & (which == q)]
            if len(mine):
                parts.append(_reopened(w, node, mine, where[mine], owner, occurrence, begin, end, keys, own_keys, r + 1, bound))
                branch[mine] = where[mine] - node["edges"][mine]
        columns = [np.concatenate([getattr(p, f) for p in parts]) if parts else getattr(path, f)[:0] for f in Path.FIELDS]
        # Within a word the pieces of all parts are in order already: what was kept, the new one, fresh ones.
        order = np.argsort(columns[1], kind="stable")
        path = Path(*(c[order] for c in columns))
    out = []
    for path, have, whole in found:
        with np.errstate(over="ignore"):
            # The last bound is the (k+1)-th value.
            score = np.where(np.isfinite(bound), -np.expm1(-np.exp(np.minimum(whole - bound, 700))), 1.0)
        out.append((path, have, whole, score))
    return out


def _first_largest(value: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Per text the index of its largest value, the first of equals; -1 without any."""
    out = np.full(len(edges) - 1, -1)
    have = np.flatnonzero(np.diff(edges))
    if len(have):
        most = np.maximum.reduceat(value, edges[have])
        hit = np.flatnonzero(value == np.repeat(most, np.diff(edges)[have]))
        text = np.searchsorted(edges, hit, "right") - 1
        first = np.unique(text, return_index=True)
        out[first[0]] = hit[first[1]]
    return out


def _reopened(w, node, mine, at, owner, occurrence, begin, end, keys, own_keys, r, bound) -> Path:
    """New paths of texts ``mine``: as ``node``'s path before ``at``, another piece there, then fresh ones."""
    path = node["path"]
    place, word = path.place[at], path.word[at]
    used = node["used"][at] | (1 << w.size[path.edge[at]].astype(np.int64))
    # Edges that are still open, place by place.
    edge, ends = w.edges(place)
    of = np.repeat(np.arange(len(mine)), np.diff(ends))
    open_ = np.where((used[of] >> w.size[edge].astype(np.int64)) & 1, 0.0, np.exp(w.log[edge]))
    sums = np.cumsum(open_)
    base = np.concatenate(([0.0], sums))[ends[:-1]]
    number = uniform(keys[mine], np.full(len(mine), r, np.uint64) + np.uint64(3 << 60)) * (sums[ends[1:] - 1] - base)
    past = np.add.reduceat((sums - base[of] < number[of]).astype(np.int64), ends[:-1])
    took = np.minimum(ends[:-1] + past, ends[1:] - 1)
    # Rounding can point to an edge that is not open: the likeliest one instead.
    bad = np.flatnonzero(open_[took] <= 0)
    for k in bad.tolist():
        took[k] = ends[k] + int(open_[ends[k] : ends[k + 1]].argmax())
    chosen_edge = edge[took]
    new = Path(mine, word, place, chosen_edge, w.log[chosen_edge])
    # What is left of the opened node: without this piece too, below the new bound.
    size = w.size[chosen_edge].astype(np.int64)
    node["used"][at] = used | (1 << size)
    open_[took] = 0
    left = np.add.reduceat(open_, ends[:-1])
    u = uniform(keys[mine], np.full(len(mine), r, np.uint64) + np.uint64(5 << 60))
    with np.errstate(divide="ignore"):
        node["value"][at] = np.where(left > 0, below(node["before"][at], np.log(left), u, bound[mine]), -np.inf)
    # Before: the same pieces. After: the rest of the word, then all later words.
    chosen = np.full(len(node["edges"]) - 1, -1)
    chosen[mine] = at
    same = np.arange(len(path.text)) < chosen[path.text]
    cut_word = np.full(len(node["edges"]) - 1, np.iinfo(np.int64).max)
    cut_word[mine] = word
    later = occurrence > cut_word[owner]
    fresh = draw(
        w,
        np.concatenate((mine, owner[later])),
        np.concatenate((word, occurrence[later])),
        np.concatenate((place + size, begin[later])),
        np.concatenate((end[word], end[later])),
        own_keys,
        r,
    )
    kept = Path(*(getattr(path, f)[same] for f in Path.FIELDS))
    return Path(*(np.concatenate([getattr(p, f) for p in (kept, new, fresh)]) for f in Path.FIELDS))


def piece_ids(w: Words, path: Path, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts' pieces one after the other, bytes spelled out, and offsets by text."""
    ids = w.piece[path.edge]
    if (ids >= 0).all():
        return ids, np.searchsorted(path.text, np.arange(n + 1))
    out, text = [], []
    spelled = {c: [w.v.bytes[b] for b in chr(-c - 1).encode("utf-8", "surrogatepass")] for c in np.unique(ids[ids < 0]).tolist()}
    counts = np.ones(len(ids), np.int64)
    bare = np.flatnonzero(ids < 0)
    counts[bare] = [len(spelled[c]) for c in ids[bare].tolist()]
    out = np.repeat(ids, counts)
    places = np.cumsum(counts) - counts
    for k in range(4):
        more = bare[counts[bare] > k]
        out[places[more] + k] = [spelled[c][k] for c in ids[more].tolist()]
    text = np.repeat(path.text, counts)
    return out.astype(np.int32), np.searchsorted(text, np.arange(n + 1))


def encode(docs: DataFrame, k: int = SAMPLES, model: str = MODEL, keep: bool = True) -> DataFrame:
    """Per row and segmentation: doc_id, sample, n_pieces, log_prob, inclusion, whether the pieces decode to the text, and their ids."""
    out = StructType([
        *fields("doc_id sample n_pieces"), *fields(log_prob=DoubleType(), inclusion=DoubleType(), exact=BooleanType()),
        *(fields(ids=ArrayType(IntegerType())) if keep else []),
    ])

    v = vocabulary(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = Words(v)
        for part, data, offsets in sliced(batches, limit=TOGETHER):
            texts = part.column("text").to_pylist()
            # A text as its pieces spell it: behind a blank, unless it is empty.
            given = np.insert(data, offsets[:-1][np.diff(offsets) > 0], 0x20)
            given_ends = offsets + np.concatenate(([0], np.cumsum(np.diff(offsets) > 0)))
            docs_ = part.column("doc_id").fill_null(-1).to_numpy()
            units = [UNIT.findall(" " + t) if t else [] for t in texts]
            keys = mix(docs_.astype(np.int64).view(np.uint64) + np.uint64(SEED))
            for number, (path, have, whole, score) in enumerate(top_k(w, units, keys, k)):
                ids, ends = piece_ids(w, path, len(texts))
                pick = np.flatnonzero(have)
                exact = same_texts(*w.v.decoded(ids, ends), given, given_ends) if have.all() else np.array([
                    np.array_equal(w.v.decoded(ids[ends[k] : ends[k + 1]], np.array([0]))[0], given[given_ends[k] : given_ends[k + 1]])
                    for k in range(len(texts))
                ])
                columns = [
                    part.column("doc_id").take(pa.array(pick)), pa.array(np.full(len(pick), number)),
                    pa.array(np.diff(ends)[pick].astype(np.int64)), pa.array(whole[pick]), pa.array(score[pick]), pa.array(exact[pick]),
                ]
                if keep:
                    # Texts without this segmentation have no pieces in it.
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate((ends[pick], ends[-1:])).astype(np.int32)), pa.array(ids, pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, out.fieldNames())

    return mapped(docs.select(F.col("doc_id").cast("long"), "text"), work, out)


def decode(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """``rows`` (with ids) and the text that the pieces spell."""
    schema = StructType([*rows.schema.fields, *fields(strings="decoded")])

    spelled = vocabulary(model).spelled

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                b"".join(map(spelled.__getitem__, ids or ())).decode("utf-8", "replace")[1:]
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema.fieldNames())

    return rows.mapInArrow(work, schema)
