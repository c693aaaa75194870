"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns (e-mail, ip, card, phone) give the base spans. The field labels whole words with
one of these kinds or none, from what a word looks like and what its neighbours are, and
so finds variants that the patterns miss, such as phone numbers without a plus. It is trained
on a small labelled table: words around base spans of a bounded sample of documents, labelled
by the patterns, plus altered copies (a phone number without its prefix, an address with a
misplaced blank). Base spans always stay; a decoded span is added where it touches none.

A word without digit and ``@`` is never labelled. So the best path passes such words in the
state for none, and a text falls apart into short runs of other words, each decoded by itself
without changing the result. Runs of one length are decoded together by Viterbi in numpy.

Offsets are code points. Defined results: null and empty texts have no spans; repeated rows are
rows of their own; in documents of any length nothing is cut off; an empty table, or one from
which no example can be drawn, gives base spans alone.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.llm.common import fields

#: In the order that breaks ties between spans of one start.
KINDS = ("email", "ip", "card", "phone")
#: Documents, those with the smallest hashes, from which the labelled table is drawn.
SAMPLE_DOCS = 400
STEPS, RATE, DECAY = 150, 0.2, 1e-3
#: What the state for none gains where no example had the word's shape.
UNSEEN = 5.0

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never begins inside a run of digits whose first digit gave none, so that start is enough.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(begin, kind, end) of what the patterns find, in order of begin and kind."""
    if not HINT.search(text):
        return []
    found = [(a, 0, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


# --- The field -------------------------------------------------------------------------------

STATES = len(KINDS) + 1  # the last is none
NONE = len(KINDS)


def shape(word: str) -> str:
    """Digits as 9, runs of letters as a, all else as it is; longer runs of one sign are four."""
    out = re.sub(r"[0-9]", "9", re.sub(r"[^\W\d_]+", "a", word))
    return re.sub(r"(.)\1{4,}", r"\1\1\1\1", out)


def features(word: str) -> list[str]:
    s = shape(word.rstrip(".,;:!?"))
    digits = sum(c.isdigit() for c in word)
    return [
        f"s={s}",
        f"n={min(digits, 20)}",
        f"k={''.join(sorted(set(s)))}",
        f"d={min(s.count('.'), 4)}{'@' in s}{s.count('-')}",
        f"b={s[:2]}",
    ]


def is_plain(word: str) -> bool:
    return not HINT.search(word)


def chains(text: str) -> list[tuple[list[str], list[tuple[int, int]]]]:
    """Maximal runs of words that aren't plain, and their places."""
    if not HINT.search(text):
        return []
    out = []
    run: list[str] = []
    places: list[tuple[int, int]] = []
    for m in WORD.finditer(text):
        if is_plain(m[0]):
            if run:
                out.append((run, places))
                run, places = [], []
        else:
            run.append(m[0])
            places.append(m.span())
    if run:
        out.append((run, places))
    return out


class Field:
    """Weights of features by state, and of transitions; the chain is in state none before and after."""

    def __init__(self, index: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.index, self.emit, self.move = index, emit, move

    def scores(self, runs: list[list[str]]) -> np.ndarray:
        """Emission scores (runs, words, states) of runs of one length."""
        out = np.zeros((len(runs), len(runs[0]), STATES))
        for r, run in enumerate(runs):
            for t, word in enumerate(run):
                ids = [self.index[f] for f in features(word) if f in self.index]
                out[r, t] = self.emit[ids].sum(axis=0)
                if features(word)[0] not in self.index:
                    out[r, t, NONE] += UNSEEN
        return out

    def decode(self, runs: list[list[str]]) -> np.ndarray:
        """The best state of each word (runs, words), by Viterbi; the lower state of equals."""
        scores = self.scores(runs)
        n, length, _ = scores.shape
        best = scores[:, 0] + self.move[NONE]
        back = np.zeros((n, length, STATES), np.int64)
        for t in range(1, length):
            through = best[:, :, None] + self.move[None]
            back[:, t] = through.argmax(axis=1)
            best = through.max(axis=1) + scores[:, t]
        state = (best + self.move[:, NONE]).argmax(axis=1)
        path = np.zeros((n, length), np.int64)
        for t in range(length - 1, -1, -1):
            path[:, t] = state
            state = back[np.arange(n), t, state]
        return path


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def fit(examples: list[tuple[list[str], list[int]]]) -> Field | None:
    """Maximum likelihood with decay, by gradient steps over all examples at once (forward and backward sums)."""
    if not examples:
        return None
    index: dict[str, int] = {}
    for run, _ in examples:
        for word in run:
            for f in features(word):
                index.setdefault(f, len(index))
    emit, move = np.zeros((len(index), STATES)), np.zeros((STATES, STATES))
    groups = defaultdict(list)
    for run, labels in examples:
        groups[len(run)].append(([[index[f] for f in features(w)] for w in run], labels))
    sets = [(np.array([g[0] for g in v]), np.array([g[1] for g in v])) for v in groups.values()]
    seen = [np.zeros_like(emit), np.zeros_like(move)]
    total = len(examples)
    for _ in range(STEPS):
        d_emit, d_move = np.zeros_like(emit), np.zeros_like(move)
        for ids, labels in sets:
            n, length, _ = ids.shape
            scores = emit[ids].sum(axis=2)
            forward, backward = np.zeros((length, n, STATES)), np.zeros((length, n, STATES))
            forward[0] = scores[:, 0] + move[NONE]
            for t in range(1, length):
                forward[t] = _logsum(forward[t - 1][:, :, None] + move[None], 1) + scores[:, t]
            backward[-1] = move[:, NONE]
            for t in range(length - 2, -1, -1):
                backward[t] = _logsum((backward[t + 1] + scores[:, t + 1])[:, None, :] + move[None], 2)
            whole = _logsum(forward[-1] + backward[-1], 1)
            truth = np.eye(STATES)[labels]
            for t in range(length):
                rest = truth[:, t] - np.exp(forward[t] + backward[t] - whole[:, None])
                for f in range(ids.shape[2]):
                    np.add.at(d_emit, ids[:, t, f], rest)
                if t:
                    pair = forward[t - 1][:, :, None] + move[None] + (scores[:, t] + backward[t])[:, None, :]
                    d_move -= np.exp(pair - whole[:, None, None]).sum(axis=0)
                    np.add.at(d_move, (labels[:, t - 1], labels[:, t]), 1)
                else:
                    d_move[NONE] += rest.sum(axis=0)
            end = truth[:, -1] - np.exp(forward[-1] + backward[-1] - whole[:, None])
            d_move[:, NONE] += end.sum(axis=0)
        # Steps scaled by the gradients so far.
        for value, slope, past in ((emit, d_emit, seen[0]), (move, d_move, seen[1])):
            slope = slope - DECAY * total * value
            past += slope * slope
            value += RATE * slope / np.sqrt(past + 1e-8)
    return Field(index, emit, move)


def labelled(texts: list[str]) -> list[tuple[list[str], list[int]]]:
    """The labelled table: runs of words with a state each."""
    out = []
    for text in texts:
        spans = base_spans(text)
        for run, places in chains(text):
            states = []
            for a, b in places:
                hit = [kind for begin, kind, end in spans if begin < b and a < end]
                states.append(hit[0] if hit else NONE)
            out.append((run, states))
            first = next((k for k, s in enumerate(states) if s == 3), None)
            # The same phone number without its country prefix.
            if first is not None and run[first].startswith("+"):
                if first + 1 < len(run) and states[first + 1] == 3 and run[first + 1].startswith("("):
                    out.append((run[:first] + run[first + 1 :], states[:first] + states[first + 1 :]))
                elif len(NOT_DIGIT.sub("", run[first])) > 8:
                    out.append((run[:first] + [run[first][1:]] + run[first + 1 :], states))
    return out


def trained(docs: DataFrame, sample: int = SAMPLE_DOCS) -> Field | None:
    """A field from ``sample`` documents that hold a digit or an ``@``."""
    # Hashes first: only the chosen documents' texts leave their tasks.
    key = F.xxhash64("doc_id", F.substring("text", 1, 100))
    hinted = docs.where("text rlike '[0-9@]' and octet_length(text) < 100000")
    chosen = [r[0] for r in hinted.select(key.alias("key")).orderBy("key").limit(sample).collect()]
    rows = hinted.where(key.isin(chosen)).select("text").limit(2 * sample).collect() if chosen else []
    return fit(labelled(sorted(r["text"] for r in rows)))


def added_spans(texts: list[str], field: Field | None) -> list[list[tuple[int, int, int]]]:
    """Base and decoded spans of each text."""
    found = [base_spans(t) for t in texts]
    if field is None:
        return found
    by_length = defaultdict(list)
    for k, text in enumerate(texts):
        for run, places in chains(text):
            by_length[len(run)].append((k, run, places))
    for group in by_length.values():
        for at in range(0, len(group), max(1, 20_000 // len(group[0][1]))):
            part = group[at : at + max(1, 20_000 // len(group[0][1]))]
            for (k, _, places), path in zip(part, field.decode([run for _, run, _ in part])):
                found[k].extend(_spans(texts[k], places, path.tolist(), found[k]))
    return [sorted(set(x)) for x in found]


def _spans(text: str, places: list[tuple[int, int]], path: list[int], base: list[tuple[int, int, int]]):
    """Runs of one kind as spans without the punctuation around them, if they touch no base span."""
    t = 0
    while t < len(path):
        end = t + 1
        if path[t] != NONE:
            # A card, ip or e-mail is one word; a phone number may be several.
            while path[t] == 3 and end < len(path) and path[end] == 3:
                end += 1
            a, b = places[t][0], places[end - 1][1]
            while b > a and text[b - 1] in ".,;:!?\"'":
                b -= 1
            if a < b and not any(begin < b and a < stop for begin, _, stop in base):
                yield a, path[t], b
        t = end


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


_FOUND = StructType(fields("n_email n_ip n_card n_phone", "base_sha256 spans masked"))


def find(docs: DataFrame, field: Field | None = None, mask: bool = False) -> DataFrame:
    """Per row: doc_id, counts of base spans, their digest, all spans, and the masked text if asked for."""
    field = trained(docs) if field is None else field
    keep = [f for f in _FOUND.fieldNames() if mask or f != "masked"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = []
            for text, spans in zip(texts, added_spans(texts, field)):
                base = base_spans(text) if spans else []
                counts = [sum(1 for s in base if s[1] == k) for k in range(len(KINDS))]
                digest = hashlib.sha256(spelled(base).encode()).hexdigest()
                rows.append((*counts, digest, spelled(spans), masked(text, spans) if mask else None))
            columns = list(zip(*rows)) if rows else [[] for _ in _FOUND.fieldNames()]
            named = dict(zip(_FOUND.fieldNames(), columns))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(named[k], pa.string() if k in ("base_sha256", "spans", "masked") else pa.int64()) for k in keep)],
                ["doc_id", *keep],
            )

    schema = StructType([*fields("doc_id"), *(f for f in _FOUND.fields if f.name in keep)])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, schema)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one."""
    out, done = [], 0
    for a, kind, b in sorted(spans):
        if a >= done:
            out.append(text[done:a] + f"[{KINDS[kind].upper()}]")
        done = max(done, b)
    return "".join(out) + text[done:]


def redact(docs: DataFrame) -> DataFrame:
    """The rows with their own columns, the text masked and n_chars, if there is one, counted anew; null stays null."""
    field = trained(docs)
    names = docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            spans = added_spans([t or "" for t in texts], field)
            new = [t if not s else masked(t, s) for t, s in zip(texts, spans)]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    out = docs.mapInArrow(work, docs.schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*names)
