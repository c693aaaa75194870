"""Lattices, long words and samples against plain versions."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

from starloom.llm import common, segmentations
from starloom.llm.queries import QUERIES

DOC = "doc_id long, text string, sample string, ids string"
LOG = 1e-9


def docs_of(spark, texts):
    return spark.createDataFrame([(k, t, "x", "y") for k, t in texts], DOC)


def vocabulary():
    return segmentations.vocabulary(segmentations.MODEL)


def plain(word, v):
    """All segmentations of a word with their probabilities."""
    model = v.model
    by_text = {model.id_to_piece(int(i)): (int(i), float(x)) for i, x in zip(v.ids, v.logs)}
    text = word.replace("▁", "\0").replace(" ", "▁")
    spell = lambda c: ([v.bytes[b] for b in ("▁" if c == "\0" else c).encode()], v.spell * len(("▁" if c == "\0" else c).encode()))

    def ways(at):
        if at == len(text):
            return [((), 0.0)]
        out = []
        for end in range(at + 1, min(len(text), at + v.longest) + 1):
            piece = text[at:end]
            if piece in by_text:
                ids, log = [by_text[piece][0]], by_text[piece][1]
            elif end == at + 1:
                ids, log = spell(text[at])
            else:
                continue
            out += [((*ids, *rest), log + more) for rest, more in ways(end)]
        return out

    found = ways(0)
    total = math.log(sum(math.exp(x) for _, x in found))
    return {ids: x - total for ids, x in found}


@pytest.mark.parametrize("word", [" abc", " the", "漢字", " a▁b", "\n", "   ", " é1x"])
def test_probabilities_and_samples_against_all_segmentations(word):
    v = vocabulary()
    want, w, n = plain(word, v), segmentations.Words(vocabulary()), 4000
    found = segmentations.top_k(w, [[word]] * n, common.mix(np.arange(n, dtype=np.uint64)), 3)
    seen = []
    for path, have, whole, _ in found:
        ids, ends = segmentations.piece_ids(w, path, n)
        rows = [tuple(ids[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])]
        assert have.sum() in (0, n) and (have.all() == (len(seen) < len(want)))
        if have.all():
            assert all(math.isclose(x, want[r], abs_tol=1e-9) for x, r in zip(whole, rows))
            seen.append(rows)
    for x, c in Counter(seen[0]).items():
        assert abs(c / n - math.exp(want[x])) < 5 * math.sqrt(math.exp(want[x]) / n) + 1e-3
    if len(seen) > 1:
        for (x, y), c in Counter(zip(*seen[:2])).items():
            p = math.exp(want[x] + want[y]) / -math.expm1(want[x])
            assert x != y and abs(c / n - p) < 5 * math.sqrt(p / n) + 1e-3


def test_long_words_step_by_step_as_in_arrays(monkeypatch):
    r = random.Random(5)
    words = [" " + "".join(r.choice("abcdeé漢12") for _ in range(k)) for k in (1, 30, 200, 700)]
    keys = common.mix(np.arange(3, dtype=np.uint64))
    results = []
    for long in (5, 1000):
        monkeypatch.setattr(segmentations, "LONG", long)
        w = segmentations.Words(vocabulary())
        results.append([(segmentations.piece_ids(w, p, 3)[0].tolist(), whole.round(6).tolist()) for p, _, whole, _ in segmentations.top_k(w, [words] * 3, keys, 2)])
    assert results[0] == results[1]


def test_a_word_of_a_million_characters(spark):
    r = random.Random(6)
    text = "".join(r.choice("abcdefghij0123456789+/") for _ in range(1_000_000))
    rows = segmentations.encode(docs_of(spark, [(1, text), (2, "ab漢" * 30_000), (3, " " * 30_000), (4, "word " * 200_000)])).collect()
    assert len(rows) == 8 and all(x["exact"] for x in rows)


def test_a_text_does_not_depend_on_its_neighbours(spark):
    r = random.Random(7)
    texts = [(k, " ".join(r.choice(["some", "words", "and", "more"]) for _ in range(r.randrange(40)))) for k in range(50)]
    key = lambda df: {(x["doc_id"], x["sample"]): (tuple(x["ids"]), round(x["inclusion"], 9)) for x in df.collect()}
    whole = key(segmentations.encode(docs_of(spark, texts).coalesce(1)))
    assert whole == key(segmentations.encode(docs_of(spark, texts[::-1]).repartition(7)))


def test_forgotten_words_come_again(spark, monkeypatch):
    r = random.Random(8)
    texts = [(k, " ".join(f"w{r.randrange(300)}" for _ in range(60))) for k in range(40)]
    key = lambda df: {(x["doc_id"], x["sample"]): tuple(x["ids"]) for x in df.collect()}
    want = key(segmentations.encode(docs_of(spark, texts).coalesce(1)))
    for name, value in (("WORDS", 50), ("CORE", 20), ("TOGETHER", 700), ("PLACES", 200)):
        monkeypatch.setattr(segmentations, name, value)
    assert key(segmentations.encode(docs_of(spark, texts).coalesce(1))) == want


def test_the_mark_of_a_blank_in_a_text(spark):
    rows = segmentations.decode(segmentations.encode(docs_of(spark, [(1, "a▁b ▁ c"), (2, "▁")]))).collect()
    assert {x["decoded"] for x in rows} == {"a▁b ▁ c", "▁"} and all(x["exact"] for x in rows)


def test_query_decodes_every_document(spark):
    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op5_segmentations"](spark, sf)
    assert rows.where("not exact").isEmpty()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    back = segmentations.decode(rows).join(docs, "doc_id").selectExpr("sample", "decoded = coalesce(text, '') AS same").collect()
    assert all(x["same"] for x in back) and sum(x["sample"] == 0 for x in back) == docs.count()
    two = rows.groupBy("doc_id").count().where("count = 2").count()
    assert two >= 0.95 * docs.count() and len(list(itertools.islice(back, 1)))
