"""Repeated word sequences against a plain search."""

import hashlib
import random
import re
from collections import Counter

import pytest

from starloom.llm import substrings
from starloom.llm.queries import QUERIES

DOC = "doc_id long, text string, key long, tag string, n_words string"


def docs_of(spark, texts):
    return spark.createDataFrame([(k, t, 1, "x", "y") for k, t in texts], DOC)


def plain(texts, window):
    rows = [(k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in texts]
    seen = Counter(tuple(w[i : i + window]) for _, w in rows for i in range(len(w) - window + 1))
    out = []
    for k, w in rows:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((k, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def found(df):
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect())


def cases():
    r = random.Random(3)
    word = lambda n=40: r.choice("abcdé漢") + str(r.randrange(n))
    base = [word(4000) for _ in range(400)]
    texts = []
    for k in range(60):
        a, n = r.randrange(330), r.choice([20, 34, 35, 36, 50, 70])
        texts.append((k, " ".join([word(4000) for _ in range(r.randrange(50))] + base[a : a + n] + [word(4000) for _ in range(r.randrange(50))])))
    # Copies, a copy with one other word, a repeated row, one word many times, a period, only a part twice in one text.
    texts += [(100 + k, " ".join(base[:120])) for k in range(4)] + [(100, " ".join(base[:120]))]
    texts += [(110, " ".join([*base[:60], "other", *base[61:120]])), (111, "\t".join(base[:36])), (112, "  ".join(base[:40]))]
    texts += [(120, "a " * 90), (121, "a " * 35), (122, "b " * 35), (123, "b " * 36), (124, "x y z " * 30), (125, " ".join(base[300:350] + ["cut"] + base[300:350]))]
    return texts + [(130, None), (131, ""), (132, " \n\t\x0b"), (None, " ".join(base[200:260])), (None, "short one"), (None, "short one")]


@pytest.mark.parametrize("window,gram", [(35, 8), (35, 1), (35, 35), (12, 4)])
def test_against_plain_search(spark, window, gram):
    texts = cases()
    assert found(substrings.without_repeats(docs_of(spark, texts).repartition(5), window, gram)) == plain(texts, window)


def test_stretches_of_a_long_text(spark, monkeypatch):
    r = random.Random(5)
    words = [f"w{r.randrange(3000)}" for _ in range(9000)]
    texts = [(1, " ".join(words)), (2, " ".join(words[4000:4100])), (3, " ".join(f"w{r.randrange(3000)}" for _ in range(9000))), (4, " ".join(words[980:1040]))]
    monkeypatch.setattr(substrings, "STEP", 1000)
    assert found(substrings.without_repeats(docs_of(spark, texts))) == plain(texts, 35)


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = [(x["doc_id"], x["text"]) for x in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert found(QUERIES["op13_substrings"](spark, sf)) == plain(texts, 35)


def test_texts_that_are_left_and_no_rows(spark):
    r = random.Random(8)
    base = [f"w{r.randrange(10**6)}" for _ in range(40)]
    rows = substrings.without_repeats(docs_of(spark, [(1, " ".join(["one", *base, "two"])), (2, " ".join(base))]), texts=True).collect()
    assert {x["doc_id"]: x["text"] for x in rows} == {1: "one two", 2: ""}
    assert substrings.without_repeats(docs_of(spark, [])).count() == 0
