"""The alignment of two tokenizers against a plain one."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from starloom.llm import alignment
from starloom.llm.queries import QUERIES

DOC = "doc_id long, text string, n_a string, block string, n string"


def docs_of(spark, texts):
    return spark.createDataFrame([(k, t, "x", "y", "z") for k, t in texts], DOC)


@pytest.fixture(scope="module")
def encoders():
    a = Tokenizer.from_file(alignment.BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_BPE)


def plain(texts, encoders):
    a, b = encoders
    shown = {chr(x): x for x in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    rest = iter(range(256, 400))
    shown |= {chr(next(rest)): x for x in range(256) if x not in set(shown.values())}
    rows, docs = [], Counter()
    for _, t in texts:
        ids_a = a.encode(" " + (t or ""), add_special_tokens=False).ids if t else []
        ids_b = b.encode(t) if t else []
        spelled_a = [bytes(shown.get(c, 0) for c in a.id_to_token(x)) for x in ids_a]
        spelled_b = [bytes([int(p[3:5], 16)]) if b.is_byte(x) else p.replace("▁", " ").encode() for x in ids_b for p in [b.id_to_piece(x)]]
        if not t or not b"".join(spelled_a) == b"".join(spelled_b) == (" " + t).encode():
            rows.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in spelled_a]).tolist(), np.cumsum([len(x) for x in spelled_b]).tolist()
        both = sorted(set(ends_a) & set(ends_b))
        groups, links, i, j = [], [], 0, 0
        for end in both:
            p, q = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append(",".join(map(str, ids_a[i:p])) + "|" + ",".join(map(str, ids_b[j:q])))
            for x in range(i, p):
                for y in range(j, q):
                    if ends_a[x] > ends_b[y] - len(spelled_b[y]) and ends_b[y] > ends_a[x] - len(spelled_a[x]):
                        links.append((ids_a[x], ids_b[y]))
            i, j = p, q
        docs.update(set(links))
        rows.append((len(ids_a), len(ids_b), groups, links))
    most = defaultdict(int)
    for (x, _), n in docs.items():
        most[x] = max(most[x], n)
    out = []
    for (k, _), row in zip(texts, rows):
        if row is None:
            out.append((k, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, groups, links = row
            best = sum(docs[x] == most[x[0]] for x in links)
            out.append((k, n_a, n_b, len(groups), len(links), best, sum(docs[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return Counter(out)


def found(df):
    assert df.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    return Counter(tuple(r) for r in df.collect())


def cases():
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdeéß漢字я\U0001f600.,-'0129") for _ in range(r.randrange(1, 9)))
    texts = [(k, r.choice([" ", "  ", "\n"]).join(word() for _ in range(r.randrange(1, 80)))) for k in range(60)]
    texts += [(61, "plain words that follow each other " * 200), (62, "same"), (62, "same"), (None, "same words"), (63, None), (64, ""), (65, " ")]
    texts += [(66, "<|endoftext|> and <s> </s> <unk> <0x41>"), (67, "a▁b"), (68, "x y　zﬁ é\t\r\n\x00"), (69, "漢字" * 500), (70, "it's we'll 12 345"), (71, "    lead and trail   ")]
    return texts


@pytest.mark.parametrize("stretch,block", [(1 << 16, 1 << 23), (50, 1000), (7, 1)])
def test_against_a_plain_alignment(spark, encoders, stretch, block):
    texts = cases()
    assert found(alignment.align(docs_of(spark, texts).repartition(3), stretch=stretch, block=block)) == plain(texts, encoders)


def test_long_texts_in_stretches(spark, encoders, monkeypatch):
    texts = [(1, " ".join(f"word{k} of, {k * 7}" for k in range(4000))), (2, "word1 of"), (3, "no▁ words " * 30)]
    monkeypatch.setattr(alignment, "TOGETHER", 300)
    assert found(alignment.align(docs_of(spark, texts), stretch=100)) == plain(texts, encoders)


def test_query_on_the_given_table(spark, encoders):
    sf = "/root/testdata/sf0.01"
    texts = [(x["doc_id"], x["text"]) for x in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert found(QUERIES["op11_alignment"](spark, sf)) == plain(texts, encoders)


def test_no_rows(spark):
    assert alignment.align(docs_of(spark, [])).count() == 0


def test_cuts_against_sets():
    r = np.random.default_rng(1)
    for _ in range(300):
        n = int(r.integers(1, 60))
        places = np.arange(1, n + 1)
        a, b = (np.unique(np.append(r.choice(places, r.integers(0, n + 1)), n)) for _ in range(2))
        cuts = alignment.shared_cuts(a, b, np.array([0]), np.array([len(a)]))
        assert a[cuts].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_the_cut_is_the_nearest_to_the_middle():
    ends = np.arange(1, 41)
    for others in ([3, 39, 40], [40], [1, 40], [20, 40], [19, 22, 40]):
        at = alignment.near_middle(ends, np.array(others), np.array([0]), np.array([39]))[0]
        inner = [x - 1 for x in others if x < 40]
        assert at == (min(inner, key=lambda x: (abs(x - 19), x)) if inner else -1)


def test_ids_by_rank_are_the_tokenizers(encoders):
    with open(alignment.BYTE_BPE, "rb") as file:
        side = alignment.ByteSide(file.read())
    assert side.ranked
    points = [chr(c) for c in range(0, 0x110000, 23) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}1 {c}{c} b  {c} x{c}'s" for c in points] + ["it's we'll I'D 1234567890 ...!? \r\n\t  end "]
    want = [x.ids for x in encoders[0].encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in side.ids(texts)] == want
