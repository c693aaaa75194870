"""Operators on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import (
    binpack,
    common,
    components,
    decontaminate,
    language_model,
    main_text,
    near_duplicates,
    personal_data,
    quality_rules,
    repeats,
    segmentations,
    url_language,
)

DOC = "doc_id long, text string, lang string, shard int, kept boolean, n_words long"


def docs_of(spark, texts):
    return spark.createDataFrame([(k, t, "en", 1, False, 9) for k, t in texts], DOC)


@pytest.fixture(scope="module")
def odd(spark):
    long_ = " ".join(f"word{k}" for k in range(20_000))
    return docs_of(spark, [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, long_), (5, long_), (7, "a"), (None, "é 漢字 \U0001f600")])


@pytest.fixture(scope="module")
def none(spark):
    return docs_of(spark, [])


OPERATORS = {
    "rules": lambda s, d: quality_rules.ledger(d),
    "near": lambda s, d: near_duplicates.groups(d),
    "repeats": lambda s, d: repeats.without_repeats(d),
    "shards": lambda s, d: binpack.shard(d, 4),
    "clean": lambda s, d: decontaminate.contaminated(d, s.createDataFrame([(1, "a b"), (2, None)], "item_id long, text string")),
    "personal": lambda s, d: personal_data.find(d),
    "model": lambda s, d: language_model.judge(d, s.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int")),
    "pieces": lambda s, d: segmentations.encode(d).where("sample = 0"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, odd, name):
    assert OPERATORS[name](spark, odd).count() == 8


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(spark, none, name):
    assert OPERATORS[name](spark, none).count() == 0


def test_pages_without_anything(spark):
    pages = spark.createDataFrame([(1, None, None), (2, "", ""), (3, "x", "<p>a")], "page_id long, url string, html string")
    assert [r["text"] for r in main_text.main_texts(pages).orderBy("page_id").collect()] == ["", "", "a"]
    assert {r["verdict"] for r in url_language.judge(pages).collect()} == {"allow"}
    assert main_text.main_texts(pages.limit(0)).count() == 0
    assert url_language.judge(pages.limit(0)).count() == 0


def test_main_text_keeps_the_article_alone():
    page = (
        "<head><title>t</title></head><nav>a b c</nav><article><header>h</header><h1>One &amp; two</h1><p>first\n line<br>more"
        "<aside>no</aside><p>second <b>bold</b></p><div class='comments'>c c</div><form>f</form></article><footer>z</footer>"
    )
    assert main_text.extract(page, {}) == "One & two\nfirst line more\nsecond bold"
    assert main_text.best_run([1, -3, 2, 2, -1, 1, -9, 3]) == (2, 4)


def test_urls(spark):
    rows = [
        (1, "http://A.example.NET/en/x?y", "example.net/en/", "allow"), (2, "http://example.net/de/", "net/", "block"),
        (3, "https://b.example.com/de/1#x", "example.com/de/", "block"), (4, "http://x.org/fr/", "org/fr/", "allow"),
        (5, "http://notexample.com/de/", None, None), (6, "no scheme", None, None), (7, "http://net/", "net/", "block"),
        (8, "http://net", None, None), (9, "http://x.net?q=/", None, None), (10, "http://x.net#/en/", None, None),
    ]
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    got = {r["page_id"]: r for r in url_language.judge(pages).collect()}
    for k, _, rule, verdict in rows:
        assert got[k]["rule"] == rule and (verdict is None or got[k]["verdict"] == verdict)
    assert (got[1]["host"], got[1]["path"]) == ("a.example.net", "/en/x") and got[6]["host"] == got[6]["path"] == ""


def test_url_model_tells_kinds_apart(spark):
    r = random.Random(3)
    name = lambda letters: "".join(r.choice(letters) for _ in range(12))
    rows = [(k, f"http://{name('abcd')}.org/fr/{name('abcd')}") for k in range(80)]
    rows += [(k + 80, f"http://{name('wxyz')}.net/{name('wxyz')}") for k in range(80)]
    rows += [(k + 160, f"http://{name('abcd')}.de/{name('abcd')}") for k in range(20)]
    rows += [(k + 180, f"http://{name('wxyz')}.de/{name('wxyz')}") for k in range(20)]
    got = {r["page_id"]: r["verdict"] for r in url_language.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    right = sum(got[k] == ("allow" if k < 180 else "block") for k in range(160, 200))
    assert right >= 38


def test_ablation_counts(spark):
    rows = spark.createDataFrame([(0,), (1,), (3,), (2,), (64,)], "failures long")
    got = {r["rule"]: r for r in quality_rules.ablation(rows, "base").collect()}
    assert (got["short"]["n_failed"], got["short"]["n_only_this"], got["short"]["n_kept_without"]) == (2, 1, 3)
    assert got["repeats"]["failed_with"] == 1


def test_kneser_ney_sums_to_one_and_both_ways_agree(spark):
    r = random.Random(1)
    texts = [(k, " ".join(r.choice(["the cat", "a dog", "sat on", "ran"]) for _ in range(30)), "en", 1, True, 1) for k in range(40)]
    texts += [(99, "|||| #### |||| ####", "en", 1, True, 1)]
    docs = spark.createDataFrame(texts, DOC)
    labels = spark.createDataFrame([(k, 1, 0) for k in range(40)], "doc_id long, quality int, toxic int")
    one, two = (
        {x["doc_id"]: x for x in language_model.judge(docs, labels, table_rows=n).collect()} for n in (10**6, 0)
    )
    for k, x in one.items():
        assert math.isclose(x["perplexity"], two[k]["perplexity"], rel_tol=1e-5)
    assert not one[99]["kept"] and all(one[k]["kept"] for k in range(40))
    assert {x["doc_id"] for x in language_model.accepted(docs, labels).collect()} == set(range(40))
    assert {x["doc_id"] for x in language_model.accepted(docs, labels, table_rows=0).collect()} == set(range(40))


def test_model_against_plain_formula(spark):
    counts = {(1, 2, 3, 4): 3, (1, 2, 3, 5): 1, (0, 2, 3, 4): 2, (0, 0, 2, 3): 4, (7, 2, 3, 4): 1}
    code = lambda g: sum(c << 6 * (len(g) - 1 - k) for k, c in enumerate(g))
    rows = spark.createDataFrame([("en", code(g), c) for g, c in counts.items()], "lang string, gram long, c long")
    got = {r["gram"]: r["logp"] for r in language_model.model(rows).collect()}
    levels = {4: counts}
    for k in (3, 2, 1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])

    def steps(level):
        n = Counter(level.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0
        usual = {1: 0.5, 2: 1.0, 3: 1.5}
        return {i: max(0, min(i - (i + 1) * y * n[i + 1] / n[i], i)) if n[i] and n[i + 1] else usual[i] for i in (1, 2, 3)}

    def p(g):
        if not g:
            return 1 / 64
        level, d = levels[len(g)], steps(levels[len(g)])
        inside = {x: c for x, c in level.items() if x[:-1] == g[:-1]}
        if not inside:
            return p(g[1:])
        c, total = level.get(g, 0), sum(inside.values())
        mass = sum(d[min(v, 3)] for v in inside.values())
        return max(0, c - (d[min(c, 3)] if c else 0)) / total + mass / total * p(g[1:])

    for g in counts:
        assert math.isclose(got[code(g)], math.log(p(g)), rel_tol=1e-9)


def test_segmentations_decode_and_are_distinct(spark):
    texts = [(1, "hello world"), (2, "Straße\nnaïve 漢字 \U0001f600  x "), (3, "  lead"), (4, "a" * 300)]
    rows = segmentations.decode(segmentations.encode(docs_of(spark, texts), k=4)).collect()
    want = dict(texts)
    assert all(r["decoded"] == want[r["doc_id"]] for r in rows)
    assert len({(r["doc_id"], tuple(r["ids"])) for r in rows}) == len(rows) == 16
    again = segmentations.encode(docs_of(spark, texts[::-1]), k=4).collect()
    assert {(r["doc_id"], r["sample"], tuple(r["ids"])) for r in again} == {(r["doc_id"], r["sample"], tuple(r["ids"])) for r in rows}
    assert all(0 < r["inclusion"] <= 1 for r in rows)


def test_segmentations_follow_their_probabilities():
    w, n = segmentations.Words(segmentations.vocabulary(segmentations.MODEL)), 6000
    first, second = segmentations.top_k(w, [[" abc"]] * n, common.mix(np.arange(n, dtype=np.uint64)), 2)
    names = []
    for path, *_ in (first, second):
        ids, ends = segmentations.piece_ids(w, path, n)
        names.append([tuple(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])])
    p = {**dict(zip(names[0], np.exp(first[2]))), **dict(zip(names[1], np.exp(second[2])))}
    for (x, y), c in Counter(zip(*names)).items():
        want = p[x] * p[y] / (1 - p[x])
        assert x != y and abs(c / n - want) < 4 * math.sqrt(want / n) + 1e-3


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{k: 1 for k in range(2, 41)}, **{100 + k: 100 for k in range(1, 30)}}


def test_near_duplicates_against_all_pairs(spark):
    r = random.Random(2)
    base = [[f"w{r.randrange(5000)}" for _ in range(120)] for _ in range(6)]
    texts = []
    for k in range(90):
        words = list(r.choice(base))
        for _ in range(r.randrange(9)):
            words[r.randrange(120)] = f"x{r.randrange(10**6)}"
        texts.append((k, " ".join(words[: r.choice([120, 118, 100])]).title()))
    sets = {}
    for k, t in texts:
        w = t.lower().split()
        sets[k] = {tuple(w[i : i + 4]) for i in range(len(w) - 3)}
    parent = {k: k for k in sets}
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = parent[a], parent[b]
            parent = {k: min(x, y) if v in (x, y) else v for k, v in parent.items()}
    got = {x["doc_id"]: x["component_id"] for x in near_duplicates.groups(docs_of(spark, texts)).collect()}
    assert got == parent


def test_repeats_against_plain_search(spark):
    r = random.Random(4)
    base = "".join(r.choice("abcdé ") for _ in range(400))
    texts = [(k, "".join(r.choice("abcdé ") for _ in range(60)) + base[(a := r.randrange(300)) : a + r.randrange(20, 120)]) for k in range(40)]
    texts += [(50, texts[3][1]), (51, "a" * 130), (52, "a" * 60)]
    first, want = {}, {}
    raw = {k: t.encode() for k, t in texts}
    for k in sorted(raw):
        for i in range(len(raw[k]) - 49):
            first.setdefault(raw[k][i : i + 50], k)
    for k, t in raw.items():
        gone = [False] * len(t)
        for i in range(len(t) - 49):
            if first[t[i : i + 50]] < k:
                gone[i : i + 50] = [True] * 50
        kept = bytes(b for b, g in zip(t, gone) if not g)
        want[k] = (len(t), sum(gone), sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1])), hashlib.sha256(kept).hexdigest())
    got = {x["doc_id"]: tuple(x[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) for x in repeats.without_repeats(docs_of(spark, texts)).collect()}
    assert got == want


def test_repeats_over_many_buckets(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = {tuple(x) for x in repeats.without_repeats(docs).collect()}
    monkeypatch.setattr(repeats, "BUCKET", 2_000)
    monkeypatch.setattr(repeats, "BLOCK", 100_000)
    assert {tuple(x) for x in repeats.without_repeats(docs.repartition(5)).collect()} == whole


def test_shards(spark):
    r = random.Random(6)
    texts = [(k, "t" * r.randrange(300) + str(k)) for k in range(800)] + [(1000 + k, "same text") for k in range(900)]
    rows = binpack.shard(docs_of(spark, texts), 10).collect()
    load, slots = Counter(), {}
    for x in rows:
        load[x["shard"]] += x["size"]
        slots.setdefault(x["shard"], []).append(x["slot"])
    assert len(rows) == 1700 and max(load.values()) - min(load.values()) <= 0.02 * sum(load.values()) / 10 + 320
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    # A group that a shard holds stays whole.
    few = binpack.shard(docs_of(spark, texts[:800] + [(2000 + k, "few copies") for k in range(30)]), 10)
    assert few.where("doc_id >= 2000").select("shard").distinct().count() == 1


def test_best_fit_takes_the_tightest():
    runs = binpack.plan([(6, 1, 6), (5, 1, 5), (4, 1, 4), (3, 1, 3), (2, 1, 2)], 2)
    load = Counter()
    for size, low, high, shard in runs:
        load[shard] += size * (high - low + 1)
    assert sorted(load.values()) == [10, 10]


def test_decontamination_in_shards_and_spans(spark):
    item = "one two three four five six seven eight nine ten eleven"
    bench = spark.createDataFrame([(k, f"{item} x{k}") for k in range(30)] + [(90, "Tiny, item!")], "item_id long, text string")
    text = "Pre ONE two; three four five six seven eight nine ten post. A tiny - ITEM"
    docs = docs_of(spark, [(1, text), (2, "tiny things")])
    for limit in (10**6, 20):
        got = {r["doc_id"]: r for r in decontaminate.contaminated(docs, bench, limit=limit).collect()}
        assert (got[1]["n_words"], got[1]["n_hit"], got[1]["item_ids"]) == (15, 12, [*range(30), 90])
        assert [text[a:b] for a, b in got[1]["spans"]] == ["ONE two; three four five six seven eight nine ten", "tiny - ITEM"]
        assert got[2]["n_hit"] == 0
    assert [r["doc_id"] for r in decontaminate.clean(docs, bench).collect()] == [2]


def test_base_patterns_against_expressions():
    r = random.Random(5)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(3000):
        text = "".join(r.choice("ab1259.@-+ (") for _ in range(r.randrange(40)))
        spans = personal_data.base_spans(text)
        assert [(a, b) for a, k, b in spans if k == 0] == [m.span() for m in email.finditer(text)]
        assert [(a, b) for a, k, b in spans if k == 1] == [
            m.span() for m in ip.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))
        ]
    assert personal_data.luhn("4539578763621486") and not personal_data.luhn("4539578763621487")


def test_field_finds_variants_and_leaves_the_rest(spark):
    r = random.Random(8)
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    texts = [(k, f"call +1 ({digits(3)}) 555-{digits(4)} or mail ab.{digits(2)}@mail{r.randrange(9)}.example.com in {2000 + k}") for k in range(60)]
    field = personal_data.trained(docs_of(spark, texts))
    base, more = personal_data.added_spans(["ring (206) 555-0199 at 10"], field), "ring (206) 555-0199 at 10"
    assert [more[a:b] for a, _, b in base[0]] == ["(206) 555-0199"]
    assert personal_data.added_spans(["plain words only", ""], field) == [[], []]
    masked = personal_data.redact(docs_of(spark, texts[:3])).collect()
    assert all("555" not in x["text"] and "[PHONE]" in x["text"] for x in masked)


def test_viterbi_against_all_paths():
    field = personal_data.fit([(["+1", "(206)", "555-0199"], [3, 3, 3]), (["10"], [4]), (["a@b.c"], [0])])
    run = ["+1", "10", "555-0199"]
    scores = field.scores([run])[0]
    value = lambda p: sum(scores[t, s] for t, s in enumerate(p)) + sum(field.move[a, b] for a, b in zip((4, *p), (*p, 4)))
    best = max(itertools.product(range(5), repeat=3), key=value)
    assert tuple(field.decode([run])[0]) == best


def test_functions_of_columns_that_clash(spark):
    docs = docs_of(spark, [(1, "some words here"), (2, "x")])
    assert quality_rules.ledger(docs).columns.count("n_words") == 1
    assert language_model.accepted(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).columns == docs.columns
    assert near_duplicates.deduplicated(docs).columns == docs.columns
    assert personal_data.redact(docs).columns == docs.columns
    assert docs.select(F.count(F.lit(1))).first()[0] == 2
