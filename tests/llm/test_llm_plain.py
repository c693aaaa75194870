"""Queries without SQL against plain versions of their contracts, on the given tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from starloom.llm import personal_data, url_language
from starloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def column(table, *names):
    rows = pq.read_table(f"{SF}/{table}.parquet", columns=list(names)).to_pylist()
    return [tuple(r[n] for n in names) for r in rows]


# op3


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def url_rule(host, path):
    fitting = [(len(h + p), h + p, v) for h, p, v in url_language.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fitting)[1:] if fitting else (None, None)


def url_model(urls):
    """Log probability of each character after the two before, orders 0 to 2 blended, from plain counts."""
    size, seen = url_language.SIZE, [Counter(), Counter(), Counter()]
    followers = [defaultdict(Counter) for _ in range(3)]
    for codes in urls:
        for context, code in codes:
            for order in range(3):
                seen[order][context[2 - order :]] += 1
                followers[order][context[2 - order :]][code] += 1

    def p(context, code):
        below = 1 / size
        for order in range(3):
            c = context[2 - order :]
            if seen[order][c]:
                kinds = len(followers[order][c])
                below = (followers[order][c][code] + kinds * below) / (seen[order][c] + kinds)
        return below

    return p


def coded(host, path):
    text = host + path.lower()
    codes = [0, 0, *[url_language.LETTERS.find(c) + 1 for c in text]]
    return [(tuple(codes[k - 2 : k]), codes[k]) for k in range(2, len(codes))]


def test_urls_against_a_plain_model(spark):
    pages = column("pages", "page_id", "url")
    got = {r["page_id"]: r for r in QUERIES["op3_url_language"](spark, SF).collect()}
    assert len(got) == len(pages)
    want = {k: (*url_parts(u), *url_rule(*url_parts(u))) for k, u in pages}
    for k, (host, path, rule, verdict) in want.items():
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, rule)
        assert verdict is None or got[k]["verdict"] == verdict
    good, bad = (url_model([coded(h, p) for h, p, _, v in want.values() if v == kind]) for kind in ("allow", "block"))
    scores = {}
    for k, (host, path, rule, _) in want.items():
        if rule is None:
            codes = coded(host, path)
            scores[k] = sum(math.log(good(*x) / bad(*x)) for x in codes) / max(len(codes), 1)
            assert math.isclose(got[k]["score"], scores[k], abs_tol=1e-4)
    allowed = [s for k, s in scores.items() if got[k]["verdict"] == "allow"]
    blocked = [s for k, s in scores.items() if got[k]["verdict"] == "block"]
    assert not allowed or not blocked or min(allowed) > max(blocked) - 1e-4


# op8


def test_shards_keep_their_law(spark):
    docs = column("documents", "doc_id", "text")
    rows = QUERIES["op8_binpack"](spark, SF).collect()
    raw = {k: (t or "").encode() for k, t in docs}
    assert sorted(r["doc_id"] for r in rows) == sorted(raw) and {r["law"] for r in rows} == {"bytes"}
    load, slots, places = Counter({k: 0 for k in range(40)}), defaultdict(list), defaultdict(set)
    for r in rows:
        text = raw[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["grown_shard"]) == (len(text) + 16, zlib.crc32(text), None)
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        places[text].add(r["shard"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(load) == set(range(40))
    capacity = sum(load.values()) / 40
    whole = Counter()
    for text in raw.values():
        whole[text] += len(text) + 16
    assert all(len(s) == 1 for t, s in places.items() if whole[t] <= capacity)
    assert max(load.values()) - min(load.values()) <= 0.02 * capacity


# op10


def found_plainly(text):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for order, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            doubled = [d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits))]
            fits = {
                "email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                "card": 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0, "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fits:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}", kind))
    return sorted(out)


def test_base_spans_against_expressions():
    r = random.Random(11)
    for _ in range(4000):
        text = "".join(r.choice("0123456789 -+().@ab,4539578763621486"[: r.choice([12, 34])]) for _ in range(r.randrange(60)))
        want = [(a, k, int(s.split(":")[2])) for a, k, s, _ in found_plainly(text)]
        assert personal_data.base_spans(text) == want, text


def test_personal_data_against_expressions(spark):
    docs = dict(column("documents", "doc_id", "text"))
    rows = QUERIES["op10_personal_data"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        base = found_plainly(docs[r["doc_id"]] or "")
        text = ",".join(s for _, _, s, _ in base)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        kinds = Counter(k for *_, k in base)
        spans = r["spans"].split(",") if r["spans"] else []
        assert {s for _, _, s, _ in base} <= set(spans) and [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] >= [kinds[k] for k in ("email", "ip", "card", "phone")]


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, "http://a.org/fr/x"), (1, "http://a.org/fr/x"), (2, "x" * 100_000)]])
def test_odd_urls(spark, rows):
    pages = spark.createDataFrame([(*r, "h", "r") for r in rows], "page_id long, url string, host string, rule string")
    assert url_language.judge(pages).count() == len(rows)
