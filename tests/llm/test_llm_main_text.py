"""The run that sets the bounds of the main text, and what trims it."""

import random

import pyarrow.parquet as pq
import pytest

from starloom.llm import main_text
from starloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def words(n, name="word"):
    return " ".join(f"{name}{k}" for k in range(n))


def test_best_run_against_all_runs():
    r = random.Random(1)
    for _ in range(400):
        scores = [r.choice([-3, -1, 0, 1, 2]) for _ in range(r.randrange(12))]
        a, b = main_text.best_run(scores)
        best = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)), default=0)
        assert sum(scores[a:b]) == max(best, 0)


@pytest.mark.parametrize("text", ["if a < b", "I <3 you", "1<2", "a <= b < c", "<", "x <"])
def test_a_bare_angle_is_text(text):
    assert main_text.extract(f"<article><p>{text} {words(5)}</p></article>", {}) == f"{text} {words(5)}"


def test_compound_marks_inside_an_article():
    page = (
        f"<div class='page has-sidebar'><article class='post-ad-free'><p>{words(30)}</p><div class='ad-slot'>buy now</div>"
        f"<p>{words(30, 'more')}</p><div class='cookie_notice'>we bake</div><div class='no-ads'>{words(30, 'last')}</div>"
        "<section id='comment-list'><p>nice</p></section></article></div>"
    )
    assert main_text.extract(page, {}) == "\n".join([words(30), words(30, "more"), words(30, "last")])


def test_pages_without_an_article_are_cut_by_the_weights():
    page = f"<div class='menu'><a href='/'>home</a><a>about</a></div><div><p>{words(40)}</p><p>{words(30, 'more')}</p></div><div class='footer'>contact us</div>"
    assert main_text.extract(page, {}) == f"{words(40)}\n{words(30, 'more')}"


def test_the_weights_decide(spark):
    """With the words of the article as negative ones other texts come out, on the given pages and on one without an article."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    raw = pq.read_table(f"{SF}/pages.parquet").column("html").to_pylist()
    weights = main_text.trained(pages)
    turned = {k: -abs(v) if k[0] == "w" else v for k, v in weights.items()}
    learned = [main_text.extract(x, weights) for x in raw]
    page = f"<div class='a'>{words(20)}</div><div class='b'>{words(30, 'more')}</div>"
    one, two = ({"w:div": 0.0, "t:div": -0.5} | {"w:div": w} for w in (1.0, -1.0))
    assert main_text.extract(page, one) == f"{words(20)}\n{words(30, 'more')}" and main_text.extract(page, two) == ""
    assert sum(main_text.extract(x, turned) != t for x, t in zip(raw, learned)) > len(raw) / 2
    got = sorted((x["page_id"], x["text"], x["n_chars"]) for x in QUERIES["op1_main_text"](spark, SF).collect())
    ids = [r["page_id"] for r in pages.select("page_id").collect()]
    assert got == sorted((i, t, len(t)) for i, t in zip(ids, learned))


def test_the_given_pages_articles_are_found_whole(spark):
    """The words of each page's article, but for its marked parts, as another parser reads them."""
    from html.parser import HTMLParser

    class Article(HTMLParser):
        def __init__(self):
            super().__init__()
            self.depth, self.skip, self.words = 0, 0, []

        def handle_starttag(self, tag, attrs):
            marked = tag in main_text.NEVER or tag in ("script", "style") or set((dict(attrs).get("class") or "").split()) & main_text.ROLES
            if self.depth and (self.skip or marked) and tag not in main_text.VOID:
                self.skip += 1
            if tag == "article":
                self.depth += 1

        def handle_endtag(self, tag):
            if tag == "article":
                self.depth -= 1
            if self.skip and tag not in main_text.VOID:
                self.skip -= 1

        def handle_data(self, data):
            if self.depth and not self.skip:
                self.words += data.split()

    raw = [x for x in pq.read_table(f"{SF}/pages.parquet").column("html").to_pylist() if x]
    weights, same = main_text.fit(raw[:300]), 0
    for page in raw:
        plain = Article()
        plain.feed(page)
        same += main_text.extract(page, weights).split() == plain.words
    assert same >= 0.95 * len(raw)


def test_repeated_long_and_clashing_rows(spark):
    page = f"<article><p>{words(20_000)}</p></article>"
    rows = spark.createDataFrame([(1, "u", page, "x", 1), (1, "u", page, "y", 2), (None, None, "<p>a", "z", 3)], "page_id long, url string, html string, text string, n_chars int")
    out = main_text.main_texts(rows).collect()
    assert sorted(x["n_chars"] for x in out) == [1, len(words(20_000)), len(words(20_000))]
