"""Main text of HTML pages by the maximum-scoring subsequence of their tokens.

A page is a sequence of words and tags. A word scores by where it stands (nearest block
element with its class, inside a link or not), a tag by its name; words of the main text come
out positive, tags and the words of menus and the like negative. One linear scan finds the
contiguous run with the highest sum. The weights are log odds from labelled pages: a bounded
sample whose own mark-up (``article``, ``main``) labels its tokens; pages without such
elements are cut by the weights alone.

The run sets the bounds of the text, blocks that it touches being taken whole. An exact check
mends it: where it touches ``article`` or ``main`` elements, what is outside of these goes, other
blocks of these come in if their words score positive by themselves, and out go blocks in elements that never hold main text (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles, reader comments). A class, id or role marks such an element by a
whole word between blanks, inside a main element also by a part of a compound word; ``html``, ``body``, ``main`` and
``article`` are never marked, nor is a marked element or a form around an ``article`` or ``main``,
unless it is itself inside an ``article`` (reader comments are articles in one).

Defined results: null and empty html give an empty text; unclosed elements end with the page;
broken tags are text or dropped like browsers do, never an error; character references are
decoded once; repeated rows are pages of their own; extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages, those with the smallest hashes of page_id, on which the weights are fitted.
SAMPLE_PAGES = 300
#: Bounds of a word's and a tag's weight.
WORD_MOST, TAG_MOST = 4.0, 0.2

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|iframe|svg|math|object|select)\b[^<>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^<>]*+)>"
    r"|<[!?/][^<>]*+>"
    r"|([^<]++)"
    r"|<",
    re.S | re.I,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
# Elements by their role in HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary "
    "table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("nav header footer aside form head title button menu dialog".split())
MAIN = frozenset(("article", "main"))
#: Elements that no class, id or role marks.
UNMARKED = frozenset(("html", "body", *MAIN))
#: Words of class, id or role, whole ones, that mark an element without main text.
ROLES = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments complementary contentinfo "
    "cookie cookies footer header menu navbar nav navigation newsletter notice notices popup promo promoted related "
    "search share sharing sidebar social sponsor sponsored subscribe toolbar".split()
)
#: Of these, what also marks as a part of a compound word (``ad-slot``, ``cookie_notice``), unless that begins with a
#: word that denies it or tells of something else on the page (``no-ads``, ``has-sidebar``).
PARTS = ROLES - {"header", "menu", "search"}
DENIES = frozenset("has hide is no non not show with without".split())
COMPOUND = re.compile("[-_]+")
#: An end tag of the first closes an open one of the second, and so does a start tag.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}


class Token:
    """A run of words or a tag: its score's key, how many words, and what the page says of its place."""

    __slots__ = ("block", "key", "main", "never", "tag", "text", "words")

    def __init__(self, key, text, words, block, never, main, tag):
        self.key, self.text, self.words, self.block = key, text, words, block
        self.never, self.main, self.tag = never, main, tag


def names_of(attributes: str) -> set[str]:
    """The words between blanks of class, id and role."""
    return {w for m in NAMED.finditer(attributes) for w in "".join(filter(None, m.groups())).lower().split()}


def marks_of(attributes: str, inside: bool) -> set[str]:
    """The marks that class, id and role give; inside a main element also as a part of a compound word."""
    names = names_of(attributes)
    marks = names & ROLES
    if inside:
        for parts in map(COMPOUND.split, names):
            if len(parts) > 1 and parts[0] not in DENIES:
                marks |= PARTS.intersection(parts)
    return marks


def tokens(page: str | None, around: frozenset[int] = frozenset()) -> list[Token]:
    """The words and tags of a page in order. ``block`` numbers the stretches of text without a block tag between.

    ``around`` has the numbers of the marked elements that a first pass found around an article or main element.
    """
    out: list[Token] = []
    # (name, whether it never holds main text, number of the enclosing main element, key for its words, number if marked)
    stack: list[tuple[str, bool, int, str, int]] = [("", False, 0, "-", 0)]
    block = mains = links = marked = 0
    found: set[int] = set()
    for m in TOKEN.finditer(page or ""):
        raw, end, name, attributes, end2, name2, attributes2, text = m.groups()
        if m[0] == "<":
            # Before anything but a letter, "!", "?" or "/" it is text.
            text = "<"
        if text is not None:
            decoded = html.unescape(text)
            n = len(decoded.split())
            key = f"w:{stack[-1][3]}{':a' if links else ''}"
            out.append(Token(key, decoded, n, block, stack[-1][1], stack[-1][2], False))
            continue
        if raw is not None or (name is None and name2 is None):
            continue
        name = (name or name2).lower()
        end = end if m.group(3) else end2
        attributes = attributes if m.group(3) else attributes2
        if name in BLOCKS:
            block += 1
        if name == "br":
            # White space inside a block.
            out.append(Token("t:br", " ", 0, block, stack[-1][1], stack[-1][2], True))
            continue
        out.append(Token(f"t:{name}", "", 0, block, stack[-1][1], stack[-1][2], True))
        if name == "a":
            links = 0 if end else 1
        if name in VOID or name not in BLOCKS and name != "a":
            continue
        if name == "a":
            continue
        if end:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
                # An end tag doesn't reach out of the main element it is in, unless it ends that.
                if stack[k][0] in MAIN and name not in ("body", "html", *MAIN):
                    break
            if name in NEVER or name in MAIN:
                links = 0
            continue
        if attributes.rstrip().endswith("/") and name not in BLOCKS:
            continue
        if name in CLOSES and stack[-1][0] in CLOSES[name]:
            stack.pop()
        # A paragraph ends where the next block begins; it never holds one.
        if stack[-1][0] == "p":
            stack.pop()
        _, never, main, *_ = stack[-1]
        marks = marks_of(attributes, bool(main)) if attributes and name not in UNMARKED else set()
        number = 0
        if marks and name not in NEVER or name == "form":
            marked += 1
            number = marked
        if number in around:
            marks, number = set(), 0
        elif name in NEVER or marks:
            never = True
        if name in MAIN:
            for outer in stack:
                if outer[0] == "article":
                    break
                if outer[4]:
                    found.add(outer[4])
        if name in MAIN and not main and not never:
            mains += 1
            main = mains
        stack.append((name, never, main, ".".join([name, *sorted(marks)]), number))
    return tokens(page, frozenset(found)) if found else out


def fit(pages: list[str]) -> dict[str, float]:
    """Weights by key from pages whose mark-up tells the main text."""
    good, bad = Counter(), Counter()
    for page in pages:
        found = tokens(page)
        if not any(t.main for t in found):
            continue
        for t in found:
            (good if t.main and not t.never else bad)[t.key] += max(t.words, 1 if t.tag else 0)
    weights = {}
    for key in {*good, *bad}:
        odds = math.log((good[key] + 1) / (bad[key] + 1))
        if key[0] == "w":
            weights[key] = max(-WORD_MOST, min(WORD_MOST, odds))
        else:
            weights[key] = max(-1.0, min(-TAG_MOST, odds / 4 - TAG_MOST))
    return weights


def weight(t: Token, weights: dict[str, float]) -> float:
    """Log odds if the sample had the key, else a guess from the kind of place."""
    if t.tag:
        return weights.get(t.key, -0.5)
    known = weights.get(t.key)
    if known is None:
        known = -2.0 if t.never else -0.5 if t.key.endswith(":a") else 1.0
    return known * t.words


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and past-last index of the contiguous run with the highest sum; the first of equals, empty if none is positive."""
    best = total = 0.0
    begin = at = to = 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, k
        total += s
        if total > best:
            best, at, to = total, begin, k + 1
    return at, to


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The main text: blocks in page order, one line each.

    The run sets the bounds, to whole blocks. ``article`` and ``main`` elements that it touches trim
    it, and what else they hold is added where its words score positive by themselves.
    """
    found = tokens(page)
    scores = [weight(t, weights) for t in found]
    a, b = best_run(scores)
    run = found[a:b]
    mains = {t.main for t in run if t.main and t.words}
    blocks = {t.block for t in run if t.words}
    if mains:
        own: Counter[int] = Counter()
        for t, score in zip(found, scores):
            if t.words and t.main in mains and not t.never:
                own[t.block] += score
        blocks |= {block for block, score in own.items() if score > 0}
    chosen = [t for t in found if t.block in blocks and (not mains or t.main in mains)]
    lines: list[str] = []
    parts: list[str] = []
    block = None
    for t in chosen:
        if t.never:
            continue
        if t.block != block:
            lines.append(" ".join("".join(parts).split()))
            parts, block = [], t.block
        parts.append(t.text)
    lines.append(" ".join("".join(parts).split()))
    return "\n".join(x for x in lines if x)


def trained(pages: DataFrame, sample: int = SAMPLE_PAGES) -> dict[str, float]:
    """Weights from the ``sample`` pages with the smallest hashes."""
    # Hashes first: only the chosen pages' html leaves its task.
    key = F.xxhash64("page_id", "url")
    chosen = [r[0] for r in pages.where("html is not null").select(key.alias("key")).orderBy("key").limit(sample).collect()]
    rows = pages.where(key.isin(chosen)).select("html").limit(2 * sample).collect() if chosen else []
    return fit([r["html"] for r in rows if r["html"]])


def main_texts(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    weights = trained(pages) if weights is None else weights

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [extract(x, weights) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        pa.array(texts, pa.string()),
                        pa.array(map(len, texts), pa.int64()),
                    ],
                    ["page_id", "url", "text", "n_chars"],
                )

    out = "page_id long, url string, text string, n_chars long"
    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(work, out)
