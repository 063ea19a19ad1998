"""Main text of web pages by two passes of block rules.

A page becomes blocks of text between block-level tags. The first pass decides each block by where
it stands (menus, headers, footers, sidebars, notices, adverts, forms, comments; article or main
element) and, where that leaves it open, by stop-word density, length and link density. What is too
short to tell stays ambiguous. The second pass gives ambiguous blocks the label of their nearest
decided neighbours: good between good ones, bad between bad ones, and otherwise that of the nearer;
at equal distance bad, unless the block is nearly good itself or stands in the article.

An article or main element counts where it holds most of the page's running text; a page whose article
elements only tease other stories, or that has none, is decided by density, length and links alone.
Headers are those of the page and of its sections, an article's own `header` element among them.

Unclosed elements, truncated pages, unquoted attributes and stray angle brackets are read as
browsers do, as far as the blocks depend on it. Nulls: a null page has no text. Rows of equal
page_id are extracted one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstar.llm import common

SHORT, LONG = 70, 200  # characters
STOPS_LOW, STOPS_HIGH = 0.15, 0.3  # share of stop words in a block's words
LINKS = 0.5  # share of a block's characters in links

# Elements and words of class, id and role names.
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend"
    " li main menu nav noscript ol optgroup option p pre section summary table tbody td tfoot th"
    " thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noembed noframes xmp template svg math".split())
_BAD = frozenset(
    "aside button datalist dialog fieldset footer form head header iframe label legend menu nav"
    " noscript object optgroup option select script style template textarea title".split()
)
_MAIN = frozenset("article main".split())
_BAD_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion"
    " sidebar sidebars side menu menus nav navbar navigation breadcrumb breadcrumbs crumbs footer"
    " header masthead comment comments reply replies respond discussion disqus cookie cookies"
    " consent gdpr notice notices alert newsletter subscribe subscription signup login popup modal"
    " overlay share sharing social related recommended widget widgets toolbar pagination pager"
    " search skip complementary contentinfo form".split()
)
_MAIN_NAMES = frozenset("main article maincontent articlebody entry story".split())
_STOPS = {
    "en": "a about after all also an and are as at be been but by can could do for from had has"
    " have he her his i if in into is it its more most no not of on one or our other out she so"
    " some than that the their them then there these they this to up was we were what when which"
    " who will with would you your",
    "de": "aber als am an auch auf aus bei bin bis da das dass dem den der des die doch du durch"
    " ein eine einem einen einer er es für hat hatte ich ihr im in ist ja kann man mehr mit nach"
    " nicht noch nur oder sein sich sie sind so um und uns unter vom von vor war was wenn werden"
    " wie wir wird zu zum zur über",
    "fr": "à au aux avec ce ces comme dans de des du elle en est et eux il ils je la le les leur"
    " lui mais me même ne nous on ou où par pas plus pour qu que qui sa se ses si son sont sur un"
    " une vous y été",
    "es": "a al como con de del el ella en entre era es esta este está fue ha hay la las le les lo"
    " los mi más me muy no nos o para pero por que quien se si sin sobre son su sus también un una"
    " uno y ya",
}
STOP_WORDS = {lang: frozenset(words.split()) for lang, words in _STOPS.items()}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_LANG = re.compile(r"(?:^|\s)(?:xml:)?lang\s*=\s*[\"']?([a-zA-Z]{2})", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s=/]|$)|display\s*:\s*none", re.I)
_NAME_WORDS = re.compile(r"[a-z]+").findall
_HREF = re.compile(r"(?:^|\s)href(?:[\s=/]|$)", re.I)
_SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/$")  # not the end of an unquoted value

# What names say beside what a block is, as in "nav-list" or "left-sidebar".
_LAYOUT = frozenset(
    "area bar body bottom box buttons col column container content footer group header icons inner"
    " item items left link links list main menu outer page panel right row section site small top"
    " widget wrap wrapper".split()
)


def _is_bad(name: str) -> bool:
    """Whether a class, id or role says so: by its last word, or beside words of layout alone.

    "site-footer" and "social-links" do, "social-science" does not.
    """
    words = _NAME_WORDS(name)
    bad = [w for w in words if w in _BAD_NAMES]
    return bool(bad) and (words[-1] in _BAD_NAMES or all(w in _BAD_NAMES or w in _LAYOUT for w in words))


def _place(tag: str, attributes: str) -> int:
    """-1 for an element whose text is not the article's, 1 for one that holds it, else 0."""
    if tag in _BAD:
        return -1
    if attributes:
        if _HIDDEN.search(attributes):
            return -1
        names = [n for m in _NAMES.finditer(attributes) for n in m[1].strip("\"'").lower().split()]
        words = {w for n in names for w in _NAME_WORDS(n)}
        if tag not in ("body", "html") and tag not in _MAIN and any(map(_is_bad, names)):
            return -1
        if words & _MAIN_NAMES and tag not in ("body", "html"):
            return 1
    return 1 if tag in _MAIN else 0


class Block:
    """A block's text, link characters and place; its label once decided."""

    __slots__ = ("text", "linked", "place", "label")

    def __init__(self, text: str, linked: int, place: int) -> None:
        self.text, self.linked, self.place = text, linked, place
        self.label: str | None = None


def blocks(html: str) -> tuple[list[Block], str | None]:
    """The page's blocks in order, and its language if it names one."""
    out: list[Block] = []
    parts: list[tuple[str, bool]] = []
    stack: list[tuple[str, int]] = []  # open elements with the place they give
    language = None
    links = bad = main = 0
    breaks = 0
    at, n = 0, len(html)

    def flush() -> None:
        text = " ".join("".join(p for p, _ in parts).split())
        if text:
            linked = sum(len(" ".join(p.split())) for p, inside in parts if inside)
            out.append(Block(text, linked, -1 if bad else 1 if main else 0))
        parts.clear()

    def close(depth: int) -> None:
        nonlocal bad, main
        for _, place in stack[depth:]:
            bad -= place < 0
            main -= place > 0
        del stack[depth:]

    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            text = html[at:lt]
            if not text.isspace():
                breaks = 0
            parts.append((unescape(text), links > 0))
        if lt == n:
            break
        m = _TAG.match(html, lt)
        if m is None:
            parts.append(("<", links > 0))
            at = lt + 1
            continue
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        end, attributes = m[1] or m[4], m[3] or m[6] or ""
        if tag == "a":  # an anchor without an address is no link, but ends one
            links = int(not end and bool(_HREF.search(attributes)))
        elif tag == "br":
            breaks += 1
            if breaks > 1:
                flush()
            parts.append((" ", False))
            continue
        if tag in _BLOCK:
            flush()
            breaks = 0
        if end:
            if tag in ("p", "article"):
                links = 0
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
            continue
        if tag == "html" and (lang := _LANG.search(attributes)):
            language = lang[1].lower()
        closed = bool(_SELF_CLOSED.search(attributes))
        if tag in _RAW and not closed:
            closing = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            if closing:
                at = closing.end()  # its text is not the article's
            elif tag in ("script", "style"):
                at = n  # as browsers read it; other elements without an end hide nothing
            continue
        if tag in _VOID or closed:
            continue
        if tag in _BLOCK and stack and stack[-1][0] in ("p", "dt", "dd", "li", "option"):
            top = stack[-1][0]
            if top == "p" or top == tag:  # these end where the next one begins
                close(len(stack) - 1)
        place = _place(tag, attributes)
        if tag in _BLOCK or place:
            stack.append((tag, place))
            bad += place < 0
            main += place > 0
    flush()
    return out, language


def _stop_density(text: str, language: str | None) -> float:
    words = [w.strip(".,;:!?\"'()*$%&#|") for w in text.lower().split()]
    if language in STOP_WORDS:
        lists = [STOP_WORDS[language]]
    else:
        lists = list(STOP_WORDS.values())
    return max(sum(map(s.__contains__, words)) for s in lists) / len(words)


def _decide(block: Block, article: bool, language: str | None) -> str:
    """The first pass: good, bad, near or short."""
    if block.place < 0 or (article and block.place == 0):
        return "bad"
    length = len(block.text)
    if article:
        return "good" if length >= SHORT else "short"
    if block.linked > LINKS * length:
        return "bad"
    if length < SHORT:
        return "short"
    density = _stop_density(block.text, language)
    if density >= STOPS_HIGH:
        return "good" if length >= LONG else "near"
    return "near" if density >= STOPS_LOW else "bad"


def _running(block: Block) -> int:
    """Characters of the block outside of links, if it is long enough to be running text."""
    length = len(block.text)
    return length - block.linked if length >= SHORT and block.linked <= LINKS * length else 0


def extract(html: str | None) -> str:
    """The page's main text: good blocks in order, two line feeds between them."""
    found, language = blocks(html or "")
    # The page's own article holds most of its running text. Articles that only tease others, beside
    # a text in plain elements, do not, and then density, length and links decide everywhere.
    running = {place: sum(_running(b) for b in found if b.place == place) for place in (0, 1)}
    article = any(b.place > 0 for b in found) and running[1] >= running[0]
    for b in found:
        b.label = _decide(b, article, language)
    # Blocks that their place rules out say nothing about the text around them.
    decided = [i for i, b in enumerate(found) if b.label in ("good", "bad") and b.place >= 0]
    labels = {i: found[i].label for i in decided}
    before = -1  # place in `decided` of the last one before the block
    kept = []
    for i, b in enumerate(found):
        if i in labels:
            before += 1
            label = b.label
        elif b.place < 0:
            label = "bad"
        elif b.place > 0 and article:
            label = "good"  # all decided neighbours in the article are good
        else:
            left = decided[before] if before >= 0 else None
            right = decided[before + 1] if before + 1 < len(decided) else None
            sides = {labels[x] for x in (left, right) if x is not None}
            if len(sides) == 1:
                label = sides.pop()
            elif not sides:
                label = "good" if b.label == "near" else "bad"
            elif b.label == "near" or i - left == right - i:
                label = "good" if b.label == "near" else "bad"
            else:
                label = labels[left if i - left < right - i else right]
        if label == "good":
            kept.append(b.text)
    return "\n\n".join(kept)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [extract(page.as_py()) for page in batch.column(2)]
        sizes = pa.array(map(len, found), pa.int64())
        columns = [batch.column(0), batch.column(1), pa.array(found, pa.string()), sizes]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    plain = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    return plain.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(common.table(spark, sf_dir, "pages"))
