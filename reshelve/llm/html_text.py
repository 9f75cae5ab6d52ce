"""HTML extraction: flat text blocks, classified by a decision tree over their neighbourhood.

A page is cut into flat blocks of text at every tag that is not inline. Scripts, styles, the
head and comments hold no text. A block is described by its number of words and its share of
words inside links, by those of the blocks before and after it, by whether it lies in an article,
and by whether it lies in an element whose name, class, id or role tells of page furniture. Classes,
ids and roles tell nothing on html, body and main, on an element that holds more than half of the
page's words (of comments only if an h1, main or article stands in it), on an article unless
they tell of comments or advertising, nor where they say what a layout has or lacks. The
tree is grown on the blocks of a few hand-labelled pages below, in which `data-main` marks what
belongs to the article.

Results in odd cases:

* A null page is an empty one; the text of a page without main blocks is empty.
* Markup that ends early is read as if it were closed; a stray `<` is text.
* Repeated rows give repeated results, null ids and urls are passed on.
* Whole pages are read, however long, one at a time.
* An empty table gives an empty result. Other columns are dropped.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from reshelve.llm.columns import text_or_empty

TAG = re.compile(r"""<!--(?:.*?-->|.*)|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>""",
                 re.S)
HINTED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q "
                   "ruby rt rp s samp small span strike strong sub sup time tt u var wbr img "
                   "br".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style head title noscript template svg math textarea select option "
                "iframe object canvas audio video button".split())
NESTED = frozenset("article main section div aside nav header footer form fieldset ul ol dl table "
                   "blockquote figure details dialog body td".split())
FURNITURE = frozenset("nav header footer aside form fieldset dialog menu".split())
# Words in a class, id or role that tell of page furniture.
FURNITURE_WORDS = frozenset(
    "nav navbar navigation menu header footer sidebar side aside rail ad ads advert adverts "
    "advertisement adsense banner promo promotion sponsor sponsored cookie cookies consent notice "
    "alert popup modal overlay newsletter subscribe signup share social related recommended "
    "comment comments reply replies disqus respond breadcrumb breadcrumbs pagination pager widget "
    "toolbar copyright legal login search complementary contentinfo dialog".split())
# Of these, those that tell of comments, and of comments or advertising.
COMMENT_WORDS = frozenset("comment comments reply replies disqus".split())
FOREIGN_WORDS = COMMENT_WORDS | frozenset(
    "ad ads advert adverts advertisement adsense promo promotion sponsor sponsored related "
    "recommended".split())
# A class as has-sidebar or comments-open tells of the layout, not of what the element is.
LAYOUT = re.compile(r"(?:has|no|with|without|hide|show)[-_].*|.*[-_](?:open|closed|enabled|disabled)")
DEPTH = 6
LEAST_LEAF = 2

LABELLED_PAGES = [
    """<body><nav><ul><li><a href=a>Home</a></li><li><a href=b>World news</a></li></ul></nav>
    <div class="ad">Buy two get one free this week only.</div><article><h1 data-main>Rain ends a
    long dry summer</h1><p data-main>After nine weeks without rain the first storms reached the
    coast on Monday and filled the small rivers within a few hours.</p><p data-main>Finally.</p>
    <p data-main>Farmers in the valley said that the water had come too late for most of the
    fruit, but not for the wine that is picked in autumn.</p></article>
    <footer>&copy; example.org all rights reserved</footer></body>""",
    """<body><header><a href=x>The Daily Page</a> your paper since 1900</header><div id=content>
    <p data-main>The council agreed last night to build the bridge that was first drawn forty
    years ago, and work on it will begin next spring.</p><p data-main>It will carry two lanes and
    a path for walkers, and <a href=c>cost less</a> than was feared when the plan came up.</p>
    <p data-main>Two members voted against it.</p></div><div class="comments"><p>I have lived here
    for thirty years and never needed a bridge to get to the other side of it.</p><p>Me neither,
    and who is going to pay for all of this in the end if not us?</p></div>
    <div class="footer">Contact us Terms Privacy</div></body>""",
    """<body><div class="cookie-notice">We use cookies to make this site better for you, read how
    we do it and what you can choose.</div><ul class=menu><li><a href=a>Start</a></li><li>
    <a href=b>Shop</a></li><li><a href=c>Help</a></li></ul><main><article><h1 data-main>How to
    sharpen a kitchen knife</h1><p data-main>Wet the stone and lay the blade on it at a flat angle
    of about fifteen degrees.</p><h2 data-main>The other side</h2><p data-main>Turn it over and
    repeat with the same number of strokes, then dry it.</p><ul><li data-main>Do not press hard
    </li><li data-main>Keep the angle</li></ul><aside>More from our shop: stones, oils and cloths
    for every blade</aside></article></main><form><p>Your email address for our weekly letter</p>
    </form></body>""",
    """<body><div><a href=a>Home</a> <a href=b>Sport</a> <a href=c>Money</a></div><div><p data-main>
    Prices rose by two percent in the year to May, the slowest pace since the spring of the year
    before, the office of statistics said.</p><p data-main>Food was cheaper than in April, while
    rents and fares went up again in nearly all of the larger cities.</p></div><div>
    <a href=d>Read more about prices</a> <a href=e>Write to the author</a></div><div>Page 1 of 3
    </div></body>""",
    """<body><div>Menu</div><div><a href=a>Sign in</a></div><article><p data-main>Yes.</p>
    <p data-main>The train left on time and arrived before anyone had expected it to come.</p>
    <div class="ad-slot">Your holiday starts here, book now and save</div><p data-main>Nobody had
    come to meet us.</p><section class="related"><a href=q>Ten trains to take</a></section>
    <p data-main>We walked.</p></article><footer><p>Printed in the old town by hand with care since
    1950 and sold at the door</p></footer></body>""",
    """<body><article><h1 data-main>Notes</h1><p data-main>One two three.</p><p data-main>
    <a href=z>Linked source</a></p><p data-main>A longer paragraph follows here with many more
    words than the first one had in it.</p></article><div class=sidebar><p>Popular this week on
    our pages are the following stories that readers liked the most</p></div><footer>&copy; 2020
    site &middot; a few words of small print</footer></body>""",
    """<body><div class="banner">Sale ends tonight</div><table><tr><td data-main>The report runs
    to three hundred pages and took the panel of experts more than two years to write, longer than
    any before it.</td></tr></table><p>Share</p><p><a href=f>Facebook</a></p><p>Loading</p></body>""",
]


@dataclass
class Block:
    text: str
    words: int
    linked: int
    article: bool
    furniture: bool
    main: bool


@dataclass
class Span:
    """A nested element that is or may be page furniture, and the range of its blocks."""
    name: str
    sure: bool
    hints: set[str]
    start: int
    end: int = -1
    headed: bool = False  # an h1, main or article stands in it


def _is_furniture(name: str, attributes: str) -> bool:
    return name in FURNITURE or bool(attributes and HIDDEN.search(attributes))


def _hints(attributes: str) -> set[str]:
    """The words in class, id and role that tell of page furniture."""
    found: set[str] = set()
    for value in HINTED.finditer(attributes):
        for name in (value[1] or value[2] or value[3] or "").lower().split():
            if not LAYOUT.fullmatch(name):
                found |= FURNITURE_WORDS.intersection(re.split(r"[^a-z]+", name))
    return found


def _mark_furniture(found: list[Block], spans: list[Span]) -> None:
    """Mark the blocks in spans that are sure, or whose hints count."""
    before = [0]
    for block in found:
        before.append(before[-1] + block.words)
    change = [0] * (len(found) + 1)
    for s in spans:
        large = 2 * (before[s.end] - before[s.start]) > before[-1]
        if not s.sure and (s.name in ("html", "body", "main")
                           or large and (s.headed or not s.hints & COMMENT_WORDS)
                           or s.name == "article" and not s.hints & FOREIGN_WORDS):
            continue
        change[s.start] += 1
        change[s.end] -= 1
    depth = 0
    for block, step in zip(found, change):
        depth += step
        block.furniture |= depth > 0


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page in its order."""
    found: list[Block] = []
    parts: list[str] = []
    links: list[str] = []
    open_tags: list[tuple[str, Span | None]] = []
    spans: list[Span] = []
    depth = {"article": 0, "link": 0}
    hinted: list[Span] = []  # the open ones of the spans
    own = [False, False]  # the open block's element is furniture; is marked as main

    def close() -> None:
        text = " ".join(unescape("".join(parts)).split())
        if text:
            linked = len(unescape(" ".join(links)).split())
            words = len(text.split(" "))
            found.append(Block(text, words, min(linked, words), depth["article"] > 0,
                               own[0], own[1]))
        parts.clear()
        links.clear()
        own[:] = [False, False]

    def add(text: str) -> None:
        parts.append(text)
        if depth["link"]:
            links.append(text)

    at = 0
    while tag := TAG.search(page, at):
        if tag.start() > at:
            add(page[at:tag.start()])
        at = tag.end()
        if tag[2] is None:
            continue
        name, attributes = tag[2].lower(), tag[3]
        if name in RAW and not tag[1]:
            if attributes.endswith("/"):
                continue
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            # A head or option left open hides nothing; a script left open hides the rest.
            at = end.end() if end else len(page) if name in ("script", "style") else at
            close()
        elif name == "a":
            depth["link"] = 0 if tag[1] else 1
        elif name in INLINE:
            if name == "br":
                add(" ")
        else:
            close()
            if tag[1]:
                if any(n == name for n, _ in open_tags):
                    while open_tags:
                        n, span = open_tags.pop()
                        depth["article"] -= n == "article"
                        if span:
                            hinted.pop().end = len(found)
                            if hinted:
                                hinted[-1].headed |= span.headed or n in ("main", "article")
                        if n == name:
                            break
            elif name not in VOID and not attributes.endswith("/"):
                sure, hints = _is_furniture(name, attributes), _hints(attributes)
                if hinted and name in ("h1", "main", "article"):
                    hinted[-1].headed = True
                if name in NESTED:
                    span = Span(name, sure, hints, len(found)) if sure or hints else None
                    open_tags.append((name, span))
                    depth["article"] += name == "article"
                    if span:
                        spans.append(span)
                        hinted.append(span)
                own[:] = [name not in NESTED and (sure or bool(hints)) and name != "html",
                          "data-main" in attributes]
            if name in NESTED:
                depth["link"] = 0
    if at < len(page):
        add(page[at:])
    close()
    for span in reversed(hinted):
        span.end = len(found)
    for inner, outer in zip(hinted[:0:-1], hinted[-2::-1]):
        outer.headed |= inner.headed
    _mark_furniture(found, spans)
    return found


def features(found: list[Block]) -> list[tuple[float, ...]]:
    """Words and link density of the block before, the block and the one after, and its place."""
    pairs = [(0.0, 0.0), *((float(b.words), b.linked / b.words) for b in found), (0.0, 0.0)]
    return [(*before, *own, *after, float(b.article), float(b.furniture))
            for before, own, after, b in zip(pairs, pairs[1:], pairs[2:], found)]


def grow(rows: list[tuple[float, ...]], labels: list[bool], depth: int = DEPTH):
    """A decision tree by Gini impurity: (feature, border, at most, above) or a share of main."""
    share = sum(labels) / len(labels)
    best = (share * (1 - share) * len(labels) - 1e-9, None, None)
    if depth and 0 < share < 1:
        for f in range(len(rows[0])):
            values = sorted({r[f] for r in rows})
            for low, high in zip(values, values[1:]):
                border = (low + high) / 2
                sides = [[y for r, y in zip(rows, labels) if (r[f] <= border) == s]
                         for s in (True, False)]
                if min(map(len, sides)) >= LEAST_LEAF:
                    left = sum(sum(s) * (len(s) - sum(s)) / len(s) for s in sides)
                    best = min(best, (left, f, border), key=lambda b: b[0])
    if best[1] is None:
        return share
    _, f, border = best
    parts = [[(r, y) for r, y in zip(rows, labels) if (r[f] <= border) == s]
             for s in (True, False)]
    return (f, border, *(grow([r for r, _ in p], [y for _, y in p], depth - 1) for p in parts))


def trained() -> tuple | float:
    """The tree of the labelled pages."""
    rows, labels = [], []
    for page in LABELLED_PAGES:
        found = blocks(page)
        rows += features(found)
        labels += [b.main for b in found]
    return grow(rows, labels)


def is_main(tree, row: tuple[float, ...]) -> bool:
    while isinstance(tree, tuple):
        f, border, low, high = tree
        tree = low if row[f] <= border else high
    return tree >= 0.5


def main_text(page: str, tree) -> str:
    """The main blocks of a page joined by a space."""
    found = blocks(page)
    return " ".join(b.text for b, row in zip(found, features(found)) if is_main(tree, row))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for a table of page_id, url and html."""
    tree = trained()

    @F.pandas_udf("string")
    def text(html: pd.Series) -> pd.Series:
        return pd.Series([main_text(page, tree) for page in html], dtype=object)

    rows = pages.select("page_id", "url", text(text_or_empty("html")).alias("text"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return extract(spark.read.parquet(f"{folder}/pages.parquet"))
