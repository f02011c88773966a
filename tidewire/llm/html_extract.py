"""Main text of web pages by two-pass block rules.

A page is read once into blocks of text with their length, share of link text and
density of stop words. Pass one decides what the figures decide: blocks in menus,
headers, footers, sidebars, notices, adverts, forms and comments are boilerplate,
as are blocks that are mostly links; long enough blocks with many stop words are
content; long ones without are boilerplate, unless they stand in an article. Pass
two gives each block left open the label of its nearest decided neighbours.
Neighbours are sought within a region only, an article or the rest of the page.
A page with next to no listed stop word is in a language that isn't listed: there
length and links decide alone.

Defined results
- A null or empty page has the empty text, and no characters.
- Malformed pages (open tags, stray ends, no body, unknown declarations, character
  references beyond Unicode) are read as far as they go; no page stops the job.
- A page's text is never cut, whatever its length; blocks are joined in page order by
  one line feed.
- Repeated rows give repeated results; other columns of the input are not read.
- An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds of the block rules.
MAX_LINK_DENSITY = 0.33
MAX_LINK_DENSITY_ARTICLE = 0.6
MIN_STOP_DENSITY = 0.2
# With a smaller share of characters in listed stop words, a page's language is none of the listed.
LISTED_DENSITY = 0.02
SHORT_CHARS = 70
GOOD_CHARS = 140

# Frequent function words of several languages.
STOP_WORDS = frozenset(
    """
    a about after all also an and any are as at be been but by can could did do for from had has have
    he her his how if in into is it its more most my no not of on one only or other our out she so some
    such than that the their them then there these they this to up was we were what when which who will
    with would you your
    aber als am an auch auf aus bei bin bis das dass dem den der des die doch du durch ein eine einem
    einen einer er es für hat ich ihr im in ist ja kann man mit nach nicht noch nur oder sein sich sie
    sind so über um und uns unter von vor war was wenn werden wie wir wird zu zum zur
    au aux avec ce ces cette dans de des du elle en est et être il ils je la le les leur lui mais ne
    nous on ou où par pas plus pour qu que qui sa se ses si son sont sur un une vous
    al como con cuando de del desde donde el ella en entre era es esta este esto fue ha hay la las le lo
    los más me muy no nos o para pero por que quien se ser si sin sobre son su sus también un una y ya
    che chi come da dal della di e gli ha il io le ma nel non per più sono un uno
    ao as com da das do dos ele em essa foi isso mais mas não na nas no nos os ou pela pelo por quando
    sem seu sua são também uma você
    aan dat deze die een en het hij ik is met niet nog of ook op te tot uit van voor was ze zijn
    """.split()
)
# Elements by their part in the page.
DROPPED = frozenset(
    "head script style noscript template svg canvas iframe object audio video map select textarea button".split()
)
BOILERPLATE = frozenset("nav footer aside form dialog menu fieldset".split())
ARTICLE = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    """
    address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section
    summary table tbody tfoot thead tr ul
    """.split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that an unclosed inline element does not reach beyond.
WALLS = BLOCK | {"td", "th"}
ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)
# Words in class and id attributes that name boilerplate.
HINTS = frozenset(
    """
    ad ads adv advert advertisement adverts advertising adsense banner breadcrumb breadcrumbs byline comment
    commentlist comments consent cookie cookies copyright disclaimer disqus donate footer gdpr header login
    masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay
    pager pagination popup popover promo promoted promotion recommended related replies reply respond
    search share sharing sidebar signin signup skip social sponsor sponsored subscribe subscription
    tagcloud toolbar topbar tracking widget widgets
    """.split()
)
# A class like "no-sidebar" or "with-comments" speaks of another element.
ABOUT_OTHERS = frozenset("no has with without is show hide".split())
# Inside an article these words name parts of it.
ARTICLE_PARTS = frozenset("header byline search".split())

_PIECES = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_GAP = re.compile(r"\s+")
_EDGE = ".,;:!?'\"()[]{}%&$#*|-"
_LONG_REFERENCE = re.compile(r"&#([0-9]{8,})")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Block:
    text: str
    link_chars: int
    region: int  # 0 outside any article, else the number of the article
    heading: bool
    dropped: bool


def _hinted(names: str, in_article: bool) -> bool:
    for name in names.split():
        words = [word.lower() for word in _PIECES.findall(name)]
        if ABOUT_OTHERS & set(words[:1]):
            continue
        hits = HINTS & set(words)
        if hits - ARTICLE_PARTS if in_article else hits:
            return True
    return False


class _Reader(HTMLParser):
    """Collects the blocks of one page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        # tag, dropped, link, region, and whether it is dropped for what it is itself; inline
        # elements that change none of the states are left out.
        self.open: list[tuple[str, bool, bool, int, bool]] = []
        self.silent = 0  # open elements that have no text
        self.depth: Counter[str] = Counter()
        self.parts: list[str] = []
        self.link_chars = 0
        self.heading = False
        self.regions = 0
        self.breaks = 0

    def _state(self) -> tuple[bool, bool, int]:
        return self.open[-1][1:4] if self.open else (False, False, 0)

    def _flush(self) -> None:
        text = _GAP.sub(" ", "".join(self.parts)).strip()
        if text:
            dropped, _, region = self._state()
            self.blocks.append(Block(text, self.link_chars, region, self.heading, dropped))
        self.parts, self.link_chars, self.heading, self.breaks = [], 0, False, 0

    def _cut(self, at: int) -> None:
        closed = [tag for tag, *_ in self.open[at:]]
        self.depth.subtract(closed)
        self.silent -= sum(tag in DROPPED for tag in closed)
        del self.open[at:]

    def _end_open(self, tags: tuple[str, ...]) -> None:
        """Close the nearest of ``tags`` that no block stands around."""
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] in tags:
                self._cut(at)
                return
            if self.open[at][0] in WALLS:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            if tag == "br":
                self.breaks += 1
                self.parts.append(" ")
                if self.breaks > 1:
                    self._flush()
            elif tag == "hr":
                self._flush()
            return
        if tag in BLOCK:
            self._flush()
            # A paragraph ends where the next block begins, a list item at the next item.
            self._end_open(("p", *HEADINGS) if tag not in ("li", "dt", "dd") else (tag, "p"))
            if tag in ARTICLE:
                # An article does not stand in a menu, header or footer that was left open.
                while self.open and self.open[-1][0] in ("nav", "header", "footer"):
                    self._cut(len(self.open) - 1)
        elif tag in ("td", "th"):
            self.parts.append(" ")
        elif tag == "a":
            self._end_open(("a",))
        dropped, link, region = self._state()
        named = {name: value or "" for name, value in attrs}
        if tag in ARTICLE and not region:
            self.regions += 1
            region = self.regions
        own = False
        if tag not in ("html", "body", *ARTICLE):
            own = (
                tag in DROPPED
                or tag in BOILERPLATE
                or (tag == "header" and not region)
                or "hidden" in named
                or named.get("aria-hidden") == "true"
                or named.get("role") in ROLES
                or bool(_HIDDEN.search(named.get("style", "")))
                or _hinted(f"{named.get('class', '')} {named.get('id', '')}", region > 0)
            )
        elif tag in ARTICLE:
            own = "comment" in named.get("class", "").lower()
            # A form around a whole page doesn't drop the article in it.
            dropped = dropped and any(mine and name != "form" for name, *_, mine in self.open)
        dropped = dropped or own
        if dropped and tag not in DROPPED and not self._state()[0]:
            self._flush()
        state = (dropped, link or tag == "a", region)
        if tag in WALLS or state != self._state():
            self.open.append((tag, *state, own))
            self.depth[tag] += 1
            self.silent += tag in DROPPED
        if tag in HEADINGS:
            self.heading = True

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
        if not self.depth[tag]:
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                if tag not in DROPPED and self.open[at][1] != (self.open[at - 1][1] if at else False):
                    self._flush()
                self._cut(at)
                return
            if tag not in BLOCK and tag not in DROPPED and self.open[at][0] in WALLS:
                return  # an inline end tag does not close the blocks within

    def handle_data(self, data: str) -> None:
        dropped, link, _ = self._state()
        if dropped and self.silent:
            return
        if not data.isspace():
            self.breaks = 0
        self.parts.append(data)
        if link:
            self.link_chars += len(_GAP.sub(" ", data).strip())

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Whatever it is called, a section like ``<![name[`` ends at the next ``>``."""
        return self.rawdata.find(">", i) + 1 or -1

    def finish(self) -> list[Block]:
        if self.rawdata.startswith("<!--"):
            self.rawdata = ""  # an open comment reaches to the end
        self.close()
        self._flush()
        return self.blocks


def _stops(block: Block) -> list[str]:
    """The listed stop words of a block."""
    words = (word.strip(_EDGE) for word in block.text.lower().split())
    return [word for word in words if word in STOP_WORDS]


def _decide(block: Block, articles: bool, listed: bool) -> bool | None:
    """Pass one: content, boilerplate or open."""
    if block.dropped or (articles and not block.region):
        return False
    if block.heading and block.region:
        return None
    size = len(block.text)
    links = block.link_chars / size
    if links > (MAX_LINK_DENSITY_ARTICLE if block.region else MAX_LINK_DENSITY):
        return False
    if block.heading:
        return None
    dense = not listed or len(_stops(block)) >= MIN_STOP_DENSITY * len(block.text.split())
    if size >= GOOD_CHARS and dense:
        return True
    if size < SHORT_CHARS or dense or block.region:
        return None
    return False


def _listed(blocks: list[Block]) -> bool:
    """Whether the page's own text has stop words of a listed language."""
    own = [b for b in blocks if not b.dropped and b.link_chars <= MAX_LINK_DENSITY * len(b.text)]
    stops = sum(len(word) for block in own for word in _stops(block))
    return stops >= LISTED_DENSITY * sum(len(block.text) for block in own)


def _short_reference(match: re.Match) -> str:
    """A reference beyond Unicode by a number that is short enough to be read."""
    return "&#" + (match[1].lstrip("0")[:8] or "0")


def _inherit(blocks: list[Block], labels: list[bool | None]) -> list[bool]:
    """Pass two: open blocks take the label of their nearest decided neighbours.

    Where those on either side are as near and differ, a heading goes with what follows
    it and other text is content. Without a neighbour, the block is content.
    """
    count = len(labels)
    regions = [block.region for block in blocks]

    def nearest(order: range) -> list[tuple[int, bool | None]]:
        out: list[tuple[int, bool | None]] = [(0, None)] * count
        last: tuple[int, bool | None] = (0, None)
        region = None
        for i in order:
            if regions[i] != region:
                region, last = regions[i], (0, None)
            if labels[i] is not None:
                last = (i, labels[i])
            out[i] = last
        return out

    before, behind = nearest(range(count)), nearest(range(count - 1, -1, -1))
    result = []
    for i, label in enumerate(labels):
        if label is None:
            (a, left), (b, right) = before[i], behind[i]
            if left is None or right is None:
                label = right if left is None else left
                label = True if label is None else label
            else:
                tie = right if blocks[i].heading else True
                label = tie if b - i == i - a else right if b - i < i - a else left
        result.append(label)
    return result


def main_text(page: str | None) -> str:
    """Main text of one page."""
    if not page:
        return ""
    reader = _Reader()
    reader.feed(_LONG_REFERENCE.sub(_short_reference, page))
    blocks = reader.finish()
    articles = any(block.region and not block.dropped for block in blocks)
    listed = _listed(blocks)
    labels = [_decide(block, articles, listed) for block in blocks]
    # Dropped blocks are no neighbours: what stands beside a menu need not be one.
    seen = [i for i, block in enumerate(blocks) if not block.dropped]
    kept = _inherit([blocks[i] for i in seen], [labels[i] for i in seen])
    return "\n".join(blocks[i].text for i, keep in zip(seen, kept) if keep)


def _texts(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield batch.map(main_text, na_action=None).astype(str)


def main_text_column(html: Column) -> Column:
    return F.pandas_udf(_texts, "string")(html)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars), one row for each page."""
    texts = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        main_text_column(F.col(html_col)).alias("text"),
    )
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))
