"""Main text of web pages by text-to-tag ratio.

A streaming parser turns a page into blocks: the runs of text between
block-level tags. Each block has its characters, the tags met in it, the
sections it lies in, and the tags and names (class, id, role) that mark parts
which are never article text: menus, footers, sidebars, notices, adverts,
forms, comments, scripts.

The ratio of characters to tags of the blocks, in page order, is bounded by
``LONG``, smoothed by a Gaussian kernel and split at a threshold, half the smoothed
mean; the bound keeps one long block from lifting it above plain paragraphs. Runs
of blocks above it are the content clusters. A cluster selects a region: the section
(``article``, ``main``) around it if there is one, else the run itself with the
short blocks between its ends and the paragraphs and headings that adjoin them.
Where sections hold less than a fifth of the text in clusters, both regions are
taken. Inside a region nothing but marked parts is dropped, so a one-word
paragraph of an article stays.

A name marks no section, no heading, and no element that holds most of the
page's text. Inside a section it marks only as a whole: ``comments``, or
``comment-list`` of a dropped word and words of layout, but not ``related-work``.
Marks of inline elements go with their own text, not with the block around it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# HTML elements by role.
BLOCK_TAGS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary table "
    "tbody td tfoot th thead title tr ul".split())
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
DROPPED_TAGS = set(
    "head script style noscript template nav footer aside form button select option textarea input label fieldset "
    "iframe object embed applet audio video canvas svg math map dialog menu".split())
SECTION_TAGS = {"article", "main"}
# Elements that an opening tag of the same kind ends (their end tag is optional).
SELF_ENDING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
               "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Names that mark parts beside the article, as whole words of class, id or role.
DROPPED_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu|breadcrumbs?|"
    r"masthead|footer|sidebar|aside|widget|comments?|commentlist|disqus|respond|replies|cookies?|consent|gdpr|notice|"
    r"notification|alert|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|related|"
    r"recommended|pagination|pager|toolbar|search|complementary|contentinfo|dialog|hidden|sr-only|toc|copyright|"
    r"disclaimer)(?:$|[\s_-])", re.I)
# Words that stand beside a dropped one in the name of the same kind of part.
LAYOUT_WORDS = set(
    "area bar block body bottom box btn bubble button buttons card cards center column container content count entry field first footer form "
    "group header heading icon icons inner inline item items js label last left link links list main message module more my outer page panel "
    "pane post posts article articles row section site slot stories story tag text this title top unit user users reader readers view "
    "wrap wrapper right primary secondary global local mobile desktop sticky fixed floating x".split())
# What a container says of its parts (has-sidebar, content-with-comments) marks nothing.
MODIFIED = re.compile(r"(?:^|(?<=[\s_-]))(?:has|no|with|without)[_-]\S*", re.I)
LONG = 100  # characters a tag from which on a block is text for sure
PROSE_TAGS = {"p", "blockquote", "pre", "h1", "h2", "h3", "h4", "h5", "h6"}
SPACE = re.compile(r"[\s ]+")
# A header is the page's own outside an article; inside, it holds the title.
HEADER_NAMES = re.compile(r"(?:^|[\s_-])header(?:$|[\s_-])", re.I)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_UNCLOSED = re.compile(r"<(?:[a-zA-Z/!?][^<>]*)?$")


def marks_as_a_whole(names: str) -> bool:
    """Whether one of the names (parted by spaces) is made of dropped words and
    words of layout only, with a dropped one among them."""
    for name in names.lower().split():
        words = [w for w in re.split(r"[_-]+", name) if w]
        dropped = [bool(DROPPED_NAMES.search(w)) for w in words]
        if DROPPED_NAMES.fullmatch(name) or any(dropped) and all(d or w in LAYOUT_WORDS or w[0].isdigit() for w, d in zip(words, dropped, strict=True)):
            return True
    return False


class Blocks(HTMLParser):
    """Blocks of one page, in order, as (text, tags, section, dropped, names,
    prose); ``names``: the elements around it that are dropped by name only."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, int, bool, tuple[int, ...], bool]] = []
        self.open: list[tuple[str, bool, int, int]] = []  # tag, starts a dropped part, section, number if dropped by name
        self.named = 0
        self.sections = 0
        self.parts: list[str] = []
        self.tags = 0

    def section(self) -> int:
        return next((s for _, _, s, _ in reversed(self.open) if s), 0)

    def around(self) -> list[tuple[str, bool, int, int]]:
        """The open elements, without inline ones inside the innermost block."""
        n = len(self.open)
        while n and self.open[n - 1][0] not in BLOCK_TAGS | DROPPED_TAGS:
            n -= 1
        return self.open[:n]

    def end_block(self) -> None:
        text = SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            around = self.around()
            names = tuple(k for *_, k in around if k)
            self.blocks.append((text, max(self.tags, 1), self.section(), any(d for _, d, _, _ in around), names,
                                any(o[0] in PROSE_TAGS for o in around)))
        self.parts, self.tags = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK_TAGS or tag in DROPPED_TAGS:
            self.end_block()
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if ends := SELF_ENDING.get(tag):
            self.close_sibling(ends)
        if tag in VOID_TAGS:
            return
        names = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
        hidden = any(k == "hidden" or (k == "aria-hidden" and v == "true") for k, v in attrs)
        names = MODIFIED.sub("", names)
        inside = any(s for _, _, s, _ in self.open)
        drop = tag in DROPPED_TAGS or hidden or not inside and tag == "header"
        by_name = not drop and tag not in SECTION_TAGS | HEADINGS | {"html", "body"} and (
            marks_as_a_whole(names) if inside else bool(DROPPED_NAMES.search(names) or HEADER_NAMES.search(names)))
        self.named += by_name
        number = 0
        if tag in SECTION_TAGS:
            self.sections += 1
            number = self.sections
        self.open.append((tag, drop, number, self.named if by_name else 0))

    def close_sibling(self, ends: set[str]) -> None:
        """End an open element of the same list or table, but none outside it."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in ends:
                self.pop_to(i)
                return
            if self.open[i][0] in BLOCK_TAGS | SECTION_TAGS:
                return

    def pop_to(self, i: int) -> None:
        del self.open[i:]

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK_TAGS or tag in DROPPED_TAGS:
            self.end_block()
        self.tags += 1
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.pop_to(i)
                return

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS and tag in ("svg", "math", "path"):
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if not (self.open and self.open[-1][0] in ("script", "style")) and not any(
                drop or name for _, drop, _, name in self.open[len(self.around()):]):
            self.parts.append(data)


def page_blocks(html: str) -> list[tuple[str, int, int, bool, bool]]:
    """Blocks of a page as (text, tags, section, dropped, prose); markup cut off at
    the page's end is no text.

    An element dropped by name stays if it holds more than half of the text that is
    not dropped otherwise, unless a section outside it has the article."""
    parser = Blocks()
    parser.feed(_UNCLOSED.sub("", html))
    parser.close()
    parser.end_block()
    whole, inside, outside = 0, Counter(), Counter()
    for text, _, section, dropped, names, _ in parser.blocks:
        if not dropped:
            whole += len(text)
            inside.update(dict.fromkeys(names, len(text)))
            if section:
                outside.update(dict.fromkeys(names, 1))
                outside[0] += 1
    stays = {k for k, n in inside.items() if 2 * n > whole and outside[k] == outside[0]}
    return [(text, tags, section, dropped or not stays.issuperset(names), prose)
            for text, tags, section, dropped, names, prose in parser.blocks]


def smoothed(values: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing over page order, weights of missing ends left out."""
    reach = int(3 * sigma)
    kernel = np.exp(-np.arange(-reach, reach + 1) ** 2 / (2 * sigma ** 2))
    weight = np.convolve(np.ones(len(values)), kernel)[reach:reach + len(values)]
    return np.convolve(values, kernel)[reach:reach + len(values)] / weight


def main_text(html: str, sigma: float = 1.0) -> str:
    """The page's article: its blocks joined by one newline (empty if none)."""
    blocks = page_blocks(html)
    kept = [i for i, b in enumerate(blocks) if not b[3]]
    if not kept:
        return ""
    ratio = smoothed(np.array([min(len(t) / n, LONG) for t, n, *_ in blocks]), sigma)
    high = ratio >= ratio[kept].mean() / 2
    clusters = [i for i in kept if high[i]] or [max(kept, key=lambda i: ratio[i])]
    sections = {blocks[i][2] for i in clusters} - {0}
    if not sections:
        sections = {blocks[i][2] for i in kept} - {0}
    chosen = {i for i in kept if blocks[i][2] in sections}
    outside = [i for i in clusters if not blocks[i][2]]
    if not sections or sum(len(blocks[i][0]) for i in outside) > 4 * sum(len(blocks[i][0]) for i in chosen):
        first, last = outside[0], outside[-1]
        while first and blocks[first - 1][4] and not blocks[first - 1][3]:
            first -= 1
        while last + 1 < len(blocks) and blocks[last + 1][4] and not blocks[last + 1][3]:
            last += 1
        chosen |= {i for i in kept if first <= i <= last}
    return "\n".join(blocks[i][0] for i in sorted(chosen))


def extract(pages: DataFrame, sigma: float = 1.0) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    A null html is an empty page and gives empty text; null page_id and url
    stay; repeated rows are read each; other columns are not read; an empty
    table gives no rows. One pass over the rows, no shuffle; memory is bounded
    by one batch of pages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py() or "", sigma) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
