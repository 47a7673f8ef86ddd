"""Main text of web pages from parser events, text-to-tag ratios and their clusters.

The standard library's parser streams events over the whole page. Block elements cut it into lines; a line knows
its text, its tags, its links and the elements around it. Lines inside elements that never hold the article are left out
from the start, and so are those inside elements that seldom do (headers, asides, forms, and those with a telling word in
their class, id or role), unless such an element holds more than half of the page's text and no article or main with text
lies beside it. The header of an article or main is part of it, and inside one, paragraphs, headings, tables and lists are left
out for the plainest words only. The ratio of text to
tags of the other lines is smoothed by a Gaussian over neighbouring lines, and one-dimensional two-means clustering
finds the threshold above which lines are content. The innermost element that holds nearly all content leads to the
region: the nearest article or main around it, or else the innermost element that holds all content. All lines of the
region are the text: titles and short paragraphs beside long ones are not lost. Where no article or main is around
them, lines that are mostly links are left out.

Pages are handled one by one inside Spark's tasks; a worker holds one page's lines at a time.

Defined results: null and empty pages, and pages without text, give the empty text; unclosed elements end with the
element around them; a tag cut off at the end of the page is dropped; repeated pages each have a result; an empty
table gives no rows; other columns are kept by ``keep`` or ignored.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillspan.llm.common import by_batch
from quillspan.llm.registry import query, table

SIGMA, SHARE, LINKS = 1.0, 0.8, 0.5

# Fixed values of the format.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
_NEVER = frozenset(
    "script style noscript template head title nav footer button select option textarea input iframe object svg canvas audio video menu dialog".split()
)
#: Left out unless they hold most of the page; a header of an article or main belongs to it.
_SELDOM = frozenset("header aside form".split())
#: Inside an article or main, these are left out for the plainest words only.
_CONTENT = frozenset("p h1 h2 h3 h4 h5 h6 table caption thead tbody tr td th pre blockquote figure figcaption ul ol dl li dt dd".split())
_ENDS_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
_HINTS = frozenset(
    "ad ads adbox advert advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs header masthead "
    "footer sidebar aside cookie cookies consent gdpr notice alert popup modal overlay comment comments commentlist disqus reply replies share sharing social "
    "related recommended newsletter subscribe subscription signup login search widget toolbar pagination pager complementary contentinfo dialog".split()
)
_PLAINEST = frozenset(
    "ad ads adbox advert advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs cookie cookies consent "
    "gdpr comment comments commentlist disqus share sharing social related recommended newsletter subscribe subscription pagination pager".split()
)
_OPEN = frozenset("html body article main".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_CUT_TAG = re.compile(r"<[A-Za-z/!?][^>]*\Z")


class _Lines(HTMLParser):
    """Collects lines as ``[text parts, tags, link characters, element]``."""

    def __init__(self, trusted: frozenset = frozenset()):
        super().__init__(convert_charrefs=True)
        self.trusted = trusted  # hinted elements, by their order, whose hint is ignored
        self.size = 0  # of the text so far, without what is in elements that never hold the article
        self.hinted, self.named = [], []  # [from, to] in that text
        self.parents, self.names = [-1], ["#page"]  # by element
        self.stack = [("#page", 0, False, False, None)]  # name, element, left out, by an element's name, span
        self.links = 0
        self.lines = []
        self.fresh = True

    def _break(self):
        self.fresh = True

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS_P:
            self._end_p()
        if tag not in _INLINE:
            self._break()
        elif not self.fresh:
            self.lines[-1][1] += 1
        if tag in _VOID:
            return
        never, span = self.stack[-1][3] or tag in _NEVER, None
        left_out = self.stack[-1][2] or never
        if tag in ("article", "main"):
            span = [self.size, None]
            self.named.append(span)
        elif tag not in _OPEN and not never and self._doubtful(tag, attrs):
            left_out |= len(self.hinted) not in self.trusted
            span = [self.size, None]
            self.hinted.append(span)
        element = self.stack[-1][1]
        if tag not in _INLINE:
            element = len(self.parents)
            self.parents.append(self.stack[-1][1])
            self.names.append(tag)
        self.links += tag == "a"
        self.stack.append((tag, element, left_out, never, span))

    def handle_startendtag(self, tag, attrs):
        if tag not in _INLINE:
            self._break()

    def handle_endtag(self, tag):
        if tag not in _INLINE:
            self._break()
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                self._pop(i)
                return
            if self.stack[i][0] in _OPEN and tag not in _OPEN:
                return

    def handle_data(self, data):
        _, element, left_out, never, _ = self.stack[-1]
        if not never:
            self.size += sum(map(len, data.split()))
        if left_out or not data:
            return
        if self.fresh or self.lines[-1][3] != element:
            if data.isspace():
                return
            self.lines.append([[], 1, 0, element])
            self.fresh = False
        line = self.lines[-1]
        line[0].append(data)
        if self.links:
            line[2] += len(data)

    def _end_p(self):
        for i in range(len(self.stack) - 1, 0, -1):
            name = self.stack[i][0]
            if name == "p":
                self._pop(i)
                return
            if name not in _INLINE:
                return

    def _pop(self, i):
        self.links -= sum(x[0] == "a" for x in self.stack[i:])
        for *_, span in self.stack[i:]:
            if span:
                span[1] = self.size
        del self.stack[i:]

    def close(self):
        super().close()
        self._pop(1)

    def misleading(self) -> frozenset:
        """The hinted elements that hold more than half of the text, with no article or main beside them."""
        named = [x for x in self.named if x[0] < x[1]]
        return frozenset(
            i for i, (a, b) in enumerate(self.hinted) if 2 * (b - a) > self.size and not any(y <= a or x >= b for x, y in named)
        )

    def _doubtful(self, tag, attrs) -> bool:
        """Whether an element is left out unless it holds most of the page."""
        inside = any(x[0] in ("article", "main") for x in self.stack)
        if tag in _SELDOM and not (tag == "header" and inside):
            return True
        said = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
        if not said or (tag == "header" and inside):
            return False
        words = _PLAINEST if inside and tag in _CONTENT else _HINTS
        return not words.isdisjoint(w.lower() for w in _WORD.findall(said))


def _content(ratios: np.ndarray) -> np.ndarray:
    """Which lines belong to the upper of two clusters of the smoothed ratios."""
    reach = int(3 * SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    smooth = np.sqrt(np.convolve(np.pad(ratios, reach, mode="edge"), kernel / kernel.sum(), mode="valid"))
    low, high = smooth.min(), smooth.max()
    for _ in range(50):
        middle = (low + high) / 2
        above = smooth >= middle
        if above.all():
            break
        new = smooth[~above].mean(), smooth[above].mean()
        if new == (low, high):
            break
        low, high = new
    return smooth >= (low + high) / 2


def main_text(html: str | None) -> str:
    """The text of the page's main content, blocks joined by one blank."""
    if not html:
        return ""
    html = _CUT_TAG.sub("", html)
    parser = _Lines()
    parser.feed(html)
    parser.close()
    if misleading := parser.misleading():
        parser = _Lines(misleading)
        parser.feed(html)
        parser.close()
    lines = [(" ".join("".join(parts).split()), tags, links, element) for parts, tags, links, element in parser.lines]
    lines = [x for x in lines if x[0]]
    if not lines:
        return ""
    sizes = np.array([len(x[0]) for x in lines], float)
    chosen = _content(sizes / np.array([x[1] for x in lines]))
    weight = np.zeros(len(parser.parents))
    np.add.at(weight, [x[3] for x in lines], np.where(chosen, sizes, 0.0))
    for e in range(len(weight) - 1, 0, -1):  # parents come before their children
        weight[parser.parents[e]] += weight[e]
    enough = SHARE * weight[0]
    region = int(np.flatnonzero(weight >= enough)[-1]) if weight[0] else 0
    named = region
    while named and parser.names[named] not in ("article", "main"):
        named = parser.parents[named]
    if named:
        region = named
    elif weight[0]:
        region = int(np.flatnonzero(weight >= weight[0])[-1])
    # The innermost element that is no single block of text: a lone long paragraph stands for its parent.
    while region and parser.names[region] in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre", "blockquote", "td", "dd", "dt", "tr", "ul", "ol"):
        region = parser.parents[region]
    inside = np.zeros(len(weight), bool)
    inside[region] = True
    for e in range(region + 1, len(inside)):
        inside[e] = inside[parser.parents[e]]
    return " ".join(text for text, _, links, element in lines if inside[element] and (named or links <= LINKS * len(text)))


def _extract(batch):
    kept = [c for c in batch.schema.names if c != "_html"]
    for a in range(0, batch.num_rows, 500):
        part = batch.slice(a, 500)
        texts = [main_text(h.as_py()) for h in part.column("_html")]
        yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(texts, pa.string())], names=[*kept, "text"])


def extract(pages: DataFrame, *, html_col: str = "html", keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each page with its main ``text`` and ``n_chars``."""
    rows = pages.select(*(pages[c].alias(f"k_{c}") for c in keep), pages[html_col].cast("string").alias("_html"))
    types = ", ".join(f"`{c}` {t}" for c, t in rows.drop("_html").dtypes)
    done = by_batch(rows, f"{types}, text string", _extract)
    return done.select(*(F.col(f"k_{c}").alias(c) for c in keep), "text", F.length("text").cast("long").alias("n_chars"))


@query("op6_html_text")
def op6(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
