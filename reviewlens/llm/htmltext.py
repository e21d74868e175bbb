"""HTML extraction: parser events, text-to-tag ratio per line, Gaussian smoothing and threshold clustering.

The standard library's parser streams a page once.  A *line* is the text between two block boundaries; its ratio is
its characters over its tags.  The ratios, smoothed with a Gaussian over neighbouring lines, are cut at their standard
deviation: what reaches it is content.  The content lines vote with their length for the elements around them.  An article or
main element with most of the votes is the region; its lines are the text, but for those in boilerplate elements.  On a
page without one, the text is every such line from the first to the last content line within the innermost element around
all of them, and the lines next to these on either side up to a boilerplate line or the element's end: headings, short
introductions and closing lines belong to the article though their ratios are low.

Boilerplate elements are those of ``BOILERPLATE`` and those that a class, id or role marks.  A mark does not count on an element
that wraps the article: one with a heading, article or main inside, beside which next to no unmarked text is left.
"""

from __future__ import annotations

from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_ready, parts_of

# Element names by role, as HTML defines them.
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr
ul""".split())
SILENT = frozenset("""script style noscript template head title svg math iframe object canvas audio video select textarea
button option datalist map""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog".split())
CLOSES_P = BLOCKS - {"body", "html"}
#: Words of class, id or role that mark an element as no part of the article.
MARKERS = frozenset("""ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline
comment comments complementary consent contentinfo cookie cookies copyright dialog disqus footer header login masthead
menu modal nav navbar navigation newsletter notice notices pager pagination popup promo recommended related
respond search share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar widget widgets""".split())
#: Elements that are never boilerplate by their class or id.
REGIONS = frozenset("html body main article".split())

#: What the head of a page may hold; any other element ends it.
IN_HEAD = frozenset("title style script noscript template meta link base".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WRAPS = frozenset("h1 h2 article main".split())

SIGMA = 1.0
MOST = 0.6
#: Unmarked text outside a marked element, as a share of the text inside, up to which the element is a wrapper.
OUTSIDE = 0.1


def marked(attrs: list[tuple[str, str | None]]) -> bool:
    for name, value in attrs:
        if name == "hidden":
            return True
        if value and name in ("class", "id", "role"):
            for c in "-_:":
                value = value.replace(c, " ")
            if not MARKERS.isdisjoint(value.lower().split()):
                return True
    return False


class Page(HTMLParser):
    """Lines of a page: (text, tags, boilerplate, elements around it).

    Until ``settle`` boilerplate means the elements' names alone; ``marks`` has the elements that attributes mark.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, bool, tuple[int, ...]]] = []
        self.stack: list[tuple[str, int, bool, bool]] = []  # name, number, boilerplate, silent
        self.names: list[str] = []
        self.marks: dict[int, bool] = {}  # marked elements, and whether something of WRAPS is inside
        self.buffer: list[str] = []
        self.tags = 1

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def flush(self) -> None:
        if not self.buffer:
            self.tags = 1
            return
        text = " ".join("".join(self.buffer).split())
        if text:
            self.lines.append((text, self.tags, bool(self.stack) and self.stack[-1][2], tuple(e[1] for e in self.stack)))
        self.buffer, self.tags = [], 1

    def pop_to(self, at: int) -> None:
        if any(e[0] in BLOCKS for e in self.stack[at:]):
            self.flush()
        del self.stack[at:]

    def close_open(self, name: str, stop: frozenset[str]) -> None:
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == name:
                return self.pop_to(at)
            if self.stack[at][0] in stop:
                return None
        return None

    def settle(self) -> None:
        """Let the marks count, but for those on wrappers of the article."""
        if not self.marks:
            return
        inside = dict.fromkeys(self.marks, 0)
        unmarked = 0
        for text, _, boiler, around in self.lines:
            if not boiler:
                own = [e for e in around if e in self.marks]
                unmarked += 0 if own else len(text)
                for e in own:
                    inside[e] += len(text)
        real = {e for e, wraps in self.marks.items() if not (wraps and unmarked <= OUTSIDE * inside[e])}
        self.lines = [(text, tags, boiler or not real.isdisjoint(around), around) for text, tags, boiler, around in self.lines]

    def handle_starttag(self, tag, attrs):
        if tag not in IN_HEAD and tag != "head" and any(e[0] == "head" for e in self.stack):
            self.close_open("head", frozenset())
        if tag in CLOSES_P:
            self.flush()
            self.close_open("p", CLOSES_P - {"p"})
        if tag == "li":
            self.close_open("li", frozenset(("ul", "ol", "menu")))
        elif tag in ("dt", "dd"):
            self.close_open("dt", frozenset(("dl",)))
            self.close_open("dd", frozenset(("dl",)))
        elif tag == "tr":
            self.close_open("tr", frozenset(("table",)))
        if tag in ("br", "td", "th", "img"):
            self.buffer.append(" ")
        if tag in VOID:
            self.tags += 1
            return
        outer = self.stack[-1] if self.stack else ("", 0, False, False)
        # An article's own header holds its title.
        in_article = tag == "header" and any(e[0] == "article" for e in self.stack)
        boiler = outer[2] or (tag in BOILERPLATE and not in_article)
        if tag in WRAPS:
            for e in self.stack:
                if e[1] in self.marks:
                    self.marks[e[1]] = True
        self.names.append(tag)
        if tag not in REGIONS and marked(attrs):
            self.marks[len(self.names) - 1] = False
        self.stack.append((tag, len(self.names) - 1, boiler, outer[3] or tag in SILENT))
        if tag not in BLOCKS:
            self.tags += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in SILENT:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                self.pop_to(at)
                break
        self.tags += 1

    def handle_data(self, data):
        if not (self.stack and self.stack[-1][3]):
            self.buffer.append(data)


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian-weighted mean of each line's neighbourhood (two sigmas to either side)."""
    reach = max(1, int(round(2 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel, "full")[reach:reach + len(ratios)]
    return np.convolve(ratios, kernel, "full")[reach:reach + len(ratios)] / weight


def main_text(html: str | None) -> str:
    """The article's blocks, one a line; empty if there is none."""
    if not html:
        return ""
    page = Page()
    # Marked sections are no HTML; as such they are bogus comments.
    page.feed(html.replace("<![", "<! [") if "<![" in html else html)
    page.close()
    page.flush()
    page.settle()
    lines = [x for x in page.lines if not x[2]]
    if not lines:
        return ""
    ratios = np.array([len(text) / tags if not boiler else 0.0 for text, tags, boiler, _ in page.lines])
    smooth = smoothed(ratios)
    threshold = smooth.std()
    votes: dict[int, int] = {}
    total = 0
    for (text, _, boiler, around), s in zip(page.lines, smooth):
        if not boiler and s >= threshold:
            total += len(text)
            for e in around:
                votes[e] = votes.get(e, 0) + len(text)
    named = [e for e, v in votes.items() if v >= MOST * total and page.names[e] in ("article", "main")]
    if named:
        region = max(named)
        return "\n".join(text for text, _, _, around in lines if region in around)
    content = [i for i, (x, v) in enumerate(zip(page.lines, smooth)) if not x[2] and v >= threshold]
    if not content:
        return "\n".join(x[0] for x in lines)
    common = set(page.lines[content[0]][3])
    for i in content:
        common &= set(page.lines[i][3])
    around = max(common, default=None)
    first, last = content[0], content[-1]

    def goes_on(i: int) -> bool:
        return 0 <= i < len(page.lines) and not page.lines[i][2] and (around is None or around in page.lines[i][3])

    # A paragraph alone does not hold its article's heading: climb to the block that has more lines.
    while around is not None and page.names[around] not in ("body", "html") and not (goes_on(first - 1) or goes_on(last + 1)):
        outer = [e for e in page.lines[first][3] if e < around]
        around = max(outer, default=None)
    while goes_on(first - 1):
        first -= 1
    while goes_on(last + 1):
        last += 1
    return "\n".join(text for text, _, boiler, _ in page.lines[first:last + 1] if not boiler)


def extract(df: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``df`` (columns page_id, url, html); n_chars in code points.

    Null and empty pages, and pages without text outside boilerplate, have the empty text.  Nulls in page_id and url are
    kept.  Repeated rows are rows of their own; an empty table gives no rows.
    """
    arrow_ready(df.sparkSession)

    def run(batches):
        for batch in batches:
            for part in parts_of(batch, "html"):
                texts = [main_text(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    pages = df.select("page_id", "url", "html")
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")


def op9_html_text(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return extract(table(spark, sf_dir, "pages"))
