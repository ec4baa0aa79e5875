"""Operator 8: main text of web pages by text-to-tag ratio.

The standard library's parser streams events over the page. Block tags cut it into lines; a line
has its text, the number of its tags, its region, and whether it lies in a part that is never main
text (menus, headers, footers, sidebars, forms, scripts, adverts, notices, reader comments: by tag,
role, or words of class and id). The ratio of text to tags of the other lines is smoothed with a
Gaussian, and a two-means threshold splits them into content and rest. A region
is the outermost article, or outside of articles the innermost division, section, cell or the body.
The clustering chooses regions: one that holds a content line is kept as a whole, so that short
headings and paragraphs of an article stay, and no other text is kept.

Defined results: null or empty html gives an empty text; broken markup is read as the parser
reads it (unclosed tags end with their container, a comment or script that never ends swallows the
rest). Rows are handled one by one, repeated rows stay, other columns are ignored. Nothing is cut.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
EXCLUDED = frozenset(
    "aside audio button canvas dialog footer form head header iframe menu nav noscript object script select "
    "style svg template textarea title video".split()
)
REGIONS = frozenset(("article", "main"))
BOXES = frozenset(("body", "div", "section", "td"))
TRACKED = EXCLUDED | REGIONS | frozenset("body div section table td ul ol dl li p figure span".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HINTS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice notices "
    "pagination popup promo promotion related replies reply share sharing sidebar social sponsor sponsored "
    "subscribe toolbar widget".split()
)
PLAIN = frozenset("notice notices promotion related replies reply share sharing social".split())
PARTS = frozenset(
    "area articles bar block box button buttons card cards container content icons inner items links list "
    "panel post posts section stories wrapper".split()
)
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
SIGMA = 1.0


class Lines(HTMLParser):
    """Collects [text parts, tags, region, excluded] of each line of one page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = []  # tag, region, excluded
        self.lines: list[list] = []
        self.regions = 0
        self.count = 0
        self.at: defaultdict[str, list[int]] = defaultdict(list)  # places of a tag among the open ones
        self.break_line()

    def break_line(self):
        _, region, excluded = self.open[-1] if self.open else ("", 0, False)
        self.count += 1
        self.line = [[], 0, region, excluded]
        self.lines.append(self.line)

    def close_last(self):
        self.at[self.open.pop()[0]].pop()

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # a section of a kind that the parser doesn't know: a comment up to its end
            return self.parse_bogus_comment(i)

    def handle_starttag(self, tag, attrs):
        if tag == "body" or tag in REGIONS or tag == "footer":  # an unclosed head, menu or paragraph ends here
            while self.open and self.open[-1][0] in ("head", "nav", "p", "span", "ul", "ol", "li", "title"):
                self.close_last()
        elif tag == "p" and self.open and self.open[-1][0] == "p":
            self.close_last()
        if tag in TRACKED and tag not in VOID:
            _, region, excluded = self.open[-1] if self.open else ("", 0, False)
            if not excluded:
                excluded = tag in EXCLUDED or (bool(attrs) and tag not in REGIONS and tag != "body" and hinted(attrs))
            if (tag in REGIONS or tag in BOXES) and not excluded and not any(self.at[x] for x in REGIONS):
                self.regions += 1
                region = self.regions
            self.at[tag].append(len(self.open))
            self.open.append((tag, region, excluded))
        if tag in BLOCKS or tag in TRACKED and self.open[-1][2] != self.line[3]:
            self.break_line()
        self.line[1] += 1

    def handle_endtag(self, tag):
        if tag in TRACKED:
            last = lambda name: self.at[name][-1] if self.at[name] else -1
            place = last(tag)
            if tag not in REGIONS and tag != "body" and max(map(last, REGIONS)) > place:
                return  # a stray end tag doesn't end an article
            if place >= 0:
                was = self.open[-1]
                while len(self.open) > place:
                    self.close_last()
                if tag in BLOCKS or (self.open[-1][2] if self.open else False) != was[2]:
                    self.break_line()
                return
        if tag in BLOCKS:
            self.break_line()

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCKS:
            self.break_line()
        self.line[1] += 1

    def handle_data(self, data):
        self.line[0].append(data)


def hinted(attrs) -> bool:
    """Whether class, id or role name a part that isn't main text.

    A word with a plain meaning of its own (a share price, a related work) has to stand alone, or
    with words for parts of a page.
    """
    for name, value in attrs:
        if name in ("class", "id") and value:
            for label in value.lower().split():
                words = {w for w in re.split(r"[^a-z]+", label) if w}
                if words & HINTS - PLAIN or words & PLAIN and words <= HINTS | PARTS:
                    return True
        elif name == "role" and value and value.strip().lower() in ROLES or name == "hidden":
            return True
    return False


def content_lines(ratio: np.ndarray) -> np.ndarray:
    """Lines whose smoothed ratio lies above the threshold between two clusters."""
    if len(ratio) > 1:
        x = np.arange(-3, 4)
        kernel = np.exp(-(x**2) / (2 * SIGMA**2))
        ratio = np.convolve(np.pad(ratio, 3), kernel / kernel.sum(), "valid")
    low, high = ratio.min(), ratio.max()
    if high <= 0:
        return np.zeros(len(ratio), bool)
    for _ in range(8):
        cut = (low + high) / 2
        above = ratio > cut
        if above.all() or not above.any():
            break
        low, high = ratio[~above].mean(), ratio[above].mean()
    return ratio >= (low + high) / 2


def main_text(html: str | None) -> str:
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    lines = [(" ".join("".join(x[0]).split()), *x[1:]) for x in parser.lines if not x[3]]
    lines = [x for x in lines if x[0]]
    if not lines:
        return ""
    content = content_lines(np.array([len(x[0]) / max(1, x[1]) for x in lines]))
    chosen = {x[2] for x, good in zip(lines, content) if good}
    return " ".join(x[0] for x in lines if x[2] in chosen)


def _extract(batches):
    for batch in batches:
        texts = [main_text(x) for x in batch.column("html").to_pylist()]
        yield pa.record_batch(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array([len(x) for x in texts], pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, f"page_id {kinds['page_id']}, url string, text string, n_chars long"
    )
