"""Main text of web pages by text-to-tag ratios.

A page streams through the standard library's parser. Its events make lines (one per block of text)
with the number of characters and tags of each and the sectioning elements around it. The ratio of
text to tags per line is smoothed by a Gaussian, and lines above a threshold (the standard deviation
of the smoothed ratios, limited to half their mean) are content. Content lines choose the region:
``article`` and ``main`` elements if at least half of the content is in them, else the innermost
section around all content lines; and of it all lines. So short paragraphs between long ones stay,
and what the page declares as menu, footer, notice and the like goes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Names of elements by their meaning in HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li legend main menu nav"
    " ol p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
LEFT_OUT = frozenset(
    "applet aside audio button canvas datalist dialog footer form frameset head header iframe input"
    " label map menu meter nav noframes noscript object option progress script search select style"
    " svg template textarea title video".split()
)
SECTIONS = frozenset("article body details div main section td".split())
# Words in class, id and role that declare boilerplate.
_NOTICE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|promotion"
    r"|banner|sidebar|side-bar|nav|navbar|navigation|menu|breadcrumbs?|footer|header|masthead|cookies?"
    r"|consent|notice|notices|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login"
    r"|share|sharing|social|related|recommended|recommendations|comments?|commentlist|disqus|replies"
    r"|pagination|pager|toolbar|widget|complementary|contentinfo|skip-link)(?:$|[\s_-]|\d)",
    re.I,
)
_CUT_OFF = re.compile(r"<[a-zA-Z/!?]")
_SPACE = re.compile(r"\s+")


@dataclass
class Line:
    """A block of text: its parts, the tags in it, and the numbers of the sections around it."""

    sections: tuple[int, ...]
    parts: list[str] = field(default_factory=list)
    tags: int = 1

    def text(self) -> str:
        return _SPACE.sub(" ", "".join(self.parts)).strip()


class PageLines(HTMLParser):
    """Collects the lines of a page outside of boilerplate elements."""

    # Elements that close an open one of the same kind when they begin.
    _ALIKE = {
        name: frozenset(group.split())
        for group in ("li", "dd dt", "option", "tr", "td th", "p")
        for name in group.split()
    }

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.section_names: list[str] = ["page"]
        self._open: list[tuple[str, bool, int | None]] = []  # name, left out, section number
        self._out = 0
        self._sections: tuple[int, ...] = (0,)
        self._line = Line(self._sections)

    def _break(self) -> None:
        if self._line.parts:
            self.lines.append(self._line)
        self._line = Line(self._sections)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("p", "li", "dd", "dt", "option", "tr", "td", "th"):
            self._close_alike(tag)
        elif tag in BLOCKS and self._open and self._open[-1][0] == "p":
            self.handle_endtag("p")
        if tag in BLOCKS:
            self._break()
        elif tag == "br":
            self._line.parts.append(" ")
        self._line.tags += 1
        if tag in VOID or (tag not in BLOCKS and tag not in LEFT_OUT and not attrs):
            return  # an inline element of no meaning here
        out = tag in LEFT_OUT or any(
            name in ("class", "id", "role") and value and _NOTICE.search(value)
            for name, value in attrs
        ) and tag not in ("html", "body", "main", "article")
        out = out or any(n == "hidden" or (n == "aria-hidden" and v == "true") for n, v in attrs)
        section = None
        if tag in SECTIONS:
            section = len(self.section_names)
            self.section_names.append(tag)
            self._sections += (section,)
            self._line.sections = self._sections
        self._open.append((tag, bool(out), section))
        self._out += bool(out)

    def _close_alike(self, tag: str) -> None:
        alike = self._ALIKE[tag]
        for name, _, section in reversed(self._open):
            if name in alike:
                self.handle_endtag(name)
                return
            if name in BLOCKS:  # nested in another block, such as a list in a list
                return

    def handle_endtag(self, tag: str) -> None:
        self._line.tags += 1
        if tag in BLOCKS:
            self._break()
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == tag:
                break
            # The end of an inline element doesn't close a block around it.
            if tag not in BLOCKS and self._open[i][0] in BLOCKS:
                return
        else:
            return
        self._out -= sum(out for _, out, _ in self._open[i:])
        ended = [section for _, _, section in self._open[i:] if section is not None]
        if ended:
            self._sections = self._sections[: self._sections.index(ended[0])]
        del self._open[i:]
        self._line.sections = self._sections

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_data(self, data: str) -> None:
        if not self._out:
            self._line.parts.append(data)

    def finished(self) -> list[tuple[Line, str]]:
        self.close()
        self._break()
        found = [(line, line.text()) for line in self.lines]
        return [(line, text) for line, text in found if text]


def smoothed(ratios: np.ndarray, radius: int = 2) -> np.ndarray:
    """A Gaussian over ``radius`` lines to both sides, with deviation ``radius``; ends renormalised."""
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / radius) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[radius : radius + len(ratios)]
    return np.convolve(ratios, kernel)[radius : radius + len(ratios)] / weight


def main_text(html: str | None) -> str:
    """The text of the content regions, blocks joined by line feeds; empty if there is none."""
    page = PageLines()
    html = html or ""
    if html.rfind("<") > html.rfind(">") and _CUT_OFF.match(html, html.rfind("<")):
        html = html[: html.rfind("<")]  # the page ends within a tag
    page.feed(html)
    lines = page.finished()
    if not lines:
        return ""
    lengths = np.array([len(text) for _, text in lines], float)
    ratios = smoothed(lengths / np.array([line.tags for line, _ in lines]))
    content = ratios >= min(ratios.std(), ratios.mean() / 2)
    names = page.section_names
    named = np.array([any(names[s] in ("article", "main") for s in line.sections) for line, _ in lines])
    weight = lengths * content
    if weight.any() and 2 * weight[named].sum() >= weight.sum():
        return "\n".join(text for (_, text), inside in zip(lines, named) if inside)
    # The innermost section around all content: what the first and the last path have in common.
    paths = [line.sections for (line, _), good in zip(lines, content) if good] or [(0,)]
    around = 0
    for section, other in zip(min(paths), max(paths)):
        if section != other:
            break
        around = section
    return "\n".join(text for line, text in lines if around in line.sections)


def extracted(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of whole pages; a null page is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars bigint"
    )
