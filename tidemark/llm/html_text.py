"""Main text of web pages by smoothed text-to-tag ratios.

The standard library's parser streams events; block tags cut the page into
lines, each with the text it holds, the tags it holds, how much of its text is
link text, and its chain of open elements. A line's ratio is its text length
over its tags. The ratios are smoothed with a Gaussian over neighbouring lines
and split in two clusters by their threshold; the lines above it vote, by their
text, for the elements that hold them. A word in a class, id or role that names
boilerplate lowers a line's vote and ratio, no more. The content region is the page's
article elements, or its main element, if they hold nearly all of those votes,
else the deepest element that does. Names of the region and of what is around
it don't count any more: the votes chose it. All its lines are the text, except

* elements that are boilerplate by what they are (navigation, forms, scripts
  and the like), which no vote counts for either, and
* elements inside the region that are named as boilerplate (readers' comments,
  notices), unless even their lowered ratio reaches that of the region's text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: HTML's element names by what they mean for a page's text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template head title iframe object svg math canvas audio video".split())
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
ASIDE = frozenset("nav aside footer form button select textarea input menu dialog label".split())
#: Words in class, id and role that name boilerplate.
LABELS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|sidebar|side|footer|masthead|"
    r"topbar|cookies?|consent|notices?|gdpr|popup|modal|newsletter|subscribe|signup|login|share|sharing|social|"
    r"related|recommend\w*|comments?|replies|disqus|respond|pagination|pager|widget|toolbar|search|skip)(?=$|[\s_-])", re.I)
#: Closing by what opens next: fixed values of HTML's optional end tags.
CLOSES = {"p": frozenset({"p"}), "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
          "tr": frozenset({"tr", "td", "th"}), "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}),
          "option": frozenset({"option"})}
SPACE = re.compile(r"\s+")
SMOOTH = 2.0  # standard deviation of the Gaussian, in lines
LOWERED = 0.15  # factor for the votes and ratios of lines in elements named as boilerplate
HOLDS = 0.9  # share of the votes that the content region holds


@dataclass
class Line:
    text: str
    tags: int
    linked: int  # characters of the text inside links
    path: tuple[int, ...]  # numbers of the open elements, outermost first
    boilerplate: bool  # by an element that it is in
    named: tuple[int, ...] = ()  # those of ``path`` that are named as boilerplate

    @property
    def own(self) -> int:
        """Characters that no link has."""
        return len(self.text) - self.linked

    @property
    def vote(self) -> float:
        return self.own * (LOWERED if self.named else 1)

    @property
    def lowered(self) -> float:
        return self.vote / max(1, self.tags)


class LineParser(HTMLParser):
    """Cuts a page into lines at block tags."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[tuple[str, int, bool, bool]] = []  # name, number, boilerplate, unseen
        self.names: dict[int, str] = {}
        self.named: set[int] = set()
        self.text: list[str] = []
        self.tags = self.linked = self.links = 0

    def cut(self) -> None:
        text = SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            path = tuple(x[1] for x in self.open)
            self.lines.append(Line(text, self.tags, self.linked, path, bool(self.open) and self.open[-1][2],
                                   tuple(n for n in path if n in self.named)))
            self.tags = 0
        self.text, self.linked = [], 0

    def close_head(self) -> None:
        """The end tag of head is optional: what can't be in it ends it."""
        while self.open and self.open[-1][0] == "head":
            self.open.pop()

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.cut()
        if tag not in IN_HEAD:
            self.close_head()
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
            return
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if name in CLOSES.get(tag, ()) or name == "p" and tag in BLOCKS:
                del self.open[i:]
                break
            if name in BLOCKS and name != "p":
                break
        outer = self.open[-1] if self.open else ("", 0, False, False)
        said = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
        page_header = tag == "header" and not any(x[0] in ("article", "main") for x in self.open)
        bad = outer[2] or tag in ASIDE or page_header
        number = len(self.names) + 1
        self.names[number] = tag
        if tag not in ("html", "body", "article", "main") and said and LABELS.search(said):
            self.named.add(number)
        self.open.append((tag, number, bad, outer[3] or tag in UNSEEN))
        self.links += tag == "a"

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.cut()
        self.tags += 1
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break
        self.links = sum(x[0] == "a" for x in self.open) if tag == "a" else self.links

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # HTML ignores the slash

    def handle_data(self, data):
        if data.strip("\t\n\f\r "):
            self.close_head()
        if not (self.open and self.open[-1][3]):
            self.text.append(data)
            if self.links:
                self.linked += len(data)


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing over lines; at the ends the weights are those there are."""
    reach = math.ceil(3 * SMOOTH)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SMOOTH) ** 2)
    full = lambda x: np.convolve(x, kernel)[reach : reach + len(x)]
    return full(ratios) / full(np.ones_like(ratios))


def threshold(values: np.ndarray) -> float:
    """Border between two clusters (two means) of the values' logarithms."""
    x = np.log1p(values)
    low, high = x.min(), x.max()
    for _ in range(50):
        border = (low + high) / 2
        above = x > border
        if above.all() or not above.any():
            break
        new = x[~above].mean(), x[above].mean()
        if new == (low, high):
            break
        low, high = new
    return float(np.expm1((low + high) / 2))


def content(lines: list[Line], names: dict[int, str]) -> list[str]:
    """Texts of the lines in the content region, in page order."""
    fair = [i for i, x in enumerate(lines) if not x.boilerplate]
    if not fair:
        return []
    ratio = np.array([0.0 if x.boilerplate else x.own / max(1, x.tags) for x in lines])
    smooth = smoothed(ratio)
    border = threshold(smooth)
    chosen = [i for i in fair if smooth[i] >= border] or fair
    # a line that only its neighbours lift over the border counts by its own ratio
    vote = {i: lines[i].vote * (min(1.0, ratio[i] / border) if border > 0 else 1.0) for i in chosen}
    votes: dict[int, float] = {}
    total = 0.0
    for i in chosen:
        own = vote[i]
        total += own
        for number in lines[i].path:
            votes[number] = votes.get(number, 0) + own
    held = [n for n, v in votes.items() if v >= HOLDS * total and names[n] not in ("p", "b", "i", "em", "strong", "span", "a", "font", "u", "small")]
    region = {max(held)} if held else set()  # the deepest is numbered last along a chain
    for said in ("main", "article"):  # the page says where its article is
        own = {n for n in votes if names[n] == said}
        inside = sum(vote[i] for i in chosen if own.intersection(lines[i].path))
        if own and inside >= HOLDS * total:
            region = own
    inside = [lines[i] for i in fair if not region or region.intersection(lines[i].path)]
    return [x.text for x in without_named(inside, region)]


def without_named(lines: list[Line], region: set[int]) -> list[Line]:
    """The region's lines but those of named elements inside it, unless an
    element's ratio, lowered, reaches the usual one of the other lines (the
    median, by text)."""
    def outermost(line: Line) -> int | None:
        begin = max((line.path.index(n) for n in region.intersection(line.path)), default=-1)
        return next((n for n in line.named if line.path.index(n) > begin), None)

    own = [outermost(x) for x in lines]
    rest = sorted((x.lowered, len(x.text)) for x, n in zip(lines, own, strict=True) if n is None)
    if not rest:
        return lines
    half, usual = sum(size for _, size in rest) / 2, 0.0
    for usual, size in rest:  # noqa: B007
        half -= size
        if half <= 0:
            break
    sums: dict[int, list[float]] = {}
    for x, n in zip(lines, own, strict=True):
        if n is not None:
            of = sums.setdefault(n, [0.0, 0.0])
            of[0] += x.lowered * len(x.text)
            of[1] += len(x.text)
    return [x for x, n in zip(lines, own, strict=True) if n is None or sums[n][0] >= usual * sums[n][1]]


def main_text(html: str) -> str:
    parser = LineParser()
    parser.feed(html)
    parser.close()
    parser.cut()
    return "\n\n".join(content(parser.lines, parser.names))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h.as_py() or "") for h in batch.column("html")]
        names = [n for n in batch.schema.names if n != "html"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            [*names, "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``pages``' columns but ``html``, plus ``text`` (main text of the whole
    html: blocks with white space collapsed, joined by an empty line) and
    ``n_chars``, its code points. Null or empty html, and pages with no text,
    give empty text; ``pages``' own columns of these names are replaced."""
    rows = pages.drop("text", "n_chars")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "html")
    return rows.mapInArrow(_extract, f"{schema}, text string, n_chars long" if schema else "text string, n_chars long")


def pages_report(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    return extract(pages.select("page_id", F.col("url"), "html"))
