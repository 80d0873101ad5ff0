"""Main text of web pages by text-to-tag ratios.

A streaming parser turns a page into lines, one per block, with their characters and tags. The ratio
of both per line is smoothed by a Gaussian and cut at a threshold; clusters of lines above it are
content. They select a region: the page's articles and the clusters beside them, or else the
innermost container that holds every cluster. The region's lines are the text, short ones too; what
page furniture holds is left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowplan.llm.common import slices

SIGMA = 1.5

# Elements by their role in a page.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Runs within a line; a name of furniture hides them at once.
INLINE = frozenset("a abbr b bdi bdo cite code del em font i ins kbd mark q s samp small span strong sub sup time u var".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
ARTICLES = frozenset(("article", "main"))
CONTAINERS = frozenset("article main section div td body".split())
FURNITURE = frozenset(
    "nav footer aside form script style noscript template iframe object svg button select option textarea input label menu "
    "dialog head title canvas audio video map".split()
)
HINT = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|advertisement|advertising|sponsor|sponsored|promo|banner|nav|navbar|navigation|menu|"
    r"breadcrumb|breadcrumbs|sidebar|side-bar|aside|footer|header|masthead|topbar|cookie|cookies|consent|gdpr|notice|notices|"
    r"notification|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|search|share|sharing|social|"
    r"related|recommended|comment|comments|disqus|replies|respond|widget|toolbar|pagination|pager|copyright|legal|"
    r"disclaimer|skip|skip-link)(?:$|[\s_\d-])",
    re.I,
)
#: Names that say what an element lacks or stands beside, such as has-sidebar.
BESIDE = re.compile(r"(?<![\w-])(?:has|no|not|with|without)[_-][\w-]+", re.I)
#: Names that inside an article or main stand for parts of the article.
TOPICAL = re.compile(
    r"(?<![^\s_-])(?:header|masthead|related|recommended|legal|search|notice|notices|alert|menu|disclaimer|copyright)(?![^\s_\d-])", re.I
)
#: Names of long text that is furniture wherever a page has an article or main outside it.
APART = re.compile(
    r"(?<![^\s_-])(?:ad|ads|advert|advertisement|advertising|sponsor|sponsored|cookie|cookies|consent|gdpr|newsletter|popup|modal|comment|"
    r"comments|disqus|replies|respond)(?![^\s_\d-])",
    re.I,
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: Where a start tag ends an open element of the same kind.
SELF_CLOSING = {"li": {"li"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}


@dataclass
class Hinted:
    """An element with a name of furniture: its lines, and the articles around, inside and before it."""

    first: int
    end: int
    apart: bool
    inside: bool
    around: int
    opened: int
    holds: bool = False


class PageLines(HTMLParser):
    """Lines of a page (text, tags) outside furniture, the containers (tag, first line, end) around them, and what is hinted by name."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int]] = []
        self.open: list[tuple[str, bool, int | None, Hinted | None]] = []
        self.opened: Counter[str] = Counter()
        self.hidden = self.tags = 0
        self.text: list[str] = []
        self.links: list[bool] = []
        self.linked = 0
        self.containers: list[list] = []
        self.hinted: list[Hinted] = []
        self.anchor = False
        self.named = self.articles = self.clean = self.around = 0

    def _flush(self):
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append((text, self.tags))
            self.links.append(2 * self.linked > len(text) and not any(self.opened[h] for h in HEADINGS))
            self.tags = 0
        self.text, self.linked = [], 0

    def _pop(self):
        tag, hidden, container, hint = self.open.pop()
        self.opened[tag] -= 1
        self.hidden -= hidden
        if hint is not None:
            hint.end, hint.holds = len(self.lines), self.articles > hint.opened
            self.named -= 1
        elif tag in ARTICLES and not self.named and not self.hidden:
            self.around -= 1
        if container is not None:
            self.containers[container][2] = len(self.lines)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._flush()
        self.tags += 1
        if tag in VOID:
            return
        self.anchor = tag == "a" or self.anchor and tag not in BLOCKS
        enders = SELF_CLOSING.get(tag)
        if enders and self.open and self.open[-1][0] in enders:
            self._pop()
        inside = bool(self.opened["article"] or self.opened["main"])
        hidden, hint = tag in FURNITURE or tag == "header" and not inside, None
        if not hidden and attrs and tag not in ("html", "body", "article", "main"):
            values = dict(attrs)
            named = BESIDE.sub(" ", f"{values.get('class') or ''} {values.get('id') or ''}").strip()
            if inside:
                named = TOPICAL.sub(" ", named)
            furniture = bool(named and HINT.search(named))
            if furniture and tag not in INLINE and not self.hidden:
                hint = Hinted(len(self.lines), 0, bool(APART.search(named)), inside, self.around, self.articles)
            hidden = (
                furniture
                and tag in INLINE
                or (values.get("role") or "") in ROLES
                or "hidden" in values
                or values.get("aria-hidden") == "true"
                or "display:none" in (values.get("style") or "").replace(" ", "")
            )
        if hint is not None:
            self._flush()  # elements of unknown kinds have lines of their own, too
            hint.first = len(self.lines)
        if tag in BLOCKS or hidden or hint is not None:
            container = len(self.containers) if tag in CONTAINERS else None
            if container is not None:
                self.containers.append([tag, len(self.lines), None])
            if hint is not None:
                self.hinted.append(hint)
                self.named += 1
            elif tag in ARTICLES and not self.hidden:
                self.articles += 1
                if not self.named:
                    self.clean += 1
                    self.around += 1
            self.open.append((tag, hidden, container, hint))
            self.opened[tag] += 1
            self.hidden += hidden

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1][0] == tag:
            self._pop()

    def handle_endtag(self, tag):
        if tag in BLOCKS or self.named and self.open[-1][0] == tag:
            self._flush()
        self.tags += 1
        self.anchor = self.anchor and tag != "a"
        if self.opened[tag]:
            while self.open[-1][0] != tag:
                self._pop()
            self._pop()

    def handle_data(self, data):
        if not self.hidden:
            self.text.append(data)
            if self.anchor:
                self.linked += len(data)

    def close(self):
        super().close()
        self._flush()
        while self.open:
            self._pop()


def _smoothed(ratio: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratio)), kernel, "same") if len(ratio) > 2 * reach else None
    if weight is None:
        distance = np.arange(len(ratio))[:, None] - np.arange(len(ratio))[None, :]
        full = np.exp(-0.5 * (distance / sigma) ** 2)
        return full @ ratio / full.sum(1)
    return np.convolve(ratio, kernel, "same") / weight


def _by_name(parser: PageLines, chars: np.ndarray, ratio: np.ndarray, content: np.ndarray, least: float) -> np.ndarray:
    """Which lines stand in an element with a name of furniture that the clusters do not speak for.

    Such an element is kept when it holds the page's articles or half of the clusters' characters;
    one inside an article also when most of its own lines are above the threshold.
    """
    mass = np.concatenate([[0], np.cumsum(chars * content)])
    high = np.concatenate([[0], np.cumsum(chars * (content & (ratio >= least)))])
    size = np.concatenate([[0], np.cumsum(chars)])
    edges = np.zeros(len(chars) + 1, np.int64)
    for h in parser.hinted:
        a, b = h.first, h.end
        alone = parser.clean == h.around
        kept = h.holds and alone or 2 * (mass[b] - mass[a]) >= mass[-1] and (h.inside or alone)
        kept = kept or h.inside and 2 * (high[b] - high[a]) >= size[b] - size[a]
        if not kept or h.apart and parser.clean:
            edges[a] += 1
            edges[b] -= 1
    return np.cumsum(edges[:-1]) > 0


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """The main text of one page; empty for pages without any."""
    if not html:
        return ""
    parser = PageLines()
    parser.feed(html)
    parser.close()
    lines = parser.lines
    if not lines:
        return ""
    chars = np.fromiter((len(t) for t, _ in lines), float, len(lines))
    ratio = chars / np.fromiter((max(1, n) for _, n in lines), float, len(lines))
    smooth = _smoothed(ratio, sigma)
    least = min(smooth.std(), smooth.mean())
    content = smooth >= least
    gone = _by_name(parser, chars, ratio, content, least) if parser.hinted else np.zeros(len(lines), bool)
    content &= ~gone
    edges = np.zeros(len(lines) + 1, np.int64)
    for tag, a, b in parser.containers:
        if tag in ARTICLES:
            edges[a] += 1
            edges[b] -= 1
    within = np.cumsum(edges[:-1]) > 0
    # A strip of links is raised by its neighbours only; linked headings and paragraphs are not meant.
    content &= within | (ratio >= least) | ~np.asarray(parser.links)
    if 2 * (chars * (content & within)).sum() >= max(1, (chars * content).sum()):
        region = within | content
    else:
        # Containers come from the outside in, so the last that holds every cluster is innermost.
        at = np.flatnonzero(content)
        holding = [(a, b) for _, a, b in parser.containers if len(at) and a <= at[0] and at[-1] < b]
        first, end = holding[-1] if holding else (0, len(lines))
        region = np.zeros(len(lines), bool)
        region[first:end] = True
    region &= ~gone
    return "\n".join(t for (t, _), kept in zip(lines, region.tolist(), strict=True) if kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Null or empty html gives an empty text; repeated rows are repeated. Other columns are ignored.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
