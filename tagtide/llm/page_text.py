"""Main text of web pages: parser events, text-to-tag ratios, smoothing, clustering.

The standard library's parser streams events; they are cut into lines, one per block
element. Lines inside elements that hold no article text (menus, headers outside an
article, footers, side bars, scripts, and those whose class, id or role says so) are
boilerplate. Outside of articles a name and a form only make suspect: wrappers of whole
pages carry such names too. A suspect that holds the page's largest article, or most of
the text of a page without articles, is none, unless it is named for comments. Text of buttons, labels and other
controls, of scripts' stand-ins and of embedded objects is never part of a line, nor is
that of hidden elements. The other lines have a ratio of text to tags, from which link text is left
out. They make up regions: an article or main element each, and each run of lines outside
of them. Ratios are smoothed by a Gaussian along the lines of a region, so short
paragraphs among long ones keep up and no region lifts its neighbour, and split by a
threshold from two-means clustering over the page. Regions with a line above it are
content: an element as a whole, a run from its first to its last such line.

Inside a line, runs of white space are one space; a line break is white space. Lines are
joined in page order.

Nulls and odd rows: null html is the empty page, without text; text outside any element
is a line; unclosed and stray tags are taken as the parser gives them; repeated rows are
extracted each; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.5

# Names of elements and roles by their meaning in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table"
    " tbody td tfoot th thead tr ul".split()
)
SKIPPED = frozenset(
    "head title script style noscript template svg iframe object embed applet canvas audio video nav aside"
    " footer button select textarea input label dialog menu".split()
)
#: Those that stand within lines: their text is left out of the line around them.
SILENT = SKIPPED - BLOCKS
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
REGIONS = frozenset("article main".split())
#: Closed by the start of another block, as in HTML.
SHORT_LIVED = {
    "p": frozenset({"p"}),
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "td": frozenset({"td", "th"}),
    "th": frozenset({"td", "th"}),
    "tr": frozenset({"tr"}),
    "option": frozenset({"option"}),
}
#: A short-lived element around one of these stays open.
NESTS = frozenset("ul ol dl table td th select article section main div body button form".split())
#: Words in a class or id that name boilerplate.
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adbox|adslot|banner|sponsor(?:ed)?|promos?|promotion"
    r"|nav|navbar|navigation|navi|menu|menus|breadcrumbs?|sidebar|side-?bar|aside|widgets?|masthead|topbar"
    r"|footer|foot|copyright|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|newsletter|subscribe|signup"
    r"|login|search|comments?|commentlist|disqus|replies|respond|discussion|share|sharing|social|related"
    r"|recommended|recommendations?|pagination|pager|toolbar|skip)(?:$|[\s_\d-])",
    re.IGNORECASE,
)
#: Words of these that are common in an article's own slugs as well: inside a region, a name of
#: them counts only as a whole.
WHOLE = frozenset("ad ads alert alerts banner consent copyright login notice notices signup".split())
#: Those that even as a whole may name a section of the article: its lines stay if they have a
#: content line's ratio and few links.
AMBIGUOUS = frozenset(
    "discussion foot menu menus navigation promotion recommendation recommendations recommended related replies respond"
    " search share sharing skip social".split()
)
#: What a name of boilerplate may hold besides.
QUALIFIERS = frozenset(
    "area articles bar block box button buttons container content form icons inner items links list media module outer"
    " panel posts section site stories top widget wrap wrapper".split()
)
#: Before a name these say how a page is laid out.
STATES = frozenset("has no with without is show hide".split())
#: What a title's own header is named for.
TITLED = frozenset("article content entry post story".split())
#: Suspects that stay boilerplate whatever they hold.
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|replies|respond)(?:$|[\s_\d-])", re.IGNORECASE)
UNSEEN = re.compile(r"(?:^|[;\s])(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.IGNORECASE)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MOST_LINKED = 0.25
#: An article's own header holds its title: only one outside is boilerplate.
HEADER = re.compile(r"(?:^|[\s_-])header(?:$|[\s_\d-])", re.IGNORECASE)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Line:
    text: str
    tags: int
    linked: int
    region: int
    boilerplate: bool
    doubtful: bool = False
    suspects: tuple[int, ...] = ()

    @property
    def ratio(self) -> float:
        return max(0, len(self.text) - self.linked) / max(1, self.tags)

    @property
    def free(self) -> bool:
        """Whether few of its characters are in links."""
        return self.linked <= MOST_LINKED * len(self.text)


def named_inside(slug: str) -> str:
    """Whether a class or id of an element inside a region names boilerplate."""
    if not NAMED.search(slug):
        return ""
    words = [w for w in re.split(r"[_\d-]+", slug.lower()) if w]
    if any(w not in AMBIGUOUS | WHOLE and NAMED.search(w) for w in words) or "side" in words and "bar" in words:
        return "sure"
    if not all(w in AMBIGUOUS | WHOLE | QUALIFIERS for w in words):
        return ""
    return "sure" if any(w in WHOLE for w in words) else "doubtful"


def named_outside(slug: str) -> bool:
    """The same outside of regions, where a part is enough to make suspect."""
    words = [w for w in re.split(r"[_\d-]+", slug.lower()) if w]
    if words and words[0] in STATES:
        return False
    return bool(NAMED.search(slug) or HEADER.search(slug) and not TITLED & {*words})


@dataclass(frozen=True)
class Open:
    """An open element and what it hands down."""

    tag: str = ""
    boilerplate: bool = False
    region: int = 0
    silent: bool = False
    doubtful: bool = False
    suspects: tuple[int, ...] = ()


class Lines(HTMLParser):
    """Collects the lines of a page from parser events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[Open] = []
        self.parts: list[str] = []
        self.tags = self.linked = self.regions = self.anchors = 0
        #: Whether each suspect is named for comments.
        self.comments: list[bool] = []

    @property
    def inner(self) -> Open:
        return self.open[-1] if self.open else Open()

    def close_page(self) -> None:
        super().close()
        self.flush()
        self.judge()

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            at = self.inner
            self.lines.append(Line(text, self.tags, self.linked, at.region, at.boilerplate, at.doubtful, at.suspects))
        self.parts, self.tags, self.linked = [], 0, 0

    def judge(self) -> None:
        """Lines of suspects that don't hold the page's text become boilerplate."""
        clear = [line for line in self.lines if not line.boilerplate]
        held, regions = [0] * len(self.comments), dict.fromkeys(range(1, self.regions + 1), 0)
        for line in clear:
            for suspect in line.suspects:
                held[suspect] += len(line.text)
            if line.region:
                regions[line.region] += len(line.text)
        most = max(regions, key=lambda r: (regions[r], -r), default=0)
        if most and regions[most]:
            cleared = {s for line in clear if line.region == most for s in line.suspects}
        else:
            whole = sum(len(line.text) for line in clear)
            cleared = {s for s, n in enumerate(held) if 2 * n > whole}
        guilty = {s for s in range(len(held)) if self.comments[s] or s not in cleared}
        for line in clear:
            line.boilerplate = not guilty.isdisjoint(line.suspects)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        above = self.inner
        if above.silent:
            if tag not in VOID:
                self.open.append(replace(above, tag=tag))
            return
        if tag in BLOCKS:
            self.flush()
            own = SHORT_LIVED.get(tag)
            if tag != "p":
                self.leave("p", stop=NESTS)
            if own:
                for name in own:
                    self.leave(name, stop=NESTS - own)
            above = self.inner
        hidden = self.hidden(attrs)
        silent = tag in SILENT or (hidden and tag not in BLOCKS)
        if not silent:
            self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag == "a" and not silent:
            self.anchors += 1
        if tag in VOID:
            return
        boilerplate, doubtful, suspects = above.boilerplate, above.doubtful, above.suspects
        if not boilerplate:
            boilerplate = tag in SKIPPED or (tag == "header" and not above.region) or hidden
            if above.region:
                by_name = self.named(tag, attrs)
                boilerplate = boilerplate or by_name == "sure" or tag == "form"
                doubtful = doubtful or by_name == "doubtful"
            elif not boilerplate and (names := self.suspect(tag, attrs)):
                suspects = (*suspects, len(self.comments))
                self.comments.append(bool(COMMENTS.search(names)))
        region = above.region
        if tag in REGIONS and not boilerplate and not region:
            self.regions += 1
            region = self.regions
        self.open.append(Open(tag, boilerplate, region, silent, doubtful, suspects))

    @staticmethod
    def hidden(attrs: list) -> bool:
        """Whether attributes keep an element from view, or from being read out as text."""
        for name, value in attrs:
            if name == "hidden" and (value or "").lower() != "until-found":
                return True
            if name == "style" and UNSEEN.search(value or "") or name == "aria-hidden" and value == "true":
                return True
            if name == "role" and (value or "").lower() in ROLES:
                return True
        return False

    @staticmethod
    def named(tag: str, attrs: list) -> str:
        """Whether attributes inside a region name boilerplate: "sure", "doubtful" or not at all."""
        if tag in ("html", "body", *REGIONS):
            return ""
        found = ""
        for name, value in attrs:
            if value and (name == "class" or name == "id" and tag not in HEADINGS):
                kinds = {named_inside(slug) for slug in CAMEL.sub("-", value).split()}
                if "sure" in kinds:
                    return "sure"
                found = found or max(kinds, default="")
        return found

    @staticmethod
    def suspect(tag: str, attrs: list) -> str:
        """The names that make an element outside of regions suspect, or that it is a form."""
        if tag in ("html", "body", *REGIONS):
            return ""
        slugs = [slug for name, value in attrs if value and name in ("class", "id") for slug in CAMEL.sub("-", value).split()]
        return " ".join([slug for slug in slugs if named_outside(slug)] + ["form"] * (tag == "form"))

    def leave(self, tag: str, stop: frozenset = frozenset()) -> None:
        for place in range(len(self.open) - 1, -1, -1):
            if self.open[place].tag == tag:
                del self.open[place:]
                return
            if self.open[place].tag in stop:
                return

    def handle_endtag(self, tag: str) -> None:
        if self.inner.silent:
            # what a silent element holds closes nothing around it
            root = max((i for i, o in enumerate(self.open) if not o.silent), default=-1) + 1
            for place in range(len(self.open) - 1, root - 1, -1):
                if self.open[place].tag == tag:
                    del self.open[place:]
                    return
            if tag == "p" or tag not in BLOCKS:
                return
            del self.open[root:]
        if tag in BLOCKS:
            self.flush()
        if tag == "a":
            self.anchors = max(0, self.anchors - 1)
        if tag == "br":
            self.parts.append(" ")
        self.tags += 1
        # a stray end tag must not close an element around the block it stands in
        self.leave(tag, stop=frozenset() if tag in BLOCKS else BLOCKS)

    def handle_data(self, data: str) -> None:
        if self.inner.silent:
            return
        self.parts.append(data)
        if self.anchors:
            self.linked += len(data.strip())


def smoothed(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian mean along the page; weights beyond its ends are left out."""
    reach = max(1, math.ceil(3 * sigma))
    weights = [math.exp(-0.5 * (d / sigma) ** 2) for d in range(reach + 1)]
    out = []
    for i in range(len(values)):
        total = norm = 0.0
        for j in range(max(0, i - reach), min(len(values), i + reach + 1)):
            total += weights[abs(i - j)] * values[j]
            norm += weights[abs(i - j)]
        out.append(total / norm)
    return out


def threshold(values: list[float]) -> float:
    """Between the means of two clusters of the values' logarithms.

    Clusters whose means don't differ by a factor of two are one: all values pass.
    """
    logs = [math.log1p(v) for v in values]
    low, high = min(logs), max(logs)
    for _ in range(20):
        middle = (low + high) / 2
        left, right = [x for x in logs if x <= middle], [x for x in logs if x > middle]
        if not left or not right:
            break
        low, high = sum(left) / len(left), sum(right) / len(right)
    if math.expm1(high) < 2 * math.expm1(low):
        return min(values)
    return math.expm1((low + high) / 2)


def main_text(html: str | None) -> str:
    parser = Lines()
    parser.feed(html or "")
    parser.close_page()
    lines = parser.lines
    clear = [i for i, line in enumerate(lines) if not line.boilerplate]
    if not clear:
        return ""
    # elements by number; a run of lines outside of them has the place of its first line, below zero
    regions: dict[int, list[int]] = {}
    run = last = 0
    for i in clear:
        if not lines[i].region and (last or not run):
            run = -1 - i
        last = lines[i].region
        regions.setdefault(last or run, []).append(i)
    ratios: dict[int, float] = {}
    for members in regions.values():
        ratios |= zip(members, smoothed([lines[i].ratio for i in members]), strict=True)
    least = threshold([ratios[i] for i in clear])
    chosen: list[int] = []
    for region, members in regions.items():
        content = [i for i in members if ratios[i] >= least and (not lines[i].doubtful or lines[i].free)]
        if content:
            kept = set(content)
            members = [i for i in members if not lines[i].doubtful or i in kept]
            chosen += members if region > 0 else [i for i in members if content[0] <= i <= content[-1]]
    return "\n".join(lines[i].text for i in sorted(chosen))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for every row of ``pages``."""
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    page_id, url = (rows.schema[c].dataType.simpleString() for c in ("page_id", "url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in range(0, batch.num_rows, 512):
                few = batch.slice(cut, 512)
                texts = [main_text(html) for html in few.column(2).to_pylist()]
                columns = [*few.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {page_id}, url {url}, text string, n_chars long")
