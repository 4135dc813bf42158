"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, one for each block element. A line weighs the characters of its
text outside links. The weights are summed over sliding windows of ``WINDOW`` lines: where a
sum rises over the surge level the text starts, where it falls to nothing it ends, and all
lines between are kept, those of weight 0 too, but for what is loose at the two ends. That is,
outside of an article: lines of copyright or that count comments, and short lines without a
sentence's end, if they stand in a list of several items before the text, or in containers that
hold no line as long as the level. The level is ``SURGE``, or a share of the page's own largest
sum if that is lower, so that short texts are found too. If the page marks its article, each
line inside weighs ``BONUS`` more: a third of the surge level, so that the tag helps and the
sums decide, inside and outside of it.

Elements that are never main text (scripts, menus, forms, and boxes named as adverts, notices
or comments) are left out. The outermost articles, and what lies on both sides of a box, are
set off by a gap, so that windows don't reach across; parts of one container or article, with
a box between them, are not.

Defined results: null, empty and tag-less pages give their text without markup (empty if
none); comments and elements without text that are never closed end with the page. Quotes
count after an equals sign only. If the page ends inside a tag, then from that tag on quotes
mean nothing, and a ``<`` without a ``>`` before the next ``<`` is text. Only an ``<a>`` with
``href`` is a link; it ends with the element that holds it, at the next ``<a>``, and if that
comes before any ``</a>``, at the next block. Every page is read in time linear in its
length. Repeated rows are treated alike; an empty table gives an empty table. Extra columns
are passed through.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 3
SURGE = 86
#: The surge level as a share of the page's largest sum, if that is lower.
SHARE = 0.25
#: What a line inside <article> or <main> weighs more.
BONUS = SURGE // WINDOW

#: HTML's elements whose content is not text, its block elements and containers.
_RAW = "script style noscript template svg math iframe object canvas audio video textarea select datalist title".split()
_NEVER = set("nav aside footer form menu dialog button fieldset head".split())
_BLOCKS = set(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Containers by which the parts of a page are told apart, and elements whose end tag may be missing: what ends them, and where the search stops.
_HOMES = set("article aside blockquote body center details dialog div fieldset figure footer form header main menu nav section td th".split())
_ENDED_BY = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "td": ("td th", "table tr"), "th": ("td th", "table tr"), "tr": ("tr", "table")}
_ENDED_BY = {k: tuple(frozenset(x.split()) for x in v) for k, v in _ENDED_BY.items()}
_TABLE = set("table tbody td tfoot th thead tr".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Words in a class, id or role that name a box beside the article.
_BESIDE = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar side menu nav "
    "navigation navbar breadcrumb breadcrumbs footer header masthead topbar toolbar cookie cookies consent gdpr notice "
    "alert popup modal overlay newsletter subscribe subscription signup login comment comments commentlist disqus replies "
    "responses share sharing social related recommended widget pagination pager search form complementary contentinfo".split()
)
#: First parts of names of boxes that end in a word of ``_BESIDE``; only a site's header is a box.
_SITE = set("bottom desktop global main mobile primary secondary site top".split())
_PLACES = _SITE | set("article entry google left page post right social story user".split())
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: Lines that are no text at either end of it, and how a sentence ends.
_NOTICE = re.compile(r"(?:©|\(c\)|copyright\b|all rights reserved)|\d+ (?:comments?|replies|reply|responses?)$", re.I)
_SENTENCE = re.compile(r"[.!?:;…。！？][\"'”’»)\]]*$")
_TAG = re.compile(r"""<(?:(/?)([a-z][a-z0-9:-]*+)((?:[^=>]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)|[!?][^>]*+)>""", re.I)
_PLAIN_TAG = re.compile(r"<(?:(/?)([a-z][a-z0-9:-]*+)([^<>]*+)|[!?][^<>]*+)>", re.I)
_OPENS = re.compile(r"<(?:/?[a-z]|[!?])", re.I)
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^<>]*+>", re.I) for name in _RAW}
_HREF = re.compile(r"(?<![\w-])href\s*=", re.I)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)


def _words(attributes: str) -> Iterator[str]:
    for value in _NAMES.findall(attributes):
        yield from value.strip("\"'").lower().split()


def _beside(attributes: str) -> bool:
    """A name is a box's as a whole, by its first part, or by its second after a word of place (site-footer)."""
    for name in _words(attributes):
        parts = re.split(r"[-_]+", name)[:2]
        if name in _BESIDE or parts[0] in _BESIDE:
            return True
        if len(parts) == 2 and parts[0] in _PLACES and parts[1] in _BESIDE and (parts[0] in _SITE or parts[1] != "header"):
            return True
    return False


def _titled(attributes: str) -> bool:
    """A header that is named as that of a text."""
    return any(re.match(r"(?:article|content|entry|page|post|story)[-_]+(?:header|head|title|heading)\b", name) for name in _words(attributes))


def tokens(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, whether it closes, attributes) of each piece of markup; comments and elements without text have no name."""
    pattern = _TAG
    at = page.find("<")
    while at >= 0:
        end = at + 1
        if page.startswith("<!--", at):
            close = page.find("-->", at + 4)
            end = len(page) if close < 0 else close + 3
            yield at, end, "", False, ""
        elif found := pattern.match(page, at):
            end = found.end()
            name, closes, attributes = (found[2] or "").lower(), found[1] == "/", found[3] or ""
            if name in _RAW_ENDS and not closes and not attributes.endswith("/"):
                close = _RAW_ENDS[name].search(page, end)
                name, end = "", close.end() if close else len(page)
            yield at, end, name, closes, attributes
        elif pattern is _TAG and _OPENS.match(page, at):
            pattern, end = _PLAIN_TAG, at
        at = page.find("<", end)


class Lines:
    """The lines of a page: text, its characters in links, the article, container and box that hold it, heading or list item.

    ``open`` are the open elements, each with its name, article and container; end tags that
    HTML lets a page leave out are added. ``held`` are the open boxes: number, place in ``open``
    and name.
    """

    def __init__(self, page: str):
        self.found: list[tuple[str, int, int, int, int, str]] = []
        self.text: list[str] = []
        #: ``link``: how many elements are open around the open link.
        self.linked = self.link = self.made = 0
        self.loose = False
        self.open: list[tuple[str, int, int]] = [("", 0, 0)]
        self.names: Counter[str] = Counter()
        #: Box: its parent box, and whether it may turn out to hold the main text.
        self.boxes: list[tuple[int, bool]] = []
        self.held: list[tuple[int, int, str]] = []
        self.holders: Counter[str] = Counter()
        found = list(tokens(page))
        links = [i for i, token in enumerate(found) if token[2] == "a"]
        self.unclosed = {i for n, i in enumerate(links, 1) if n == len(links) or not found[links[n]][3]}
        at = 0
        for i, (start, end, name, closes, attributes) in enumerate(found):
            self.add(page[at:start])
            at = end
            if name == "a":
                self.anchor(not closes and bool(_HREF.search(attributes)), i in self.unclosed)
            if name:
                self.tag(name, closes, attributes)
        self.add(page[at:])
        self.end_line()

    def anchor(self, opens: bool, unclosed: bool) -> None:
        self.link, self.loose = (len(self.open), unclosed) if opens else (0, False)

    def kind(self) -> str:
        return "h" if any(self.names[h] for h in _HEADINGS) else "li" if self.names["li"] else ""

    def box(self) -> int:
        return self.held[-1][0] if self.held else -1

    def add(self, raw: str) -> None:
        if raw:
            text = html.unescape(raw)
            self.text.append(text)
            if self.link:
                self.linked += len(text.strip())

    def end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.found.append((text, self.linked, *self.open[-1][1:], self.box(), self.kind()))
        self.text, self.linked = [], 0

    def pop(self, until: int) -> None:
        if self.held and self.held[-1][1] >= until:
            self.end_line()
        while self.held and self.held[-1][1] >= until:
            self.holders[self.held.pop()[2]] -= 1
        for name, _, _ in self.open[until:]:
            self.names[name] -= 1
        del self.open[until:]
        if self.link > until:
            self.link = 0

    def close(self, names: frozenset[str] | set[str], stops: frozenset[str] | set[str]) -> None:
        """Closes the innermost open element of ``names``, and what is open inside it."""
        if any(self.names[name] for name in names):
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i][0] in names:
                    self.pop(i)
                    return
                if self.open[i][0] in stops:
                    return

    def tag(self, name: str, closes: bool, attributes: str) -> None:
        block = name in _BLOCKS
        if block:
            self.end_line()
            if self.loose:
                self.anchor(False, False)
        if closes:
            inline = not block and name not in _NEVER
            self.close({name}, _BLOCKS if inline else set() if name in _TABLE or name in ("body", "html") else {"table", "td", "th"})
            return
        if name in _VOID or attributes.endswith("/"):
            return
        if block and name != "html":
            self.close({"head"}, set())
            self.close({"p"}, _BLOCKS)
        if name in _ENDED_BY:
            self.close(*_ENDED_BY[name])
        if name in ("article", "main", "body"):
            self.landmark(name)
        _, article, home = self.open[-1]
        never = name in _NEVER or name == "header" and not article and not _titled(attributes)
        if never or name not in ("html", "body", "main") and _beside(attributes):
            self.end_line()
            self.held.append((len(self.boxes), len(self.open), name))
            self.boxes.append((self.held[-2][0] if len(self.held) > 1 else -1, name not in _NEVER and name != "header" or name in ("form", "fieldset")))
            self.holders[name] += 1
        elif not block and name not in self.names:
            # Other inline elements matter inside a box of their name only.
            return
        self.made += 1
        if name in ("article", "main") and not article:
            article = self.made
        self.open.append((name, article, self.made if name in _HOMES else home))
        self.names[name] += 1

    def landmark(self, name: str) -> None:
        """The page's text starts here: boxes that are still open end, unless they are articles or asides."""
        if self.held and not self.holders["article"] and not self.holders["main"] and (name == "body" or not self.holders["aside"]):
            self.held.clear()
            self.holders.clear()


def _rescued(lines: list[tuple[str, int, int, int, int, str]], boxes: list[tuple[int, bool]]) -> list[bool]:
    """For each box whether its lines stay: it holds most of the page's text, and no article beside it has any to speak of."""
    weights, marked = [0] * len(boxes), [0] * len(boxes)
    total = articles = 0
    for text, linked, article, _, box, _ in lines:
        weight = max(0, len(text) - linked)
        total += weight
        articles += weight if article else 0
        if box >= 0:
            weights[box] += weight
            marked[box] += weight if article else 0
    for box in range(len(boxes) - 1, -1, -1):
        parent = boxes[box][0]
        if parent >= 0:
            weights[parent] += weights[box]
            marked[parent] += marked[box]
    stays: list[bool] = []
    for (parent, may), weight, inside in zip(boxes, weights, marked, strict=True):
        stays.append(may and 2 * weight > total and articles - inside < SURGE and (parent < 0 or stays[parent]))
    return stays


def _trimmed(run: list[tuple[str, int, int, int, str]], before: str, level: float) -> list[str]:
    """Texts of a run of (text, weight, article, container, kind) without what is loose at its ends; ``before`` is the kind of the line before."""
    homes = {home for _, weight, _, home, _ in run if weight >= level}

    listed = "li" in (before, *(line[4] for line in run[1:2]))

    def loose(line: tuple[str, int, int, int, str], leads: bool) -> bool:
        text, weight, article, home, kind = line
        if article or weight >= level:
            return False
        if _NOTICE.match(text):
            return True
        apart = home not in homes and not (leads and kind == "h") or leads and listed and kind == "li"
        return apart and not _SENTENCE.search(text)

    start, end = 0, len(run)
    if homes:
        while loose(run[start], True):
            start += 1
        while loose(run[end - 1], False):
            end -= 1
    return [line[0] for line in run[start:end]]


def main_text(page: str) -> str:
    read = Lines(page)
    stays = _rescued(read.found, read.boxes)
    gap = ("", 0, 0, 0, "")
    lines: list[tuple[str, int, int, int, str]] = []
    last, boxed = None, False
    for text, linked, article, home, box, kind in read.found:
        if box >= 0 and not stays[box]:
            boxed = True
            continue
        if last and (article != last[0] or boxed and not article and home != last[1]):
            lines.extend([gap] * WINDOW)
        lines.append((text, max(0, len(text) - linked) + (BONUS if article else 0), article, home, kind))
        last, boxed = (article, home), False
    weights = [line[1] for line in lines]
    sums = [sum(weights[i : i + WINDOW]) for i in range(len(weights))]
    level = min(SURGE, SHARE * max(sums, default=0))
    kept: list[str] = []
    i = 0
    while i < len(lines):
        if sums[i] >= level and weights[i] > 0:
            end = i
            while end < len(lines) and sums[end] > 0:
                end += 1
            kept.extend(_trimmed([line for line in lines[i:end] if line[0]], lines[i - 1][4] if i else "", level))
            i = end
        else:
            i += 1
    return "\n".join(kept)


def extracted(pages: DataFrame) -> DataFrame:
    """``pages`` with ``html`` replaced by ``text``."""
    names = [c for c in pages.columns if c != "html"]
    fields = [f for f in pages.schema.fields if f.name != "html"]
    schema = T.StructType([*fields, T.StructField("text", T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page or "") for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(texts, pa.string())], names=[*names, "text"]
            )

    return pages.select(*names, "html").mapInArrow(work, schema)


def op3_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extracted(pages).withColumn("n_chars", F.length("text").cast("long"))
