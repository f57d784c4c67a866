"""HTML main-text extraction by the distribution of line blocks.

Markup is stripped into lines, one for each block of the page, in order. A line weighs what
it has of text outside links; lines of menus, page headers and footers, sidebars, notices,
adverts, forms and reader comments are left out first, and a line inside an article element
weighs more. An element that holds most of the page's text is a layout whatever its name, unless
it is a list of comments or the like. Weights are summed over a sliding window of lines; where
the sum surges first the text begins, where it dives to nothing for the last time the text ends,
but for lines of text beyond in the same element, and every line between is kept.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lipika.llm._common import small_batches, table

#: Lines of a window, and the sum at which the text surges.
WINDOW, SURGE = 3, 80
#: What a line inside an article element weighs besides its text.
ARTICLE = SURGE

_RAW = re.compile(r"<(script|style|textarea|title)(?=[\s/>])[^>]*+(?<!/)>", re.I)
_COMMENT = re.compile(r"<!--(?:-?>|.*?--!?>|.*+)", re.S)
_QUOTED = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>")
_SIMPLE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
#: Skipped with what is in them, where they are closed; an unclosed one is only a tag.
_SKIPPED = frozenset("noscript template svg math iframe object canvas select audio video".split())
_FOREIGN = frozenset(("svg", "math"))
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_LOOSE = frozenset("p li dt dd td th tr thead tbody tfoot colgroup option optgroup".split())
_DROPPED = frozenset("nav footer aside form button dialog menu fieldset".split())
_MAIN = frozenset(("article", "main"))
#: What an id names in an article is boilerplate only on these; elsewhere ids are places to link to.
_BOXES = frozenset(("div", "ol", "ul", "table"))
_NAMES = re.compile(
    r"(?<![a-z0-9])(?:ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:ed|s)?|promos?|promotions?|banners?|menus?|nav|navs|navbar|navigation|breadcrumbs?|sidebars?|aside|footers?|header|masthead|topbar|toolbar"
    r"|cookies?|consent|gdpr|notices?|alerts?|popups?|modals?|overlays?|newsletters?|subscribe|subscription|signup|login|forms?|search|comments?|commentlist|disqus|respond|replies|reply|shar(?:e|ing)|social|related|recommended|widgets?|pagination|pager|copyright|legal)(?![a-z0-9])"
)
#: Classes of a page's own headings, though they name a header, and of what holds an article without being one.
_HEADING = re.compile(r"(?:(?:post|entry|article|story|single|headline)-)+(?:header|heading|head|title|masthead)")
_ENTRY = re.compile(r"(?:(?:post|entry|article|story|blog)-)*(?:h?entry|post|article|story)(?:-(?:content|body|text|inner|full|single))*")
_OWN = re.compile(r"(?<![a-z0-9])(?:article|entry|post|content|story|main|body)(?![a-z0-9])")
#: A whole class that names boilerplate, also where it stands on an article element or in one.
_PARTS = re.compile(
    r"(?:(?:post|entry|article|page|inline|js)-)?(?:ads?|adverts?|advertisements?|advertising|adsense|adsbygoogle|sponsor(?:ed|s)?|promos?|promotions?|banners?|menus?|navs?|navbar|navigation|breadcrumbs?|sidebars?|aside|footers?|toolbar|cookies?|consent|gdpr|popups?|modals?|overlays?"
    r"|newsletters?|subscribe|subscription|signup|login|search|searchform|comments?|commentlist|disqus|respond|replies|reply|shar(?:e|ing)|sharedaddy|social|related|relatedposts|recommended|widgets?|pagination|pager|copyright)"
    r"(?:-(?:lists?|areas?|body|content|forms?|box|buttons?|links?|icons?|bar|block|container|wrapper|wrap|section|items?|posts?|articles?|stories|slot|unit|label|widget|inner|thread|respond|notice|banner|signup|menu|[0-9]+))*"
)
#: Names of an element around articles that are reader comments or point to other pages; not of a layout ("has-comments").
_OTHERS = re.compile(r"(?<![a-z0-9])(?<!no-)(?<!has-)(?<!with-)(?:comments?|commentlist|disqus|respond|replies|related|recommended)(?![a-z0-9])(?!-(?:open|closed|enabled|disabled|on|off))")
#: Classes of article elements that only point to another page: no weight is added in them.
_TEASER = re.compile(r"(?:[a-z0-9]+-)*(?:teaser|card|preview|tile)s?(?:-[a-z0-9]+)*")
_ATTRIBUTE = re.compile(r"""(?<![^\s"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())


def _classes(attributes: str, keys: tuple[str, ...] = ("class",)) -> list[str]:
    return [c.replace("_", "-") for key, value in _ATTRIBUTE.findall(attributes) if key.lower() in keys for c in value.strip("\"'").lower().split()]


def _unwanted(name: str, attributes: str, inside: bool) -> int:
    """Whether an element is no part of an article: 0 no, 1 unless it holds an article element or most of the page, 2 in any case; ``inside``: it stands in one."""
    if name in _DROPPED or name == "header" and not inside:
        return 2 if name in ("nav", "footer", "aside") else 1
    if not attributes or name in ("html", "body", "main"):
        return 0
    if name == "article":
        return 2 if any(map(_PARTS.fullmatch, _classes(attributes, ("class", "id")))) else 0
    worst = 0
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id"):
            parts = value.replace("_", "-").split()
            value = "-".join(parts)
            if inside:  # a listed word within a name, as in related-work, says nothing there
                named = (key == "class" or name in _BOXES) and any(map(_PARTS.fullmatch, parts)) and not (_OWN.search(value) and re.search(r"banner|promo", value))
                worst = 2 if named else worst
            elif any(_NAMES.search(x) and not _HEADING.fullmatch(x) for x in parts):
                worst = max(worst, 2 if _OTHERS.search(value) or any(map(_PARTS.fullmatch, parts)) and not _OWN.search(value) else 1)
        elif key == "role" and value in _ROLES:
            worst = max(worst, 2 if value in ("navigation", "contentinfo", "complementary") else 1)
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            worst = max(worst, 1)
    return worst


class Tag(NamedTuple):
    """A piece of markup; of what is no element the name is empty."""

    start: int
    end: int
    name: str
    closing: bool
    attributes: str
    raw: bool  # an element with what is in it, of which no text is shown
    text: str  # character data


def markup(page: str) -> Iterator[Tag]:
    """The markup of a page in order, in one pass: what can't end before the page does is looked for once."""
    last, end_of_data, quotes, at = page.rfind(">"), page.rfind("]]>"), True, 0
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = _COMMENT.match(page, at).end()
            yield Tag(at, end, "", False, "", False, "")
        elif at > last:
            return  # no tag ends any more; only a comment could follow
        elif page.startswith("<![CDATA[", at) and at < end_of_data:
            end = page.index("]]>", at) + 3
            yield Tag(at, end, "", False, "", False, page[at + 9 : end - 3])
        elif m := _RAW.match(page, at):
            close = _ENDS[m[1].lower()].search(page, m.end())
            end = close.end() if close else len(page)
            yield Tag(at, end, m[1].lower(), False, "", True, "")
        elif m := (quotes and _QUOTED.match(page, at)) or _SIMPLE.match(page, at):
            quotes = quotes and m.re is _QUOTED  # a quote is never closed: quotes are no guide from here on
            end = m.end()
            yield Tag(at, end, m[2].lower(), bool(m[1]), m[3], False, "")
        elif page[at + 1 : at + 2] in ("!", "?", "/") and at + 1 < last:
            end = page.index(">", at + 1) + 1
            yield Tag(at, end, "", False, "", False, "")
        else:
            end = at + 1
        at = end


_ENDS = {x: re.compile(rf"</{x}(?=[\s/>])[^>]*+>", re.I) for x in ("script", "style", "textarea", "title")}


class _Shape(NamedTuple):
    """Of the tags by number: elements with an end tag of their own, those that hold an article that isn't boilerplate, and those that hold most text."""

    closed: set[int]
    holding: set[int]
    most: set[int]


def _shape(page: str, tags: list[Tag], skipped: dict[int, int]) -> _Shape:
    shape = _Shape(set(), set(), set())
    stack: list[tuple[str, int, int]] = []
    count: Counter[str] = Counter()
    sizes: dict[int, int] = {}
    size, at, skip, link = 0, 0, -1, False

    def pop() -> tuple[str, int]:
        name, k, before = stack.pop()
        count[name] -= 1
        sizes[k] = size - before
        return name, k

    for i, m in enumerate(tags):
        if i > skip and not link:
            size += len(page[at : m.start].strip())
        at = m.end
        name = m.name
        if i <= skip or not name or m.raw:
            continue
        if name in _SKIPPED:
            skip = skipped.get(i, skip)
            continue
        if name == "a":
            link = not m.closing
        if name in _INLINE or name in _VOID or m.attributes.endswith("/"):
            continue
        link = False
        if not m.closing:
            if name in _LOOSE and stack and stack[-1][0] == name:
                pop()
            if name == "main" or name == "article" and not _unwanted(name, m.attributes, False):
                for _, k, _ in reversed(stack):
                    if k in shape.holding:
                        break
                    shape.holding.add(k)
            stack.append((name, i, size))
            count[name] += 1
        elif count[name] and (name not in _LOOSE or stack[-1][0] == name):
            while True:
                top, k = pop()
                if top == name:
                    shape.closed.add(k)
                    break
    size += len(page[at:].strip())
    while stack:
        pop()
    shape.most.update(k for k, n in sizes.items() if 2 * n > size)
    return shape


def _skipped(tags: list[Tag]) -> dict[int, int]:
    """Where each skipped element begins and ends among ``tags``; nested ones are matched, unclosed ones left out."""
    open_: dict[str, list[int]] = {}
    ends: dict[int, int] = {}
    for i, m in enumerate(tags):
        if m.name not in _SKIPPED or m.raw:
            continue
        if m.closing:
            if open_.get(m.name):
                ends[open_[m.name].pop()] = i
        elif not (m.name in _FOREIGN and m.attributes.endswith("/")):
            open_.setdefault(m.name, []).append(i)
    return ends


class Line(NamedTuple):
    text: str
    linked: int  # characters in links
    inside: bool  # an article element
    unwanted: bool
    parent: int  # number of the element it stands in, -1 for none but the body


class _Element:
    __slots__ = ("adds", "bad", "closed", "name", "number", "strict")

    def __init__(self, name: str, number: int, bad: bool, strict: bool, adds: bool, closed: bool) -> None:
        self.name, self.number, self.bad, self.strict, self.adds, self.closed = name, number, bad, strict, adds, closed


def lines(page: str) -> list[Line]:
    """The page's lines in order."""
    out: list[Line] = []
    parts: list[str] = []
    stack: list[_Element] = []
    count: Counter[str] = Counter()
    bads: list[_Element] = []  # open elements that begin what is unwanted
    strict = more = link = linked = n_closed = 0  # n_closed: of bads, those with an end tag

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Line(text, linked, more > 0, bool(bads), stack[-1].number if stack and stack[-1].name not in ("html", "body") else -1))
            parts.clear()
        linked = 0

    def text(raw: str) -> None:
        nonlocal linked
        if raw:
            t = html.unescape(raw)
            parts.append(t)
            if link:
                linked += len(t)

    def push(e: _Element) -> None:
        nonlocal strict, more, n_closed
        stack.append(e)
        count[e.name] += 1
        strict, more = strict + e.strict, more + e.adds
        if e.bad:
            bads.append(e)
            n_closed += e.closed

    def pop() -> str:
        nonlocal strict, more, n_closed
        e = stack.pop()
        count[e.name] -= 1
        strict, more = strict - e.strict, more - e.adds
        if e.bad:
            bads.pop()
            n_closed -= e.closed
        return e.name

    tags = list(markup(page))
    skipped = _skipped(tags)
    shape = _shape(page, tags, skipped)
    at, skip = 0, -1
    for i, m in enumerate(tags):
        if i <= skip:
            at = m.end
            continue
        text(page[at : m.start])
        at = m.end
        if not m.name:
            if m.text:
                parts.append(m.text)
            continue
        name, closing = m.name, m.closing
        if m.raw:
            flush()
            continue
        if name in _SKIPPED:
            flush()
            skip = skipped.get(i, skip)
            continue
        if name == "a":
            link = 0 if closing else 1
        if name in _INLINE:
            if not closing and name not in _VOID and _unwanted(name, m.attributes, strict > 0):
                flush()
                push(_Element(name, i, True, False, False, True))
            elif closing and stack and stack[-1].name == name:
                flush()
                pop()
            continue
        flush()
        link = 0
        if name in _VOID or m.attributes.endswith("/"):
            continue
        unwanted = not closing and _unwanted(name, m.attributes, strict > 0) > (i in shape.holding or i in shape.most)
        if name in _LOOSE and not unwanted and not (closing and count[name]):
            continue
        if closing:
            if count[name]:
                while pop() != name:
                    pass
            continue
        # an article in what was never closed doesn't belong to it; <main> belongs to nothing unwanted
        if bads and not unwanted and (name == "main" or name == "article" and not n_closed):
            for x in bads:
                x.bad = False
            bads.clear()
            n_closed = 0
        adds = name == "main" or name == "article" and not any(map(_TEASER.fullmatch, _classes(m.attributes)))
        push(_Element(name, i, unwanted, name in _MAIN or name in _BOXES and any(map(_ENTRY.fullmatch, _classes(m.attributes))), adds, i in shape.closed or name in _LOOSE))
    text(page[at:])
    flush()
    return out


def main_text(page: str | None) -> str:
    """The article of a page; null and empty pages, and pages without text, have none."""
    found = [x for x in lines(page or "") if not x.unwanted]
    weights = [max(0, len(x.text) - 2 * x.linked) + ARTICLE * x.inside for x in found]
    # surge: a window that starts with a line of weight reaches the sum; where only short lines are, each of weight is one
    surges = [k for k, w in enumerate(weights) if w and sum(weights[k : k + WINDOW]) >= SURGE] or [k for k, w in enumerate(weights) if w]
    if not surges:
        return ""
    end = surges[-1]
    while any(weights[end : end + WINDOW]):  # dive: no weight in a whole window
        end += 1
    # lines of text beyond, in an element that holds what has surged, belong to it
    parents = {found[k].parent for k in surges} - {-1}
    end = max([end, *(k + 1 for k in range(end, len(found)) if weights[k] and found[k].parent in parents)])
    return " ".join(x.text for x in found[surges[0] : end])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x) for x in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
        )


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``, one for one.

    Null or empty html, and pages without main text, give an empty text with 0 characters;
    null and repeated ids and urls are passed through; other columns are not read. The whole
    html is used, in time linear in its length.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op4_html_text": op4_html_text}
ORACLES: dict[str, str] = {}
