"""Main text of web pages by the distribution of text over lines.

Markup is stripped into lines, one per block. The text lengths of a few neighbouring lines are summed; where the sums
rise from the floor (surge) the article begins, where they fall back to it (dive) it ends. Lines of declared
boilerplate, and link text, weigh nothing; lines that the page declares as its article weigh more than others. A
container that only a class word marks as boilerplate is opened where no declared article outweighs it and it holds
more text than all that is left of the page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

#: Lines of a window.
WINDOW = 3
#: Weight a window must exceed at a surge, and the part of the heaviest stretch that another one needs.
SURGE, PART = 80, 0.15
#: Weight of a character that the page declares as article; one of any other line weighs 1.
DECLARED = 4

RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
DROPPED = frozenset(
    "nav header footer aside form noscript template button select menu dialog svg object canvas audio video head".split()
)
BLOCKS = frozenset(
    "p div h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption section article main header "
    "footer nav aside blockquote pre figure figcaption form fieldset hr address body html head details summary".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words in class, id or role that mark a container as boilerplate.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "consent contentinfo cookie cookies copyright disclaimer disqus footer gdpr header legal login masthead menu modal "
    "nav navbar navigation newsletter notice notification pagination popup promo promotion related replies search "
    "share sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget widgets".split()
)
COMMENTS = frozenset("comment comments commentlist disqus replies".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][\w:-]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][\w:-]*+)([^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?i)\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_SPLIT = re.compile(r"[^a-z0-9]+")


@dataclass
class Line:
    parts: list[str] = field(default_factory=list)
    links: int = 0
    article: bool = False
    title: bool = False
    dropped: bool = False
    text: str = ""
    place: int = -1  # where a container begins that was dropped for a class word
    hidden: int = 0  # its text outside links


def _marks(attributes: str) -> set[str]:
    found = set()
    for m in _ATTRIBUTE.finditer(attributes):
        found.update(_SPLIT.split((m[1] or m[2] or m[3] or "").lower()))
    return found & MARKS


def lines(page: str, opened: frozenset[int] = frozenset()) -> list[Line]:
    """Lines of a page in order. A stretch of boilerplate is one empty line, whatever it holds.

    Containers that begin at the places `opened` are no boilerplate, whatever their class.
    """
    out, line = [], Line()
    at = depth = articles = link = 0
    dropping, reason = "", ""  # the tag whose end closes the boilerplate
    stop = page.rfind(">") + 1  # behind it nothing can be a tag, and no search for one needs to look

    def end_line():
        nonlocal line
        if line.parts:
            line.text = " ".join(html.unescape("".join(line.parts)).split())
            if line.text:
                out.append(line)
        line = Line(article=articles > 0)

    def add(text: str):
        if dropping:
            if not link:
                out[-1].hidden += len(text.strip())
        elif text:
            line.parts.append(text)
            if link:
                line.links += len(text.strip())

    while True:
        m = _TAG.search(page, at, stop)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if at == stop and m[0].startswith("<!--") and not m[0].endswith("-->"):
            break  # a comment that is never closed
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in RAW and not closing:
            close = re.compile(rf"(?i)</{name}\b[^>]*>").search(page, at, stop)
            at = close.end() if close else len(page)
            continue
        marks = set() if closing or not attributes or m.start() in opened else _marks(attributes)
        if dropping:
            if name == "a":
                link = 0 if closing else 1
            if name in ("article", "main") and not closing and not marks and reason != "comments" and not articles:
                dropping = ""  # boilerplate that was never closed ends where the article begins
            elif name == "body" and dropping == "head":
                dropping = ""
            else:
                if name == dropping and not attributes.endswith("/"):
                    depth += -1 if closing else 1
                    if depth == 0:
                        dropping = ""
                continue
        if not closing and name not in VOID and name not in ("html", "body"):
            own_header = name == "header" and articles and not marks - {"header"}
            if (name in DROPPED or marks) and not own_header and not attributes.endswith("/"):
                end_line()
                by_class = m.start() if name not in DROPPED and not marks & COMMENTS else -1
                out.append(Line(dropped=True, article=articles > 0, place=by_class))
                dropping, depth, link = name, 1, 0
                reason = "comments" if marks & COMMENTS else "other"
                continue
        if name == "br":
            add(" ")
        elif name in BLOCKS:
            end_line()
            if name in ("article", "main"):
                articles = max(0, articles + (-1 if closing else 1))
                line.article = articles > 0
            line.title = name == "h1" and not closing
        elif name == "a":
            link = 0 if closing else 1
    end_line()
    return out


def stretches(weights: list[int], floor: int) -> list[tuple[int, int]]:
    """(surge, dive) pairs: from a line whose window rises above `floor` to where the window falls to nothing."""
    sums = [sum(weights[i : i + WINDOW]) for i in range(len(weights))]
    out, i = [], 0
    while i < len(weights):
        if weights[i] and sums[i] > floor:
            j = i
            while j < len(weights) and sums[j]:
                j += 1
            out.append((i, j))
            i = j
        else:
            i += 1
    return out


def _weight(line: Line) -> int:
    if line.dropped:
        return 0
    if line.article and line.title:  # the title of an article is often a link to it
        return DECLARED * len(line.text)
    return max(0, len(line.text) - line.links) * (DECLARED if line.article else 1)


def _opened(page: str) -> list[Line]:
    """Lines of a page. The heaviest container that was dropped for a class word is opened, again and again, while it
    holds more than all lines that are left and these hold no declared article. Each time the text that is left at
    least doubles, so a page is read a logarithmic number of times."""
    opened: frozenset[int] = frozenset()
    while True:
        found = lines(page, opened)
        left = sum(map(_weight, found))
        heaviest = max((x for x in found if x.place >= 0), key=lambda x: x.hidden, default=None)
        declared = sum(_weight(x) for x in found if x.article)
        if heaviest is None or heaviest.hidden <= left or declared > SURGE:
            return found
        opened |= {heaviest.place}


def main_text(page: str | None) -> str:
    """The article of a page, blocks joined by a line end; empty if there is none.

    Surge and dive are sought among the declared lines and among the others apart, so that a short line beside the
    article does not hang on to it. A declared stretch begins with its first line, as a surge follows; it is kept
    whatever its part, and holds its few link lines.
    """
    found = _opened(page or "")
    inside = [_weight(x) if x.article else 0 for x in found]
    outside = [0 if x.article else _weight(x) for x in found]
    declared = [(s, e) for s, e in stretches(inside, 0) if any(sum(inside[i : i + WINDOW]) > SURGE for i in range(s, e))]
    other = stretches(outside, SURGE)
    if not declared and not other:
        declared = stretches(inside, 0)
        other = [] if declared else stretches(outside, 0)
    mass = {s: sum(outside[s[0] : s[1]]) for s in other}
    most = max([*mass.values(), *(sum(inside[s:e]) for s, e in declared)], default=0)
    kept = {i for s, e in declared for i in range(s, e) if found[i].article and not found[i].dropped}
    kept.update(i for s in other if mass[s] >= PART * most for i in range(*s) if outside[i])
    return "\n".join(found[i].text for i in sorted(kept) if found[i].text)


EXTRACTED = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points). Null html counts as empty; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            columns = [*batch.columns[:2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.record_batch(columns, names=["page_id", "url", "text", "n_chars"])

    return pages.selectExpr("cast(page_id as long) as page_id", "cast(url as string) as url", "html").mapInArrow(
        run, EXTRACTED
    )
