"""HTML extraction by composite text density.

A page becomes a tree of elements. Parts that are no article by their element or role (navigation, forms, scripts, ...)
or that are hidden are left out, unless they hold the article. For every other element the composite text density is its
characters per tag, adjusted by those in links (Sun, Song and Liao, 2011). The densities of an element's children are
summed; the element with the greatest sum is the core of the article. The least density on the path from the core to the
body is the threshold: within the article element that holds the core (or the body, where the page has none), every part
that reaches it gives its subtree with the greatest sum.

A class or id that names something else (advert, sidebar, comments, ...) divides an element's sum by eight: it goes where
what is left is below the threshold, and stays otherwise. Headings, wrappers of the core, names such as ``has-sidebar``
and, within an article, the id of anything but a div or list (an anchor) are no hints.

Composite density grows with size where there are no links, so a short paragraph may have less than a page without links.
Within an article element, text without links, sentences with less text in links than outside, and headings stay
therefore beside the core whatever their density; the threshold decides about parts with links.

A page without article or main has the body for a bound: there, a part beside the core stays if it is prose (60 characters
or more, with none or little of it in links), and a heading if what follows it stays. The only h1 of such a page stays in a
page header, and a form around most of its paragraphs stays. Where several articles lie side by side, each that reaches the
threshold and is not named something else is treated like the one that holds the core. Of equal densities the first counts.

Block elements separate blocks; within a block, white space becomes one space; character references are decoded. Each
page is worked out by itself, in batches, whatever its length; nesting of any depth is handled without recursion. Null
and empty pages give an empty text, text without any element is one block, and repeated rows are extracted each.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tallywing.llm.textbytes import by_size

# Fixed values of the language: elements by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td"
    " tfoot th thead tr ul".split()
)
#: What a start tag closes: these elements, up to the nearest of those.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Elements that are no part of an article.
APART = frozenset("head nav footer aside form button select input dialog menu script style textarea title noscript iframe template svg canvas object audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr"
    " notice notices alert alerts popup modal overlay newsletter subscribe subscription signup login sidebar sidebars aside widget"
    " widgets menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments disqus reply replies"
    " respond discussion related recommended recommendations share sharing social pager pagination toolbar hidden skip".split()
)
#: Words before a hint that make it say something about the rest of the page.
MODIFIERS = frozenset("has have no not non with without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINER = frozenset(["article", "main"])
#: Characters of a part that is prose, and of the paragraphs that keep a form around them.
PROSE, FORM_PROSE = 60, 200
#: What a hint leaves of an element's density sum.
LOWERED = 1 / 8

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)""",
    re.DOTALL,
)
_MARKS = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s"'/]|$)""", re.IGNORECASE)
#: A slash at the end of a value without quotes is part of it.
_VALUE = re.compile(r"""=\s*[^\s"'=]*/$""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Page:
    """Elements in the order they begin: names, parents and pieces of text, whether they are apart, and what hints at it."""

    def __init__(self, source: str):
        self.names, self.parents, self.apart, self.hints = ["#page"], [0], [False], [""]
        self.pieces: list[tuple[int, str | None]] = []  # element, text; None for the edge of a block
        stack, open_ = [0], {"#page": 1}

        def close() -> None:
            name = self.names[stack.pop()]
            open_[name] -= 1
            if name in BLOCK:
                self.pieces.append((stack[-1], None))

        end = 0
        while True:
            m = _TAG.search(source, end)
            if m is None or m.start() > end:
                self.pieces.append((stack[-1], html.unescape(source[end : m.start() if m else len(source)])))
            if m is None:
                break
            end = m.end()
            closing, name, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not name:
                continue
            name = name.lower()
            if closing:
                if open_.get(name) and name != "#page":
                    while self.names[stack[-1]] != name:
                        close()
                    close()
                continue
            if name in BLOCK and name not in ("html", "body") and open_.get("p"):
                while open_["p"]:
                    close()
            if name in CLOSES:
                ends, within = CLOSES[name]
                for i in range(len(stack) - 1, 0, -1):
                    at = self.names[stack[i]]
                    if at in within:
                        break
                    if at in ends:
                        while len(stack) > i:
                            close()
                        break
            number = len(self.names)
            self.names.append(name)
            self.parents.append(stack[-1])
            self.apart.append(name in APART or _told_apart(name, rest))
            self.hints.append(_hint(name, rest))
            if name in BLOCK:
                self.pieces.append((stack[-1], None))
            if name == "br":
                self.pieces.append((stack[-1], " "))
            if name in VOID or rest.endswith("/") and not _VALUE.search(rest) and name not in BLOCK and name not in RAW:
                continue
            if name in RAW:
                stop = re.compile(f"</{re.escape(name)}(?=[\\s/>]|$)", re.IGNORECASE).search(source, end)
                at = stop.start() if stop else len(source)
                self.pieces.append((number, source[end:at]))
                gone = source.find(">", at)
                end = gone + 1 if gone >= 0 else len(source)
                continue
            stack.append(number)
            open_[name] = open_.get(name, 0) + 1


def _told_apart(name: str, attributes: str) -> bool:
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for m in _MARKS.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "role" and value.lower() in ROLES:
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return True
    return False


def _hint(name: str, attributes: str) -> str:
    """Which of class and id names something that is no article: "class" before "id", or ""."""
    if not attributes or name in ("html", "body", "main") or name in HEADINGS:
        return ""
    found = ""
    for m in _MARKS.finditer(attributes):
        key = m[1].lower()
        if key in ("class", "id"):
            for token in (m[2] or m[3] or m[4] or "").split():
                names = [w.lower() for w in _WORD.findall(token)]
                if any(w in HINTS and before not in MODIFIERS for before, w in zip(["", *names], names, strict=False)):
                    found = "class" if "class" in (found, key) else "id"
    return found


def _dropped(page: Page) -> tuple[list[bool], list[bool]]:
    """Elements that are apart or lie in one that is, and those that hint at it.

    One that holds an article stays, unless by its very name; a form around it stays too. Without any article, forms
    around most of the paragraphs stay, and of a header with the only h1 that h1.
    """
    n = len(page.names)
    without = not any(name in CONTAINER for name in page.names)
    around = _forms_around(page) if without else set()
    headline = _headline(page) if without else set()
    holds = [name in CONTAINER for name in page.names]
    for i in range(n - 1, 0, -1):
        if holds[i]:
            holds[page.parents[i]] = True
    out, in_article, hinted = [False] * n, [False] * n, [False] * n
    for i in range(1, n):
        parent = page.parents[i]
        in_article[i] = in_article[parent] or page.names[i] in CONTAINER
        apart = page.apart[i] and not (holds[i] and (page.names[i] == "form" or page.names[i] not in APART))
        if page.names[i] == "header":
            apart = not in_article[i] and not holds[i] and i not in headline  # the header of an article holds its headline
        elif parent in headline and page.names[parent] != "h1" and i not in headline:
            apart = True
        elif i in around:
            apart = False
        out[i] = out[parent] or apart
        anchor = page.hints[i] == "id" and in_article[i] and page.names[i] not in ("div", "ul", "ol")
        hinted[i] = bool(page.hints[i]) and not holds[i] and not anchor
    return out, hinted


def _forms_around(page: Page) -> set[int]:
    """Forms that hold most of the text in paragraphs."""
    n = len(page.names)
    other, in_p, size = [False] * n, [False] * n, [0] * n
    for i in range(1, n):
        other[i] = other[page.parents[i]] or page.apart[i] and page.names[i] != "form"
        in_p[i] = in_p[page.parents[i]] or page.names[i] == "p"
    for i, text in page.pieces:
        if text and in_p[i] and not other[i]:
            size[i] += len(" ".join(text.split()))
    for i in range(n - 1, 0, -1):
        size[page.parents[i]] += size[i]
    return {i for i in range(n) if page.names[i] == "form" and size[i] >= FORM_PROSE and 2 * size[i] > size[0]}


def _headline(page: Page) -> set[int]:
    """The only h1 of the page and what it lies in, up to a header; nothing if there is no such header."""
    found = [i for i, name in enumerate(page.names) if name == "h1"]
    if len(found) != 1:
        return set()
    path = [found[0]]
    while path[-1] and page.names[path[-1]] != "header":
        path.append(page.parents[path[-1]])
    return set(path) if path[-1] else set()


def _densities(page: Page, dropped: list[bool], hinted: list[bool]) -> tuple[list[float], list[float], list[int], list[int], int]:
    """Composite text density, its sum over children, characters and those in links of each element, and the body."""
    n = len(page.names)
    chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[page.parents[i]] or page.names[i] == "a"
    for i, text in page.pieces:
        if text and not dropped[i]:
            size = len(" ".join(text.split()))
            chars[i] += size
            links[i] += size if in_link[i] else 0
    for i in range(n - 1, 0, -1):
        if not dropped[i]:
            p = page.parents[i]
            chars[p] += chars[i]
            links[p] += links[i]
            tags[p] += tags[i] + 1
            link_tags[p] += link_tags[i] + (page.names[i] == "a")
    body = next((i for i in range(n) if page.names[i] == "body" and not dropped[i]), 0)
    all_chars, all_links = max(1, chars[body]), links[body]
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if dropped[i] or not chars[i]:
            continue
        c, t, lc, lt = chars[i], max(1, tags[i]), max(1, links[i]), max(1, link_tags[i])
        other = max(1, c - links[i])
        base = math.log(c / other * lc + all_links / all_chars * c + math.e)
        density[i] = c / t * math.log(c / lc * t / lt) / math.log(base)
        if i:
            total[page.parents[i]] += density[i] * (LOWERED if hinted[i] else 1)
    return density, total, chars, links, body


def _chosen(page: Page, dropped: list[bool], hinted: list[bool]) -> list[bool]:
    """The elements whose own text is of the article. What goes by its hint is marked in ``dropped``."""
    n = len(page.names)
    density, total, chars, links, body = _densities(page, dropped, hinted)
    inside = [False] * n
    inside[body] = True
    for i in range(body + 1, n):
        inside[i] = inside[page.parents[i]]
    # What is within a line goes with it; only blocks and what holds some are parts.
    divided = [False] * n
    for i in range(n - 1, 0, -1):
        if not dropped[i] and (page.names[i] in BLOCK or divided[i]):
            divided[page.parents[i]] = True
    block = [i == body or divided[i] or page.names[i] in BLOCK for i in range(n)]
    # An element without parts has no sum of such; its own density then counts.
    strength = [total[i] if total[i] and divided[i] else density[i] for i in range(n)]
    able = [i for i in range(n) if inside[i] and not dropped[i] and block[i]]
    under = list(hinted)
    for i in range(1, n):
        under[i] = under[i] or under[page.parents[i]]
    core = max(able, key=lambda i: (strength[i] * (LOWERED if under[i] else 1), -i))
    path = [core]
    while path[-1] != body:
        path.append(page.parents[path[-1]])
    threshold = min(density[i] for i in path)
    on_path = set(path)
    for i in range(1, n):
        weak = hinted[i] and i not in on_path and not strength[i] * LOWERED >= max(threshold, 1e-9)
        dropped[i] = dropped[i] or dropped[page.parents[i]] or weak
    able = [i for i in able if not dropped[i]]
    # The strongest element at or below each.
    best = list(range(n))
    for i in reversed(able):
        p = page.parents[i]
        if i != body and (strength[best[i]], -best[i]) > (strength[best[p]], -best[p]):
            best[p] = best[i]
    keep = [False] * n
    keep[core] = True
    article = next((i for i in reversed(path) if page.names[i] in CONTAINER), None)
    bounds = {body if article is None else article: core}
    if article is not None and page.names[article] == "article":
        parent = page.parents[article]
        for i in able:
            beside = page.names[i] == "article" and page.parents[i] == parent and i != article
            if beside and not page.hints[i] and not under[i] and density[i] >= threshold:
                bounds[i] = best[i]
    within = [False] * n
    for i in range(body, n):
        within[i] = i in bounds or i > body and within[page.parents[i]]
    for i in able:
        if within[i] and density[i] >= threshold:
            keep[best[i]] = True
    flows = []
    for bound, strongest in bounds.items():
        keep[strongest], way = True, [strongest]
        while way[-1] != bound:
            way.append(page.parents[way[-1]])
        flows += _beside(page, dropped, block, divided, density, chars, links, set(way), strongest, bound, threshold, keep, article is None)
    for i in range(body + 1, n):
        keep[i] = keep[i] or keep[page.parents[i]]
    for i in flows:
        keep[i] = True
    return keep


def _beside(page, dropped, block, divided, density, chars, links, on_path, core, bound, threshold, keep, prose_only) -> list[int]:
    """Marks in ``keep`` what stays beside the core in its bound; returns the elements of which only their lines stay.

    With ``prose_only`` (the bound is no article) that is prose, and headings of what stays.
    """
    n = len(page.names)
    # Lines: text of an element outside of its parts.
    line, line_links = list(chars), list(links)
    for i in range(n - 1, 0, -1):
        if block[i]:
            line[page.parents[i]] -= chars[i]
            line_links[page.parents[i]] -= links[i]
    lines = lambda i: line[i] > 2 * line_links[i]
    # Open elements are searched for parts: those around the core, those that reach the threshold, and headers.
    open_, flows, headings, last = [False] * n, [], [], {}
    for i in range(bound, n):
        p = page.parents[i]
        if prose_only and i > bound and open_[p] and block[i] and not dropped[i]:
            if page.names[last.get(p, 0)] in HEADINGS:
                headings.append((last[p], i))
            last[p] = i
        if i in on_path:
            open_[i] = i != core
        elif i == bound or not open_[p] or dropped[i] or keep[i]:
            continue
        elif not block[i]:
            keep[i] = lines(p) and (not prose_only or line[p] >= PROSE)
            continue
        elif prose_only:
            if page.names[i] in HEADINGS:
                keep[i] = page.names[i] == "h1" and lines(i)
            elif chars[i] >= PROSE and (not links[i] or not divided[i] and lines(i)):
                keep[i] = True
            else:
                open_[i] = density[i] >= threshold or page.names[i] in ("header", "hgroup", "form")
        elif not links[i] or page.names[i] in HEADINGS or not divided[i] and lines(i):
            keep[i] = True
        else:
            open_[i] = density[i] >= threshold or page.names[i] in ("header", "hgroup")
        if open_[i] and lines(i) and (not prose_only or line[i] >= PROSE):
            flows.append(i)
    for i, following in reversed(headings):
        keep[i] = keep[i] or keep[following] or following in on_path
    return flows


def main_text(source: str | None) -> str:
    """The article of a page: its blocks, one a line."""
    if not source:
        return ""
    page = Page(source)
    dropped, hinted = _dropped(page)
    keep = _chosen(page, dropped, hinted)
    blocks, now = [], []
    for i, text in page.pieces:
        if text is None:
            blocks.append("".join(now))
            now = []
        elif keep[i] and not dropped[i]:
            now.append(text)
    blocks.append("".join(now))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches, "html", most=4 << 20):
            texts = [main_text(x.as_py()) for x in b.column(2)]
            columns = [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
