"""What class and id names and the threshold decide within an article."""

from __future__ import annotations

import math
from html.parser import HTMLParser

import pytest
from test_html_text import LONG

from tallywing.llm.html_text import Page, _densities, main_text

SECTION = f"<p>{LONG}</p>" * 3
TEXT = "\n".join([LONG] * 3)
HINTS = {
    "anchors of sections and headings": (
        f"<article><h1>T</h1><h2 id='related-work'>Related work</h2><p>{LONG}</p><h2 id='notice-period'>Notice</h2><p>{LONG}</p>"
        f"<h2 id=menu-design>Menu</h2><section id='discussion'><p>{LONG}</p></section></article>",
        f"T\nRelated work\n{LONG}\nNotice\n{LONG}\nMenu\n{LONG}",
    ),
    "modifiers": (f"<body><div class='content has-sidebar'><h1>T</h1>{SECTION}</div></body>", f"T\n{TEXT}"),
    "negation": (f"<body><div class='entry no-sidebar'>{SECTION}</div></body>", TEXT),
    "the only text": (f"<body><div class='sidebar-layout'>{SECTION}</div></body>", TEXT),
    "much text": (
        f"<body><nav><a>n</a></nav><div>{SECTION * 3}<div class='discussion'>{SECTION * 4}</div></div><div class=sidebar><a>x</a> y</div></body>",
        "\n".join([LONG] * 21),
    ),
}


@pytest.mark.parametrize("case", HINTS)
def test_hints_only_lower(case):
    source, want = HINTS[case]
    assert main_text(source) == want


LINKS = "<div><ul>" + "".join(f"<li><a href='/{i}'>Another story {i}</a></li>" for i in range(12)) + "</ul></div>"
TEASERS = "<div>" + "".join(f"<div><h3><a href='/{i}'>Teaser headline {i}</a></h3><p>By X</p></div>" for i in range(5)) + "</div>"
BOUNDS = {
    "link and teaser blocks": (f"<main><h1>T</h1><div>{SECTION * 2}</div>{LINKS}{TEASERS}</main>", f"T\n{TEXT}\n{TEXT}"),
    "short sections, linked headline, byline": (
        f"<article><header><h1><a href=/>T</a></h1><a href=/w>Writer</a></header><section>{SECTION * 2}</section>"
        f"<section><h2>N</h2><p>Short.</p></section><p>See <a href=/x>this</a> as well.</p>{LINKS}</article>",
        f"T\n{TEXT}\n{TEXT}\nN\nShort.\nSee this as well.",
    ),
    "lines of the article itself": (
        f"<article>First <b>words</b> of <a href=/x>it</a> stand here.<div>{SECTION * 2}</div>{LINKS}Last words.</article>",
        f"First words of it stand here.\n{TEXT}\n{TEXT}\nLast words.",
    ),
}


@pytest.mark.parametrize("case", BOUNDS)
def test_threshold_within_the_article(case):
    source, want = BOUNDS[case]
    assert main_text(source) == want


def test_form_around_the_page():
    source = f"<body><form><nav><a href=/>n</a></nav><article><h1>T</h1>{SECTION}<form><p>Your mail</p></form></article></form></body>"
    assert main_text(source) == f"T\n{TEXT}"


NAV = "<nav><a href=/>Home</a> <a href=/n>News</a></nav>"
LIST = "<ul>" + "".join(f"<li><a href='/{i}'>Another story {i}</a></li>" for i in range(8)) + "</ul>"
LAST = "This closing paragraph stands in a block of its own, behind all the others."
NO_ARTICLE = {
    "a form around everything": (f"<body><form>{NAV}<div><h1>T</h1>{SECTION}</div><input name=q></form></body>", f"T\n{TEXT}"),
    "two blocks of prose": (f"<body>{NAV}<div>{SECTION * 2}</div><div>{SECTION}</div></body>", "\n".join([LONG] * 9)),
    "two blocks of prose, no links": (f"<body><div>{SECTION * 2}</div><div>{SECTION}</div></body>", "\n".join([LONG] * 9)),
    "a closing paragraph": (f"<body>{NAV}<div>{SECTION * 2}</div><div><p>{LAST}</p></div></body>", "\n".join([LONG] * 6 + [LAST])),
    "headings of what stays": (
        f"<body>{NAV}<div>{SECTION * 2}</div><h2>More</h2><div>{SECTION}</div><h3>Related</h3>{LIST}</body>",
        "\n".join([LONG] * 6 + ["More"] + [LONG] * 3),
    ),
    "headline in a page header": (f"<body><header><div>Site</div><h1>T</h1>{NAV}</header><div>{SECTION}</div></body>", f"T\n{TEXT}"),
    "site name in a header": (f"<body><header><h1><a href=/>Site</a></h1></header><div>{SECTION}</div></body>", TEXT),
    "a form only": (f"<body><div>{SECTION}</div><form><p>Your mail</p><p>Your name</p></form></body>", TEXT),
    "two articles": (
        f"<body>{NAV}<article><h1>A</h1>{SECTION}</article><article><h2>B</h2>{SECTION}<p>Short.</p></article><footer>F</footer></body>",
        f"A\n{TEXT}\nB\n{TEXT}\nShort.",
    ),
    "an article and its comments": (f"<body><article><h1>A</h1>{SECTION}</article><article class=comment>{SECTION}</article></body>", f"A\n{TEXT}"),
}


@pytest.mark.parametrize("case", NO_ARTICLE)
def test_pages_without_one_article(case):
    source, want = NO_ARTICLE[case]
    assert main_text(source) == want


class Nested(HTMLParser):
    """Elements as nested lists [name, children, texts], for pages whose tags are all closed."""

    def __init__(self, source):
        super().__init__()
        self.stack, self.all = [["#page", [], []]], []
        self.feed(source)

    def handle_starttag(self, tag, attrs):
        node = [tag, [], []]
        self.all.append(node)
        self.stack[-1][1].append(node)
        self.stack.append(node)

    def handle_endtag(self, tag):
        self.stack.pop()

    def handle_data(self, data):
        self.stack[-1][2].append(" ".join(data.split()))


def test_densities_against_recursion():
    """The formula of the paper, worked out anew for every element by walking its whole subtree."""
    for inner in (f"{LINKS}{TEASERS}<div>{SECTION}</div>", SECTION, f"<div><a href='/'>{LONG}</a> and <b>more</b></div>{LIST}", "<p>x</p>"):
        source = f"<html><body>{inner}</body></html>"
        nested = Nested(source)

        def size(node, in_link=False, only=False):
            in_link = in_link or node[0] == "a"
            own = sum(map(len, node[2])) if in_link or not only else 0
            return own + sum(size(c, in_link, only) for c in node[1])

        def tags(node, name=None):
            return sum(tags(c, name) + (name in (None, c[0])) for c in node[1])

        body = nested.all[1]

        def density(node, in_link):
            c = size(node)
            if not c:
                return 0.0
            linked = size(node, in_link, True)
            t, lc, lt = max(1, tags(node)), max(1, linked), max(1, tags(node, "a"))
            base = math.log(c / max(1, c - linked) * lc + size(body, False, True) / max(1, size(body)) * c + math.e)
            return c / t * math.log(c / lc * t / lt) / math.log(base)

        page = Page(source)
        n = len(page.names)
        got, sums, *_ = _densities(page, [False] * n, [False] * n)
        within, want = {}, {}
        for node in nested.all:
            for child in node[1]:
                within[id(child)] = within.get(id(node), False) or node[0] == "a"
        for node in nested.all:
            want[id(node)] = density(node, within.get(id(node), False))
        assert got[1:] == pytest.approx([want[id(x)] for x in nested.all])
        assert sums[1:] == pytest.approx([sum(want[id(c)] for c in x[1]) for x in nested.all])
