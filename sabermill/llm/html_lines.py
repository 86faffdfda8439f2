"""Text lines of an HTML page, each with what its place in the markup says about it."""

from __future__ import annotations

import html
import re
from collections import Counter

# Elements whose text is never content, elements that end a line, words that as a whole
# token of class, id or role (or as every word of one) name such parts, longer tokens that do, and
# elements with raw text.
EXCLUDED = frozenset("nav header footer aside form script style noscript template iframe svg button select textarea dialog menu object audio video canvas math".split())
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html"
    " legend li main menu nav ol option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
PARTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies disclaimer disqus"
    " footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices popup promo promoted promotion recommended related search share sharing"
    " sidebar signup social sponsor sponsored subscribe toolbar topbar widget".split()
)
TOKENS = frozenset(
    "ad-container ad-slot ad-unit ad-wrapper comment-form comment-list comments-area cookie-bar main-menu main-nav main-navigation nav-bar related-articles related-links related-posts search-box"
    " search-form share-buttons side-bar site-footer site-header site-nav site-navigation social-icons social-links".split()
)
RAW = frozenset("script style textarea title noscript template iframe".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CONTENT = ("article", "main")

_MARKUP = re.compile(r"<!--.*?(?:--!?>|\Z)|<[a-zA-Z/](?:[^<>\"']|\"[^\"]*\"|'[^']*')*>|<[!?][^>]*(?:>|\Z)", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
# Elements whose id may name a part; of others, and of a division that is a section, it names the topic.
_NAMED = frozenset("center div dl ol table td ul".split())
_SECTION = frozenset(("section", "chapter"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SPECIAL = BLOCKS | {"applet", "colgroup", "hgroup", "marquee", "object", "search"}
_SCOPE = frozenset("applet caption marquee object table td th".split())
_ROWS = frozenset("caption colgroup table tbody td tfoot th thead tr".split())
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li dd dt main menu nav ol p pre search section summary"
    " table ul".split()
)
_P, _P_STOPS = frozenset("p"), _SCOPE | {"button"}
_ITEM_STOPS = _SPECIAL - {"address", "div", "p"}
# For the start of an element: the open ones that it ends (with all in them), and what keeps those open.
_ENDS = {
    "li": (frozenset(("li",)), _ITEM_STOPS),
    **dict.fromkeys(("dd", "dt"), (frozenset(("dd", "dt")), _ITEM_STOPS)),
    **dict.fromkeys(("td", "th"), (frozenset(("td", "th")), None)),
    "tr": (frozenset("td th tr caption colgroup".split()), None),
    **dict.fromkeys("tbody thead tfoot caption colgroup".split(), (_ROWS - {"table"}, None)),
    "option": (frozenset(("option",)), _SPECIAL - {"option"}),
    "optgroup": (frozenset(("option", "optgroup")), _SPECIAL - {"option"}),
    **{n: (frozenset((n,)), _SCOPE) for n in ("button", "select")},
}

OPEN, ARTICLE, MAIN = 0, 1, 2


def _names_part(token: str) -> bool:
    token = token.replace("_", "-")
    return token in PARTS or token in TOKENS or ("-" in token and PARTS.issuperset(token.split("-")))


def _is_part(name: str, tag: str) -> bool:
    """Whether an opening tag's class, id, role or hiding says that the element isn't content."""
    given: dict[str, str] = {}
    for attribute, *values in _ATTRIBUTE.findall(tag, len(name) + 1, len(tag) - 1):
        given.setdefault(attribute.lower(), "".join(values).lower())
    if "hidden" in given or given.get("aria-hidden", "").strip() == "true":
        return True
    classes = given.get("class", "").split()
    if any(map(_names_part, classes)) or any(map(_names_part, given.get("role", "").split())):
        return True
    return name in _NAMED and _SECTION.isdisjoint(classes) and _names_part(given.get("id", "").strip())


class _Elements:
    """The open elements, each with its place in the page and whether it is an excluded part."""

    def __init__(self):
        self.stack: list[tuple[str, int, bool]] = []
        self.open: Counter[str] = Counter()
        self.parts = 0

    def push(self, name: str, at: int, part: bool) -> None:
        self.stack.append((name, at, part))
        self.open[name] += 1
        self.parts += part

    def end(self, at: int, stop: int | None = None) -> None:
        for name, _, part in self.stack[at:stop]:
            self.open[name] -= 1
            self.parts -= part
        del self.stack[at:stop]

    def find(self, names: frozenset[str], stops: frozenset[str], outermost: bool = False) -> int:
        """Place of the innermost (or outermost) element so named that lies inside all of ``stops``, or -1."""
        found = -1
        if any(self.open[n] for n in names):
            for i in range(len(self.stack) - 1, -1, -1):
                name = self.stack[i][0]
                if name in names:
                    found = i
                    if not outermost:
                        break
                elif name in stops:
                    break
        return found

    def start(self, name: str) -> None:
        """What a start tag ends: elements whose own end tag may be left out before it."""
        if name in _ENDS:
            names, stops = _ENDS[name]
            at = self.find(names, stops or (frozenset(("table",)) if self.open["table"] else frozenset(CONTENT)), outermost=True)
            if at >= 0:
                self.end(at)
        if name in _ENDS_P:
            at = self.find(_P, _P_STOPS)
            if at >= 0:
                self.end(at)
        if name in _HEADINGS and self.stack and self.stack[-1][0] in _HEADINGS:
            self.end(len(self.stack) - 1)

    def close(self, name: str) -> None:
        """What an end tag ends: the element and what is still open in it."""
        names = _HEADINGS if name in _HEADINGS else frozenset((name,))
        if name in CONTENT:
            stops = frozenset()
        elif name in _ROWS:
            stops = frozenset(("table",))
        elif name == "form" or name not in _SPECIAL:
            stops = frozenset() if name == "form" else _SCOPE
            at = self.find(names, stops)
            over = _SCOPE if name == "form" else _SPECIAL
            if at >= 0 and any(n in over for n, _, _ in self.stack[at + 1 :]):
                self.end(at, at + 1)  # badly nested: what is open in it stays open
                return
        else:
            stops = _SCOPE | {"ol", "ul"} if name == "li" else _SCOPE | {"button"} if name == "p" else _SCOPE
        at = self.find(names, stops)
        if at >= 0:
            self.end(at)


def _scan(page: str, spared: frozenset[int] = frozenset()) -> tuple[list[tuple[str, int]], list[tuple[tuple[int, int, int], frozenset[int]]]]:
    """Lines, and for each content element its rank and the excluded parts around it; those in ``spared`` aren't excluded."""
    out: list[tuple[str, int]] = []
    content: list[tuple[tuple[int, int, int], frozenset[int]]] = []
    parts: list[str] = []
    elements = _Elements()

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append((text, ARTICLE if elements.open["article"] else MAIN if elements.open["main"] else OPEN))

    at, end = 0, len(page)
    while at < end:
        found = _MARKUP.search(page, at)
        if not elements.parts:
            parts.append(page[at : found.start() if found else end])
        if not found:
            break
        tag, at = found.group(), found.end()
        match = _NAME.match(tag)
        if not match:
            continue  # a comment, a declaration
        name = match[1].lower()
        closing = tag[1] == "/"
        if not closing and name in RAW:
            close = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if name in BLOCKS:
            flush()
        if name in ("html", "head", "body"):
            continue
        if closing:
            elements.close(name)
            continue
        if name == "form" and elements.open["form"]:
            continue  # forms don't nest
        elements.start(name)
        if name in VOID or tag.endswith("/>"):
            continue
        part = name in EXCLUDED or (name != "main" and _is_part(name, tag))
        if name in CONTENT and not part:
            around = [(n, i) for n, i, is_part in elements.stack if is_part]
            forms = sum(n == "form" for n, _ in around)
            content.append(((len(around) - forms, CONTENT.index(name), forms), frozenset(i for _, i in around)))
        part = part and found.start() not in spared
        if part:
            flush()
        elements.push(name, found.start(), part)
    flush()
    return out, content


def lines_of(page: str | None) -> list[tuple[str, int]]:
    """Lines in page order, white space collapsed, none empty, with OPEN, ARTICLE or MAIN.

    Text in excluded elements is no line. An element whose end tag is left out reaches to the next
    tag that HTML says ends it, at the latest to the end of the element around it. If the page's article (failing that, its main part) lies inside
    excluded elements only, those around it aren't excluded: a form always, others unless more
    text lies outside of all of them, as beside teasers or comments that are marked as articles.
    """
    page = page or ""
    lines, content = _scan(page)
    best = min((rank for rank, _ in content), default=(0, 0, 0))
    if not best[0] + best[2]:
        return lines
    spared, _ = _scan(page, frozenset().union(*(around for rank, around in content if rank == best)))
    if best[0] and sum(len(t) for t, k in spared if k != OPEN) < sum(len(t) for t, _ in lines):
        return lines
    return spared
