"""Main text of web pages by tree scoring.

A page is read into a tree of elements. Page furniture (menus, headers, footers, sidebars, notices,
adverts, forms, comments, scripts, styles) is left out by element, role and class; but class, role and form do
not remove what wraps the article, and a word in a class removes what reads otherwise only if it stands for
itself: next to words of content, or where it means links and there is prose without them, the text decides. Each paragraph then
earns points for its length and commas and passes them to its ancestors, halved at every level after the
first; an ancestor's points are discounted by the share of its text that is links. The container with most
points is kept, with those of its siblings that score well or read like its paragraphs.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed sets of HTML: elements without content, with raw text, that end a paragraph, that stand in a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp".split())
#: Drawings and formulas: read as elements, never text. Within them /> closes, save inside what holds HTML again;
#: an opening element of the last set ends them.
FOREIGN = frozenset(("svg", "math"))
HOLDS_HTML = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
ENDS_FOREIGN = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
CLOSED = re.compile(r"""(?<!=)(?:^|[\s"'])/$|^(?:.*\s)?[^\s="']+/$""", re.S)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An opening element ends an open one of these, up to the nearest of the second set.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
SCOPE = frozenset("html body table ul ol dl select article section div main td th blockquote".split())

#: Page furniture: elements, ARIA roles and words of class and id.
FURNITURE = frozenset("head nav footer aside form button select option datalist menu dialog object canvas audio video map".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form tablist toolbar".split())
WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising adsense adbox adslot banner banners sponsor sponsored promo promos promotion
    nav navbar navigation menu menus breadcrumb breadcrumbs crumbs pagination pager toc skip
    header masthead topbar footer colophon copyright legal
    sidebar sidebars rail widget widgets aside related recommended recommendations trending popular teaser
    notice notices cookie cookies consent gdpr popup modal overlay alert toast paywall newsletter subscribe subscription signup login signin
    comment comments commentlist disqus discussion replies reply respond feedback reactions
    share sharing social tags taglist form search""".split()
)
#: Words of these that, inside of an article, say what it is made of rather than what stands around it.
SOFT = frozenset("header masthead banner topbar legal copyright notice notices alert discussion feedback toc skip search popular overlay".split())
#: Words of these for blocks of links; prose without links is none.
LINKS = frozenset("nav navbar navigation menu menus breadcrumb breadcrumbs crumbs pagination pager toc skip related recommended recommendations trending popular teaser share sharing social tags taglist widget widgets rail".split())
#: Words that say where or what kind of a box something is, not what it is about.
PLAIN = frozenset(
    """a the my js is has no un sm md lg xs xl col row grid box boxes block blocks bar bars area areas section sections container wrapper wrap outer inner holder panel pane card cards list lists item items link links button buttons btn icon icons
    group set unit slot zone region module component element field input label title heading text body content main primary secondary site page pages global local post posts article articles entry blog news web app user top bottom left right center middle upper lower above below
    first last before after end start begin sticky fixed static mobile desktop tablet large small big mini full half wide fluid hidden visible open closed active current new old more less read view show close back next prev previous self auto default base""".split()
)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
QUOTE_OR_END = re.compile("[\"'>]")
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
PARAGRAPHS = frozenset("p pre td th blockquote li dd dt figcaption h1 h2 h3 h4 h5 h6".split())


class Tree:
    """Elements in page order: tag, parent, attributes, and content (texts and numbers of elements).

    Every step is constant or paid for by what it reads or closes, so the time is linear in the page. A tag ends at
    the first ``>`` outside of quotes, or at the first one at all where quotes do not close; once no ``>`` follows
    the rest is text.
    """

    def __init__(self, page: str):
        self.tag, self.parent, self.attributes, self.content = ["#root"], [0], [""], [[]]
        self.stack = [0]  # open elements
        self.spots: dict[str, list[int]] = {}  # where in the stack each tag stands
        self.blocks, self.scopes, self.holds, self.drawn = ([] for _ in range(4))  # where those kinds stand
        at, text_from, n, last = 0, 0, len(page), page.rfind(">")
        self.loose: set[int] = set()  # quotes after which a tag finds no end
        while (lt := page.find("<", at)) >= 0:
            for opening, closing in (("<!--", "-->"), ("<![CDATA[", "]]>")):
                if page.startswith(opening, lt):
                    end = page.find(closing, lt + len(opening))
                    self._text(page[text_from:lt])
                    at = text_from = end + len(closing) if end >= 0 else n
                    break
            else:
                if lt > last:
                    break
                m = NAME.match(page, lt)
                if not m:
                    at = lt + 1
                    if page[at : at + 1] in ("!", "?"):
                        self._text(page[text_from:lt])
                        at = text_from = page.find(">", at) + 1
                    continue
                self._text(page[text_from:lt])
                end = self._tag_end(page, m.end())
                attributes, at = page[m.end() : end], end + 1
                name = m[2].lower()
                if m[1]:
                    self._close(name)
                elif self._open(name, attributes):
                    at = self._raw_end(page, name, at)
                text_from = at
        self._text(page[text_from:])

    def _tag_end(self, page: str, at: int) -> int:
        """The first ``>`` outside of quotes, or the first one at all where quotes do not close.

        A quote from which there is no end is remembered, and no search goes past it again: stretches between
        two equal quotes are read once at most without reaching an end.
        """
        start, opened = at, []
        while m := QUOTE_OR_END.search(page, at):
            if m[0] == ">":
                return m.start()
            if m.start() in self.loose:
                break
            opened.append(m.start())
            at = page.find(m[0], m.end()) + 1
            if not at:
                break
        self.loose.update(opened)
        return page.find(">", start)

    def _text(self, text: str) -> None:
        if text:  # references are decoded within one text: markup between two halves makes no reference
            self.content[self.stack[-1]].append(html.unescape(text))

    def _push(self, node: int, name: str) -> None:
        k = len(self.stack)
        self.stack.append(node)
        self.spots.setdefault(name, []).append(k)
        for kind, where in ((BLOCK, self.blocks), (SCOPE, self.scopes), (HOLDS_HTML, self.holds)):
            if name in kind:
                where.append(k)

    def _cut(self, k: int) -> None:
        """Elements from place ``k`` of the stack on are closed."""
        for node in self.stack[k:]:
            self.spots[self.tag[node]].pop()
        del self.stack[k:]
        for where in (self.blocks, self.scopes, self.holds, self.drawn):
            while where and where[-1] >= k:
                where.pop()

    def _drawing(self) -> bool:
        """Whether the innermost svg or math holds what comes next, not HTML within it."""
        return bool(self.drawn) and not (self.holds and self.holds[-1] >= self.drawn[-1])

    def _open(self, name: str, attributes: str) -> bool:
        """A new element; whether what follows is raw text."""
        while name in ENDS_FOREIGN and self._drawing():
            self._cut(self.drawn[-1])
        foreign = name in FOREIGN or self._drawing()
        if not foreign:
            self._imply_ends(name)
        node = len(self.tag)
        self.tag.append(name)
        self.parent.append(self.stack[-1])
        self.attributes.append(attributes)
        self.content.append([])
        self.content[self.stack[-1]].append(node)
        if foreign and CLOSED.search(attributes):
            return False
        if foreign and name not in ("script", "style"):
            if name in FOREIGN:
                self.drawn.append(len(self.stack))
            self._push(node, name)
        elif name in RAW:
            return True
        elif name not in VOID:
            self._push(node, name)
        return False

    def _raw_end(self, page: str, name: str, at: int) -> int:
        m = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
        return (page.find(">", m.end()) + 1 or len(page)) if m else len(page)

    def _close(self, name: str) -> None:
        spots = self.spots.get(name)
        # an inline end tag does not reach out of its block
        if spots and (name in BLOCK or name in FOREIGN or not self.blocks or spots[-1] > self.blocks[-1]):
            self._cut(spots[-1])

    def _imply_ends(self, name: str) -> None:
        if name in BLOCK and self.blocks and self.tag[self.stack[self.blocks[-1]]] == "p":
            self._cut(self.blocks[-1])
        ended = max((self.spots[x][-1] for x in ENDS.get(name, ()) if self.spots.get(x)), default=0)
        if ended and ended >= (self.scopes[-1] if self.scopes else 0):
            self._cut(ended)


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(source)}


def _furniture(t: Tree, k: int, inside: bool) -> int:
    """2: element ``k`` is page furniture; 1: it is by class, role or form, unless it wraps the article; 3: it
    is by class if mostly links; 4: it is by class unless it is prose without links; or 0.

    ``inside``: of an article or main element.
    """
    tag = t.tag[k]
    if (tag in FURNITURE and tag != "form") or tag in RAW or tag in FOREIGN or (tag == "header" and not inside):
        return 2
    if not t.attributes[k]:
        return int(tag == "form")
    a = _attributes(t.attributes[k])
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or HIDDEN.search(a.get("style", "")):
        return 2
    if tag in ("html", "body", "main", "article"):
        return 2 if {"comment", "comments", "teaser", "ad", "sponsored"} & _words(a) and tag == "article" else 0
    if tag == "form" or a.get("role", "").lower() in ROLES:
        return 1
    if tag in PARAGRAPHS and tag.startswith("h"):
        return 0
    words, sure = set(), False
    for named in _named(a):
        if found := WORDS & named:
            words |= found
            sure = sure or named <= WORDS | PLAIN
    if not words:
        return 0
    return 3 if not sure or (inside and words <= SOFT) else 4 if words <= LINKS else 1


def _measure(t: Tree, out: list[bool]) -> tuple[list[str], list[int], list[int], list[float]]:
    """Of each element not ``out``: own text, lengths of all and of linked text, and a paragraph's points."""
    n = len(t.tag)
    own = [""] * n  # decoded text outside furniture, without that of elements within
    length, linked, commas, worth = [0] * n, [0] * n, [0] * n, [0.0] * n
    for k in range(n):
        if not out[k] and t.content[k]:
            own[k] = "".join(x for x in t.content[k] if isinstance(x, str))
            length[k], commas[k] = len(" ".join(own[k].split())), own[k].count(",")
    for k in range(n - 1, 0, -1):
        p = t.parent[k]
        if t.tag[k] == "a":
            linked[k] = length[k]
        length[p] += length[k]
        linked[p] += linked[k]
        if t.tag[k] not in BLOCK:
            commas[p] += commas[k]  # a paragraph has the commas of its inline elements
    for k in range(1, n):
        if not out[k] and length[k] and (t.tag[k] in PARAGRAPHS or (t.tag[k] in BLOCK and own[k].strip())):
            worth[k] = (1.0 + commas[k] + min(length[k] / 100, 3.0)) * (1 - linked[k] / length[k])
    return own, length, linked, worth


def _wrappers(t: Tree, kind: list[int], gone: list[bool]) -> set[int]:
    """Elements of kind 1 that stay, as they wrap the article: scoring decides there.

    They hold a main element, or the article element with most points if no more points lie outside all
    of kind 1; or, on pages whose points are in neither, at least half of the points of the page.
    """
    n, worth = len(t.tag), _measure(t, gone)[3]
    under, within = list(worth), [False] * n
    for k in range(n - 1, 0, -1):
        under[t.parent[k]] += under[k]
    for k in range(1, n):
        within[k] = within[t.parent[k]] or kind[k] == 1
    free = sum(worth[k] for k in range(1, n) if not within[k])
    leads = [k for k in range(1, n) if t.tag[k] in ("main", "article") and not gone[k] and under[k] > 0]
    chosen = [k for k in leads if t.tag[k] == "main"]
    articles = [k for k in leads if t.tag[k] == "article"]
    if articles:
        most = max(articles, key=lambda k: (under[k], -k))
        chosen += [most] if not within[most] or under[most] >= free else []
    stay, seen = set(), set()
    for k in chosen:
        while k and k not in seen:
            seen.add(k)
            k = t.parent[k]
            if kind[k] == 1:
                stay.add(k)
    if not leads:
        net = list(worth)  # without what nested furniture holds
        for k in range(n - 1, 0, -1):
            if kind[k] == 1 and 0 < under[0] <= 2 * net[k]:
                stay.add(k)
            if kind[k] != 1 or k in stay:
                net[t.parent[k]] += net[k]
    return stay


def _words(a: dict[str, str]) -> set[str]:
    return set().union(*_named(a))


def _named(a: dict[str, str]) -> list[set[str]]:
    """The words of each class, and of the id."""
    return [set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", x).lower())) - {""} for x in f"{a.get('class', '')} {a.get('id', '')}".split()]


def main_text(page: str | None) -> str:
    """The article's text: blocks in page order joined by one space; "" where there is none.

    Character references are decoded, white space in a block is one space. Null and empty pages, and
    pages of furniture only, give "". Broken markup is read as far as it goes; nothing is cut off.
    """
    if not page:
        return ""
    t = Tree(page)
    n = len(t.tag)
    # parents come before their elements, so one pass each way is enough, however deep the page
    kind, gone, inside, written = [0] * n, [False] * n, [False] * n, [False] * n
    for k in range(1, n):
        p = t.parent[k]
        inside[k] = inside[p] or t.tag[k] in ("article", "main")
        written[k] = written[p] or t.tag[k] in PARAGRAPHS
        kind[k] = 2 if gone[p] or (t.tag[k] == "label" and not written[p]) else _furniture(t, k, inside[p])
        gone[k] = kind[k] == 2
    if 3 in kind or 4 in kind:
        _, length, linked, worth = _measure(t, gone)
        prose = [0] * n  # characters of paragraphs that are sentences, not links
        for k in range(n - 1, 0, -1):
            if worth[k] and length[k] >= 40 and 10 * linked[k] <= length[k]:
                prose[k] = max(prose[k], length[k])
            prose[t.parent[k]] += prose[k]
        kind = [int(3 * linked[k] >= length[k]) if x == 3 else int(2 * prose[k] < length[k]) if x == 4 else x for k, x in enumerate(kind)]
    out = gone
    if 1 in kind:
        stay, out = _wrappers(t, kind, gone), list(gone)
        for k in range(1, n):
            out[k] = gone[k] or out[t.parent[k]] or (kind[k] == 1 and k not in stay)
    own, length, linked, worths = _measure(t, out)
    points = [0.0] * n
    for k in range(1, n):
        if not worths[k]:
            continue
        worth, p = worths[k], t.parent[k]
        if t.tag[k] not in PARAGRAPHS:
            points[k] += worth
        while p and worth > 0.01:
            points[p] += worth
            worth, p = worth / 2, t.parent[p]
    for k in range(1, n):
        if points[k]:
            points[k] = (points[k] + (25 if t.tag[k] in ("article", "main") else 0)) * (1 - linked[k] / max(length[k], 1))
    best = max(range(n), key=lambda k: (points[k], -k))
    if not points[best]:
        return _text(t, out, [0])
    kept, level = [], max(10.0, points[best] / 5)
    for x in t.content[t.parent[best]] if best else []:
        if isinstance(x, int) and not out[x]:
            density = linked[x] / max(length[x], 1)
            paragraph = t.tag[x] == "p" and ((length[x] > 80 and density < 0.25) or (length[x] > 0 and density == 0 and own[x].rstrip().endswith(".")))
            alike = t.tag[x] in ALIKE and density < 0.25 and (t.tag[x] != t.tag[best] or _same(t, x, best)) and (t.tag[x] == t.tag[best] or x > best)
            if x == best or points[x] >= level or paragraph or alike or (t.tag[x] in ("h1", "h2") and x < best and density == 0):
                kept.append(x)
    return _text(t, out, kept or [best])


#: Siblings of the best container that go on with the article: of its own kind, or what stands between paragraphs.
ALIKE = frozenset("section div article ul ol dl table blockquote pre figure".split())


def _same(t: Tree, x: int, best: int) -> bool:
    return _attributes(t.attributes[x]).get("class", "") == _attributes(t.attributes[best]).get("class", "")


def _text(t: Tree, out: list[bool], roots: list[int]) -> str:
    parts: list[str] = []
    stack: list = list(reversed(roots))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            parts.append(x)
        elif not out[x]:
            if t.tag[x] in BLOCK or t.tag[x] == "br":
                parts.append(" ")
                stack.append(" ")
            stack.extend(reversed(t.content[x]))
    return " ".join("".join(parts).split())


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out``, the main text, and n_chars, its code points.

    Every row stays, with all its columns (those with the new names are replaced); null counts as empty.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in batches:
            yield pd.Series([main_text(x) for x in part], dtype=object)

    made = pages.withColumn(out, F.pandas_udf(run, "string")(F.col(html_col)))
    return made.withColumn("n_chars", F.length(out).cast("long"))
