"""Main text of HTML pages: text-to-tag ratio per line, smoothed and clustered.

The standard library's parser is fed piece by piece. Its events make a tree of elements
and lines (the text of one block element each) with their characters, tags and link
characters. The logarithm of the lines' text-to-tag ratio is smoothed by a Gaussian and
split in two clusters; the high cluster, and any line of prose, marks where the content
is. Where most of the marked text is in paragraphs, headings, lists, cells or quotations,
other marked text (a footer's line, an advert in a division of its own) does not count.
The region is the element whose text agrees best with what is left and the title (the
first h1, or h2): the share of its text that is marked weighs twice as much as the share
of the marked text that it holds. The names main and article decide between near equals
only: such an element is taken if it is worse by at most TIE. The region's lines are returned, but for
menus, headers, footers, sidebars, notices, adverts, forms, comments and anything not
shown. Lists of links are menus outside the region, and in a region that is the whole body
before its first and after its last marked line; there, other lines that are mostly links
go too.

An aside is told by its element, or by a class, id or role that is an aside's name as a
whole; inside the region, names that an article's own parts may have (search, notice) make
an aside only of what is not prose by its own ratio. A form or named element that wraps the article is
none: it holds the main element, or most of the page's text and its first article or h1 (a
form: most of the text).

Every step is linear in the page's size: what an element inherits is kept on the stack of
open elements, sums over elements are handed from child to parent once.

Defined cases: NULL or empty html, or a page without a line, gives the empty text;
where all text is in forms or named elements, it is the text; unclosed and stray tags are
mended as browsers do for blocks and lists; very long and very deep pages are read whole;
character references are decoded; white space inside a line becomes one space; lines are
joined by one newline; of equally good regions the innermost is taken; repeated rows are
all returned; an empty table gives no rows; extra columns of any name are left out.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewatch.llm.common import ship

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
    "noscript ol optgroup option p pre search section summary table tbody td template tfoot th thead "
    "title tr ul".split())
UNSEEN = frozenset("head script style noscript template title svg math iframe object select option "
                   "button textarea canvas audio video datalist".split())
ASIDES = frozenset("nav footer aside form menu dialog search".split())
# Elements that can be a page's content; lists, tables, quotations and code are parts of it.
REGIONS = frozenset("article body center div fieldset form html main section td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that hold running text, as against divisions with text of their own.
TEXTS = HEADINGS | frozenset("p li dt dd blockquote pre td th figcaption".split())
# Words of class, id and role values that name what is not the article.
ASIDE_NAMES = frozenset(
    "nav navbar navigation menu menubar topbar breadcrumb breadcrumbs pagination pager sidebar aside "
    "footer masthead banner header ad ads advert adverts advertisement advertising adsense sponsor "
    "sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login comment comments disqus respond replies reply "
    "discussion share sharing social related recommended widget widgets toolbar search contentinfo "
    "complementary skip".split())
# Of these, names that parts of an article's own text may have.
WEAK_NAMES = frozenset(
    "menubar topbar masthead banner header notice notices alert login discussion social widget "
    "widgets toolbar search contentinfo complementary skip".split())
# Parts that may stand beside them in a class or id, as in comment-list or site-footer.
AFFIXES = frozenset(
    "site main primary secondary global top bottom left right side inner outer mobile desktop sticky "
    "fixed box bar area block button buttons column container content form group icons item items "
    "links list panel placeholder row section slot text title unit wrap wrapper zone posts articles "
    "google".split())
CONTAINERS = frozenset(("article", "main"))

FEED = 1 << 16        # characters given to the parser at once
SIGMA = 1.0           # of the Gaussian, in lines
MENU_LINKS = 0.8      # a list with this share of its text in links is a menu
MENU_ITEMS = 3
MOST = 0.5            # of the page's text that a wrapper must hold to be no aside
PROSE = 20            # characters per tag from which a line counts as prose
TIE = 0.1             # of a region's score, within which an element's name decides
_PART = re.compile(r"[a-z0-9]+")

FORM, WEAK, STRONG = 0, 1, 2


def _names_aside(token: str) -> int:
    """STRONG or WEAK if a whole class, id or role is made of aside names, with or without
    affixes; else 0."""
    parts = [p.rstrip("0123456789") for p in _PART.findall(token) if not p[0].isdigit()]
    names = [p for p in parts if p in ASIDE_NAMES]
    if not names or any(p not in ASIDE_NAMES and p not in AFFIXES for p in parts):
        return 0
    return WEAK if all(p in WEAK_NAMES for p in names) else STRONG


class Open:
    """An open element: its tag and number, and what its descendants inherit."""

    __slots__ = ("tag", "id", "aside", "unseen", "anchor", "inside", "list")

    def __init__(self, tag, number, above, aside):
        self.tag, self.id = tag, number
        self.aside = aside or above is not None and above.aside
        self.unseen = tag in UNSEEN or above is not None and above.unseen
        self.anchor = tag == "a" or above is not None and above.anchor
        self.inside = tag in CONTAINERS or above is not None and above.inside
        self.list = number if tag in ("ul", "ol") else above.list if above is not None else 0


class Line:
    """The text of one block: its tags, the element it ends in, whether it is an aside's."""

    __slots__ = ("text", "size", "tags", "element", "aside", "links")

    def __init__(self, text, tags, element, aside, links):
        self.text, self.size, self.tags, self.element = text, len(text), tags, element
        self.aside, self.links = aside, min(links, len(text))

    @property
    def mostly_links(self):
        return 2 * self.links >= self.size


class Page(HTMLParser):
    """Collects lines and the tree of elements (parents have smaller numbers; 0 is none).

    Forms and elements with an aside's name are only noted, in ``named``: whether they
    wrap the article is known at the end.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[Open] = []
        self.places: dict[str, list[int]] = {}  # tag -> its places among the open elements
        self.parent, self.kinds = [0], [""]
        self.named: dict[int, int] = {}         # form or named element -> FORM, WEAK, STRONG
        self.items: dict[int, int] = {}         # list element -> its items
        self.parts: list[str] = []
        self.tags = 0
        self.links = 0

    # a malformed declaration is a comment, as for browsers
    def parse_html_declaration(self, i):
        try:
            return super().parse_html_declaration(i)
        except AssertionError:
            return self.parse_bogus_comment(i)

    @property
    def top(self):
        return self.open[-1] if self.open else None

    def flush_line(self):
        text = " ".join("".join(self.parts).split())
        if text:
            top = self.top
            self.lines.append(Line(text, self.tags, top.id if top else 0,
                                   top is not None and top.aside, self.links))
        self.parts, self.tags, self.links = [], 0, 0

    def _close_to(self, index):
        for element in reversed(self.open[index:]):
            self.places[element.tag].pop()
        del self.open[index:]

    def _innermost(self, tags):
        """The highest place of an open element of ``tags``, or -1."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=-1)

    def _close_open(self, tags, until):
        """Close the innermost open element of ``tags``, unless one of ``until`` is further in."""
        at = self._innermost(tags)
        if at > self._innermost(until):
            self._close_to(at)

    def _aside(self, tag, attrs):
        inside = self.top is not None and self.top.inside
        if tag in ASIDES and tag != "form" or tag == "header" and not inside:
            return True
        return any(k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and v
                   and "display:none" in v.replace(" ", "").lower() for k, v in attrs)

    def _named(self, tag, attrs):
        """Whether class, id or role name an aside; ids of headings and of an article's sections
        are made of their titles."""
        inside = self.top is not None and self.top.inside
        if tag in ("html", "body", "header") or tag in CONTAINERS and not inside:
            return 0
        keys = ("class", "role") if tag in HEADINGS or tag == "section" and inside \
            else ("class", "id", "role")
        return max((_names_aside(token) for k, v in attrs if k in keys and v
                    for token in v.lower().split()), default=0)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush_line()
            self._close_open(("p",), ("table", "td", "th", "button", "object"))
            if tag == "li":
                self._close_open(("li",), ("ul", "ol", "menu", "dir"))
            elif tag in ("dt", "dd"):
                self._close_open(("dt", "dd"), ("dl",))
            elif tag in ("tr", "td", "th"):
                closing = ("td", "th") if tag != "tr" else ("tr",)
                self._close_open(closing, ("table", "tbody", "thead", "tfoot"))
            elif tag == "body":
                self._close_open(("head",), ("html",))
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        above, number = self.top, len(self.kinds)
        self.parent.append(above.id if above else 0)
        self.kinds.append(tag)
        if tag in ("ul", "ol"):
            self.items[number] = 0
        elif tag == "li" and above and above.list:
            self.items[above.list] += 1
        aside = self._aside(tag, attrs)
        named = 0 if aside else self._named(tag, attrs)
        if named or not aside and tag == "form":
            self.named[number] = named
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append(Open(tag, number, above, aside))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in UNSEEN and tag not in VOID:  # browsers ignore the slash; a shut script has no text
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush_line()
        self.tags += 1
        if self.places.get(tag):
            self._close_to(self.places[tag][-1])

    def handle_data(self, data):
        top = self.top
        if top is not None and top.unseen:
            return
        self.parts.append(data)
        if top is not None and top.anchor:
            self.links += len(data.strip())

    def finish(self):
        self.close()
        self.flush_line()

    # -- the tree: sums handed up, marks handed down --

    def sums(self, lines, amount) -> list[int]:
        """Per element, the amounts of the lines in it."""
        out = [0] * len(self.kinds)
        for line in lines:
            out[line.element] += amount(line)
        for e in range(len(out) - 1, 0, -1):
            out[self.parent[e]] += out[e]
        return out

    def within(self, roots) -> list[bool]:
        """Per element, whether it or one above it is among ``roots``."""
        out = [False] * len(self.kinds)
        for e in range(1, len(out)):
            out[e] = e in roots or out[self.parent[e]]
        return out

    def path(self, e) -> list[int]:
        """The element and those above it, outermost first."""
        out = []
        while e:
            out.append(e)
            e = self.parent[e]
        return out[::-1]

    def first_in(self, lines, kind):
        """The path down to the first outermost element of a kind that holds a line, or None."""
        inside = self.within({e for e, k in enumerate(self.kinds) if k == kind})
        for line in lines:
            if inside[line.element]:
                path = self.path(line.element)
                return path[:[self.kinds[e] for e in path].index(kind) + 1]
        return None


def _marked(lines) -> np.ndarray:
    """Lines whose smoothed text-to-tag ratio lies in the higher of two clusters, or is prose's:
    one very long line must not put ordinary paragraphs into the lower one."""
    ratio = np.log1p([0.0 if line.aside else line.size / max(line.tags, 1) for line in lines])
    reach = np.arange(-3, 4)
    kernel = np.exp(-(reach / SIGMA) ** 2 / 2)
    smooth = np.convolve(np.pad(ratio, 3, mode="edge"), kernel / kernel.sum(), mode="valid")
    low, high = smooth.min(), smooth.max()
    while True:  # two means in one dimension
        cut = (low + high) / 2
        above = smooth >= cut
        if above.all() or not above.any():
            break
        new = smooth[~above].mean(), smooth[above].mean()
        if np.allclose(new, (low, high)):
            break
        low, high = new
    return above | (smooth >= np.log1p(PROSE))


def _wrappers(page: Page, lines) -> set[int]:
    """Forms and named elements that wrap the article, and so are no asides.

    These hold the page's main element, or most of its text and its first article (h1 if
    there is none); of forms without a name, most of the text will do. On a page without main
    and article, where no prose would be left, all that hold most of the text are taken. If
    nothing would be left, all are.
    """
    named = page.named
    lines = [line for line in lines if not line.aside]
    held = page.sums(lines, lambda line: line.size)
    around, anchor = [], None
    for kind in ("main", "article", "h1"):
        path = page.first_in(lines, kind)
        if path:
            around, anchor = path[:-1], kind
            break
    total = sum(line.size for line in lines)
    most = {e for e in named if held[e] >= MOST * total}
    out = {e for e in around if e in named and (anchor == "main" or e in most)}
    out |= {e for e in most if named[e] == FORM}

    def left():
        gone = page.within(set(named) - out)
        return [line for line in lines if not gone[line.element]]

    if anchor not in CONTAINERS and not any(
            _is_prose(line) for line in left()):
        out |= most
    return out if left() else set(named)


def _region(page: Page, lines, chosen) -> int:
    """The element that agrees best with the lines ``chosen``; 0 for the whole page.

    With the share p of its text that is chosen and the share r of the chosen text that it
    holds, the score is 1.25 p r / (p / 4 + r).
    """
    text = page.sums(lines, lambda line: line.size)
    marked = page.sums(chosen, lambda line: line.size)
    total = sum(line.size for line in chosen)
    best, named = (0.0, 0), (0.0, 0)
    for e in range(1, len(page.kinds)):  # the last of equals is the innermost
        if marked[e] and page.kinds[e] in REGIONS:
            p, r = marked[e] / text[e], marked[e] / total
            score = 1.25 * p * r / (p / 4 + r)
            best = max(best, (score, e))
            if page.kinds[e] in CONTAINERS:
                named = max(named, (score, e))
    region = named[1] if named[1] and named[0] >= best[0] - TIE else best[1]
    return region if page.kinds[region] not in ("html", "body") else 0


def _title(page: Page, lines) -> list[Line]:
    """The first line of a heading of the first rank that is there."""
    for heading in ("h1", "h2"):
        inside = page.within({e for e, k in enumerate(page.kinds) if k == heading})
        found = [line for line in lines if inside[line.element] and not line.mostly_links]
        if found:
            return found[:1]
    return []


def _is_prose(line) -> bool:
    return line.size >= PROSE * max(line.tags, 1) and not line.mostly_links


def _own_lists(lines, chosen, menu, gone) -> set[int]:
    """Lines of link lists between the first and the last chosen line."""
    places = {id(line): i for i, line in enumerate(lines)}
    first, last = places[id(chosen[0])], places[id(chosen[-1])]
    return {id(line) for line in lines[first:last] if menu[line.element]
            and not gone[line.element]}


def extract(html: str) -> str:
    page = Page()
    for at in range(0, len(html), FEED):
        page.feed(html[at:at + FEED])
    page.finish()
    lines = page.lines
    linked, held = (page.sums(lines, f) for f in (lambda x: x.links, lambda x: x.size))
    menu = page.within({e for e, n in page.items.items()
                        if n >= MENU_ITEMS and linked[e] >= MENU_LINKS * held[e]})
    seen = [line for line in lines if not line.aside]
    asides = set(page.named)
    if asides:
        asides -= _wrappers(page, [line for line in seen if not menu[line.element]])
    gone = page.within(asides)
    for line in lines:
        line.aside = line.aside or menu[line.element] or gone[line.element]
    shown = [line for line in lines if not line.aside]
    if not shown:
        shown = [line for line in seen if not gone[line.element]]
        return "\n".join(line.text for line in shown)
    marks = _marked(lines)
    marked = [line for line, m in zip(lines, marks) if m]
    chosen = [line for line in marked if not line.aside] or shown
    # a short line of links beside the content is marked by its neighbours only
    chosen = [line for line in chosen
              if not line.mostly_links or line.size >= PROSE * line.tags] or chosen
    title = [line for line in _title(page, shown) if line not in chosen]
    texts = page.within({e for e, k in enumerate(page.kinds) if k in TEXTS})
    running = [line for line in title + chosen if texts[line.element]]
    if 2 * sum(line.size for line in running) < sum(line.size for line in title + chosen):
        running = title + chosen
    region = _region(page, shown, running)
    if not region:
        places = {id(line): i for i, line in enumerate(shown)}
        first, last = places[id(chosen[0])], places[id(chosen[-1])]
        own = _own_lists(seen, chosen, menu, gone)
        kept = {id(line) for i, line in enumerate(shown)
                if first <= i <= last or not line.mostly_links} | own
        return "\n".join(line.text for line in lines if id(line) in kept)
    inside = page.within({region})
    # an article's own parts: lists of links, and prose under a name that is no sure aside
    prose = page.sums([line for line in lines if _is_prose(line)], lambda x: x.size)
    kept_names = {e for e in asides if page.named[e] == WEAK and inside[e]
                  and prose[e] >= MOST * held[e]}
    gone = page.within(asides - kept_names)
    return "\n".join(line.text for line in seen
                     if inside[line.element] and not gone[line.element])


def extract_udf():
    """Arrow function html -> main text."""
    @F.arrow_udf("string")
    def text(html: pa.Array) -> pa.Array:
        return pa.array([extract(h) if h else "" for h in html.to_pylist()], pa.string())
    return text


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    ship(pages.sparkSession)
    return (pages.select("page_id", "url", extract_udf()("html").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
