"""Main text of web pages: flat blocks, classified by a small decision tree.

A page is cut at its block-level tags into a flat list of text blocks.  Each has
its word count and link density, those of its two neighbours, whether it stands
in boilerplate elements or under names that say so (2 for what is never the text
itself, 1 for forms and names of mere layout), and where the article is.  A
decision tree, grown by :func:`grow` from the labelled table ``LABELLED``, says
which blocks are content; these make the text, joined by one line end, white
space inside a block (line breaks too) turned into one space.

On a page that marks no article, a second tree, from the table ``SECOND``, then weighs
the unmarked blocks that are left by the decisions on their neighbours: short sentences
beside the text and headings before it belong to it, and if nothing was taken, the
page's sentences do, or else all its unmarked text without links.

A mark counts for all that is inside its element, except where the element only
wraps the text (:func:`settle`): marks that hold most of the words of the page or
article count for nothing, and those round an <article> or <main> end there, unless
the article stands elsewhere (comments and teasers are often <article>s too).

The markup may be broken: tags that are not closed are closed by what follows
them (of the elements that are skipped whole, all but script, style, textarea and
title end at the next block tag then), an unfinished tag or comment at the end is
dropped.  Null or empty html
gives an empty text, an empty table an empty one.  Pages are read whole, row by row;
repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from recurwork.llm.common import map_rows

# Kinds of elements, and names that mark boilerplate or the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg canvas object select button".split())
RAW_TO_END = frozenset("script style textarea title".split())  # if not closed
ONE_AT_A_TIME = frozenset("select button".split())  # the next one ends an open one
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
BOILER = frozenset("head nav footer aside form menu dialog search fieldset".split())
MAIN = frozenset("article main".split())
ROLES = {"navigation": 1, "banner": 1, "contentinfo": 1, "complementary": 1, "search": 1, "dialog": 1, "alertdialog": 1, "alert": 1, "form": 1, "menu": 1, "menubar": 1}
NAMES = frozenset(
    "ad ads adv advert adbox adsbygoogle nav navbar navigation menu notice notices alert banner footer social share sharing related popup modal "
    "widget disqus replies reply respond discussion login signup subscribe toolbar pagination pager skip masthead breadcrumb "
    "breadcrumbs overlay paywall topbar teaser recommended".split())
STEMS = ("comment", "advert", "sponsor", "promo", "cookie", "consent", "gdpr", "newsletter", "sidebar", "notification", "disclaimer")
#: Marks of layout, which text may stand in as well: the tree weighs its words and links.
LAYOUT = frozenset("<form> <fieldset> @form widget teaser overlay".split())
#: Marks of what readers write, which may be far more than the text.
TALK = frozenset("comment disqus replies reply respond discussion".split())
OUTER_NAMES = frozenset("header".split())  # outside of the article only
ARTICLE_NAMES = frozenset("article articlebody post entry story content maincontent main".split())
UNNAMED = frozenset("html body article main".split())  # their names tell of the page, not of a part
NEGATIONS = frozenset("no with has without".split())
#: What a start tag closes, up to the nearest element that holds such parts.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tr", "td", "th"), "option": ("option",)}
HOLDERS = frozenset("html body article section div ul ol dl table nav aside form main header footer blockquote td th li dd dialog".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                 r"""|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([A-Za-z_:][\w:.-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
UNQUOTED = re.compile(r"""=\s*[^\s"'=<>`]*/\Z""")  # a slash that belongs to a value: the tag does not close itself
WORD = re.compile(r"[A-Za-z]+")
BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(BLOCK))})(?=[\s/>])", re.I)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

FEATURES = ("boiler", "named", "place", "words", "links", "before_words", "before_links", "after_words", "after_links")
MARKS = 2  # the first features; each grade of them has a tree of its own below
IN_MAIN, NO_MAIN, OUTSIDE = 2, 1, 0

# The labelled table.  Per row the features in the order above, then 1 for content.
# place: 2 in the article, 1 on a page that marks none, 0 outside of the article that the page marks.
LABELLED = [
    (0, 0, 2, 120, 0.0, 8, 0.0, 95, 0.0, 1), (0, 0, 2, 60, 0.1, 120, 0.0, 1, 0.0, 1), (0, 0, 2, 1, 0.0, 60, 0.0, 80, 0.0, 1),
    (0, 0, 2, 1, 1.0, 1, 1.0, 1, 1.0, 1), (0, 0, 2, 2, 0.0, 0, 0.0, 0, 0.0, 1), (0, 0, 2, 12, 1.0, 30, 0.0, 9, 1.0, 1),
    (0, 0, 2, 7, 0.0, 3, 1.0, 6, 0.0, 1), (0, 0, 2, 25, 0.5, 0, 0.0, 4, 0.3, 1), (0, 0, 2, 300, 0.0, 0, 0.0, 0, 0.0, 1),
    (0, 0, 2, 4, 0.0, 2, 1.0, 200, 0.0, 1), (0, 0, 2, 3, 0.3, 1, 0.0, 1, 0.0, 1), (0, 0, 2, 40, 0.0, 5, 0.0, 6, 0.0, 1),
    (2, 0, 2, 1, 1.0, 60, 0.0, 1, 1.0, 0), (2, 0, 2, 20, 0.0, 120, 0.0, 9, 0.0, 0), (2, 0, 2, 5, 0.0, 30, 0.0, 0, 0.0, 0),
    (0, 2, 2, 30, 0.0, 90, 0.0, 40, 0.0, 0), (0, 2, 2, 6, 0.0, 2, 0.0, 4, 0.0, 0), (0, 2, 2, 3, 1.0, 3, 1.0, 3, 1.0, 0),
    (0, 2, 2, 80, 0.0, 50, 0.0, 70, 0.0, 0), (2, 2, 2, 9, 0.2, 80, 0.0, 5, 0.0, 0), (2, 0, 2, 45, 0.1, 80, 0.0, 50, 0.0, 0),
    (2, 0, 0, 1, 1.0, 0, 0.0, 1, 1.0, 0), (2, 0, 0, 1, 1.0, 1, 1.0, 9, 0.0, 0), (2, 0, 0, 14, 0.0, 60, 0.0, 0, 0.0, 0),
    (2, 0, 0, 50, 0.0, 80, 0.0, 0, 0.0, 0), (0, 2, 0, 9, 0.0, 1, 1.0, 8, 0.0, 0), (0, 2, 0, 40, 0.0, 6, 0.0, 120, 0.0, 0),
    (0, 0, 0, 6, 0.0, 1, 1.0, 60, 0.0, 0), (0, 0, 0, 35, 0.0, 4, 1.0, 70, 0.0, 0), (0, 0, 0, 80, 0.0, 90, 0.0, 0, 0.0, 0),
    (0, 0, 0, 3, 1.0, 3, 1.0, 3, 1.0, 0), (0, 0, 0, 2, 0.0, 0, 0.0, 5, 0.0, 0), (2, 2, 0, 5, 0.5, 5, 0.5, 5, 0.5, 0),
    (0, 0, 1, 120, 0.0, 8, 0.0, 95, 0.0, 1), (0, 0, 1, 45, 0.1, 120, 0.0, 60, 0.0, 1), (0, 0, 1, 22, 0.0, 2, 1.0, 50, 0.0, 1),
    (0, 0, 1, 16, 0.2, 60, 0.0, 30, 0.0, 1), (0, 0, 1, 200, 0.05, 0, 0.0, 0, 0.0, 1), (0, 0, 1, 30, 0.0, 80, 0.0, 3, 1.0, 1),
    (0, 0, 1, 3, 0.0, 40, 0.0, 60, 0.0, 1), (0, 0, 1, 6, 0.0, 4, 1.0, 90, 0.0, 1), (0, 0, 1, 1, 0.0, 70, 0.0, 45, 0.1, 1),
    (0, 0, 1, 8, 0.0, 35, 0.0, 25, 0.0, 1), (0, 0, 1, 5, 0.0, 55, 0.0, 2, 1.0, 0), (0, 0, 1, 2, 0.0, 3, 1.0, 3, 1.0, 0),
    (0, 0, 1, 1, 1.0, 1, 1.0, 1, 1.0, 0), (0, 0, 1, 4, 1.0, 60, 0.0, 70, 0.0, 0), (0, 0, 1, 30, 0.9, 5, 1.0, 40, 0.0, 0),
    (0, 0, 1, 18, 1.0, 20, 1.0, 16, 0.9, 0), (0, 0, 1, 9, 0.0, 60, 0.0, 0, 0.0, 0), (0, 0, 1, 7, 0.3, 0, 0.0, 6, 0.6, 0),
    (2, 0, 1, 60, 0.0, 80, 0.0, 0, 0.0, 0), (2, 0, 1, 2, 1.0, 2, 1.0, 2, 1.0, 0), (2, 0, 1, 20, 0.0, 40, 0.0, 90, 0.0, 0),
    (0, 2, 1, 50, 0.0, 90, 0.0, 60, 0.0, 0), (0, 2, 1, 8, 0.0, 50, 0.0, 40, 0.0, 0), (0, 2, 1, 2, 1.0, 1, 1.0, 30, 0.0, 0),
    # in forms and under names of layout
    (0, 1, 2, 80, 0.0, 50, 0.0, 70, 0.0, 1), (0, 1, 2, 45, 0.1, 5, 0.0, 60, 0.0, 1), (0, 1, 2, 9, 0.0, 80, 0.0, 60, 0.0, 0),
    (0, 1, 2, 3, 1.0, 3, 1.0, 3, 1.0, 0), (0, 1, 2, 40, 1.0, 60, 0.0, 50, 0.0, 0), (0, 1, 2, 14, 0.0, 2, 0.0, 4, 0.0, 0),
    (1, 0, 2, 90, 0.0, 60, 0.0, 40, 0.0, 1), (1, 0, 2, 50, 0.1, 3, 0.0, 45, 0.0, 1), (1, 0, 2, 12, 0.0, 60, 0.0, 2, 0.0, 0),
    (1, 0, 2, 2, 0.0, 90, 0.0, 1, 0.0, 0), (1, 1, 2, 70, 0.0, 60, 0.0, 60, 0.0, 1), (1, 1, 2, 6, 0.0, 40, 0.0, 2, 0.0, 0),
    (0, 1, 1, 90, 0.0, 60, 0.0, 50, 0.0, 1), (0, 1, 1, 50, 0.1, 4, 0.0, 60, 0.0, 1), (0, 1, 1, 15, 0.0, 50, 0.0, 40, 0.0, 0),
    (0, 1, 1, 4, 1.0, 4, 1.0, 4, 1.0, 0), (0, 1, 1, 45, 1.0, 60, 0.0, 60, 0.0, 0), (1, 0, 1, 80, 0.0, 50, 0.0, 60, 0.0, 1),
    (1, 0, 1, 60, 0.1, 3, 0.0, 40, 0.0, 1), (1, 0, 1, 12, 0.0, 60, 0.0, 3, 0.0, 0), (1, 0, 0, 60, 0.0, 90, 0.0, 0, 0.0, 0),
    (0, 1, 0, 70, 0.0, 60, 0.0, 9, 0.0, 0), (0, 1, 2, 70, 1.0, 50, 0.0, 45, 0.0, 0), (0, 1, 1, 90, 1.0, 60, 0.0, 50, 0.0, 0),
    (1, 0, 2, 80, 0.9, 50, 0.0, 60, 0.0, 0), (1, 0, 1, 70, 0.9, 50, 0.0, 60, 0.0, 0),
    (1, 1, 2, 60, 0.9, 40, 0.0, 50, 0.0, 0), (1, 1, 1, 60, 0.1, 50, 0.0, 50, 0.0, 1), (1, 1, 0, 60, 0.0, 50, 0.0, 50, 0.0, 0),
    (1, 0, 2, 90, 0.0, 60, 0.0, 0, 0.0, 1), (1, 0, 2, 12, 0.0, 60, 0.0, 50, 0.0, 0), (1, 0, 1, 15, 0.0, 3, 0.0, 60, 0.0, 0),
    (1, 1, 2, 70, 0.0, 2, 0.0, 0, 0.0, 1), (1, 1, 2, 6, 0.0, 60, 0.0, 50, 0.0, 0), (1, 1, 1, 8, 0.0, 50, 0.0, 60, 0.0, 0),
]

SECOND_FEATURES = ("sibling", "sentence", "heading", "links", "before_taken", "after_taken", "told")
ALL_TEXT, SENTENCES, LONG = 0, 1, 2
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
RIGHTS = ("©", "(c)", "copyright")  # how a line on rights begins
ENDS = tuple(".!?…。！？")

# The labelled table of the second pass, over unmarked blocks that the first one left on a page that
# marks no article.  sibling: stands beside a taken block in one element; told: what the page shows, 2 blocks that are
# taken, 1 none, but sentences, 0 neither.
SECOND = [
    (1, 1, 0, 0.0, 1, 0, 2, 1), (1, 1, 0, 0.0, 0, 1, 2, 1), (1, 1, 0, 0.1, 1, 1, 2, 1), (1, 1, 0, 0.2, 0, 0, 2, 1), (0, 1, 0, 0.0, 1, 0, 2, 0),
    (0, 1, 0, 0.0, 0, 0, 2, 0), (0, 1, 0, 0.1, 0, 1, 2, 0), (1, 0, 0, 0.0, 1, 0, 2, 0), (1, 0, 0, 0.0, 0, 0, 2, 0), (0, 0, 0, 0.0, 1, 0, 2, 0),
    (0, 0, 0, 0.0, 0, 0, 2, 0), (0, 0, 0, 0.0, 0, 1, 2, 0), (1, 0, 0, 0.0, 0, 1, 2, 0), (1, 1, 0, 0.8, 1, 0, 2, 0), (1, 1, 0, 1.0, 0, 1, 2, 0),
    (0, 0, 1, 0.0, 0, 1, 2, 1), (1, 0, 1, 0.0, 0, 1, 2, 1), (1, 0, 1, 0.0, 1, 1, 2, 1), (0, 1, 1, 0.0, 0, 1, 2, 1), (0, 0, 1, 0.0, 0, 0, 2, 0),
    (1, 0, 1, 0.0, 0, 0, 2, 0), (1, 0, 1, 0.0, 1, 0, 2, 0), (0, 0, 1, 0.0, 1, 0, 2, 0), (0, 0, 1, 1.0, 0, 1, 2, 0), (1, 0, 1, 1.0, 1, 1, 2, 0),
    (0, 1, 0, 0.0, 0, 0, 1, 1), (0, 1, 0, 0.2, 0, 0, 1, 1), (0, 1, 1, 0.0, 0, 0, 1, 1), (0, 0, 0, 0.0, 0, 0, 1, 0), (0, 0, 1, 0.0, 0, 0, 1, 0),
    (0, 1, 0, 0.9, 0, 0, 1, 0), (0, 0, 0, 1.0, 0, 0, 1, 0), (0, 0, 1, 1.0, 0, 0, 1, 0), (0, 0, 0, 0.0, 0, 0, 0, 1), (0, 0, 0, 0.3, 0, 0, 0, 1),
    (0, 0, 1, 0.0, 0, 0, 0, 1), (0, 0, 0, 0.9, 0, 0, 0, 0), (0, 0, 0, 1.0, 0, 0, 0, 0), (0, 0, 1, 1.0, 0, 0, 0, 0),
]

Tree = tuple | int


def grow(rows: list[tuple], least: int = 1, marks: int = MARKS) -> Tree:
    """A decision tree by Gini impurity, split by marks (the first features) first: (feature, bound, tree up to it, tree above it), or a label."""

    def impurity(part: list[tuple]) -> float:
        p = sum(r[-1] for r in part) / len(part)
        return len(part) * p * (1 - p)

    if impurity(rows) == 0:
        return rows[0][-1]
    best = None
    marked = [f for f in range(marks) if len({r[f] for r in rows}) > 1]
    for f in marked or range(len(rows[0]) - 1):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:], strict=False):
            low, high = [r for r in rows if r[f] <= a], [r for r in rows if r[f] > a]
            if min(len(low), len(high)) >= least:
                cost = impurity(low) + impurity(high)
                if best is None or cost < best[0] - 1e-12:
                    best = cost, f, (a + b) / 2, low, high
    if best is None:
        return int(2 * sum(r[-1] for r in rows) >= len(rows))
    _, f, bound, low, high = best
    return f, bound, grow(low, least, marks), grow(high, least, marks)


def decide(tree: Tree, row: tuple) -> int:
    while not isinstance(tree, int):
        f, bound, low, high = tree
        tree = low if row[f] <= bound else high
    return tree


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)}


def name_words(attrs: dict[str, str]) -> list[list[str]]:
    """The words of each class and of the id."""
    return [[w.lower() for w in WORD.findall(CAMEL.sub(" ", name))] for name in (attrs.get("class", "") + " " + attrs.get("id", "")).split()]


def named_by(words: list[list[str]], names: frozenset[str], stems: tuple[str, ...] = ()) -> set[str]:
    """The names and stems that the words of classes and id show."""
    found = set()
    for own in words:
        if not NEGATIONS & set(own):
            found.update(w for w in own if w in names)
            found.update(k for w in own if w.startswith(stems) for k in stems if w.startswith(k))
    return found


class Element:
    """An element with its own marks; ``settle`` says which of them count, for it and for all that is inside it."""

    __slots__ = ("above", "article", "boiler", "closed", "free", "free_mains", "good", "hidden", "holds", "inside", "link", "main", "mains", "marks", "name",
                 "named", "open", "opened", "own", "parent", "place")

    def __init__(self, name: str, attrs: dict[str, str], parent: Element | None):
        self.name, self.parent = name, parent
        role = attrs.get("role", "").lower()
        self.place = name in MAIN or role in MAIN  # is an article itself
        words = name_words(attrs) if attrs and name not in UNNAMED and not self.place else []
        self.main = self.place or parent is not None and parent.main
        self.article = (parent is not None and parent.article or bool(words and named_by(words, ARTICLE_NAMES))
                        or attrs.get("itemprop") == "articleBody")
        self.marks: dict[str, int] = {}  # 1 for names, 0 for what else tells of boilerplate
        if name in BOILER or name == "header" and not self.main:
            self.marks[f"<{name}>"] = 0
        if role in ROLES:
            self.marks[f"@{role}"] = 0
        if attrs and ("hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "")):
            self.marks["hidden"] = 0
        if words:
            self.marks |= dict.fromkeys(sorted(named_by(words, NAMES, STEMS) | (set() if self.main else named_by(words, OUTER_NAMES))), 1)
        self.link = name == "a" or parent is not None and parent.link
        #: Boilerplate inside a line of text: its words do not join the block around it.
        self.hidden = name not in BLOCK and (bool(self.marks) or parent is not None and parent.hidden)
        self.boiler = self.named = 0
        self.closed = self.opened = (0, 0)  # the grades that pass down; those that end at the next article
        #: Words without links of its own, with those inside, and without those under marks; articles in the same way.
        self.own = self.good = self.free = self.mains = self.free_mains = 0
        self.holds = frozenset({"main"} if name == "main" or role == "main" else {"h1"} & {name})
        self.inside: list[Element] = []  # the last one first


def grouped(scope: Element, members: list[Element]) -> dict[str, list[Element]]:
    """The outermost elements of each mark; counts anew what stands under no mark.  ``members`` in order."""
    out: dict[str, list[Element]] = {}
    scope.above = frozenset()
    for e in members:
        up = e.parent
        e.above = up.above.union(up.marks) if up.marks and up is not scope else up.above
        for k in e.marks:
            if k not in e.above:
                out.setdefault(k, []).append(e)
    for e in (scope, *members):
        if e is scope or not e.place:  # nested articles are counted already
            e.free, e.free_mains = e.own, int(e.place)
    for e in reversed(members):
        if not e.marks:
            e.parent.free += e.free
            e.parent.free_mains += e.free_mains
    return out


def same_inside(e: Element, mark: str) -> Element | None:
    """The next element of the mark inside that holds all that ``e`` holds."""
    while e is not None:
        e = None if e.place else next((c for c in e.inside if (c.good, c.mains, c.holds) == (e.good, e.mains, e.holds)), None)
        if e is not None and mark in e.marks:
            return e
    return None


def settle(page: Element, elements: list[Element], blocks: list[Block]) -> None:
    """Which marks count, by ``boiler`` and ``named``; ``elements`` are in order, the page's root not among them.

    Marks are held against the scope they stand in, the nearest article or the page;
    all elements of a scope with the same mark make one group.

    * A group that holds most of the scope's words, and <main> if that is there, wraps
      the text and counts for nothing if it holds a title, or all articles that are under
      no other mark, or if beside it hardly any word is under no mark.  The largest goes
      first, then all is weighed again.  What readers write (``TALK``) is taken for the
      text only if it holds a title or <main>, or if nothing else is under no mark.
    * Else a mark round <main>, or round articles where the scope has no other one and
      no more words beside them, does not pass into them.
    """
    for b in blocks:
        b.element.own += b.words - b.links
    for e in (page, *elements):
        e.good, e.mains = e.own, int(e.place)
    for e in reversed(elements):
        e.parent.inside.append(e)
        e.parent.good += e.good
        e.parent.mains += e.mains
        if e.holds:
            e.parent.holds |= e.holds
    for scope in (*(e for e in reversed(elements) if e.place), page):
        members, todo = [], list(scope.inside)
        while todo:
            members.append(e := todo.pop())
            if not e.place:  # that is a scope of its own
                todo += e.inside
        need = {"main"} & frozenset().union(*(e.holds for e in scope.inside))
        while True:
            groups = grouped(scope, members)
            others, all_mains = scope.free_mains - scope.place, scope.mains - scope.place
            wraps, open_, most = None, set(), scope.good / 2
            for k, group in groups.items():
                good, mains = sum(e.good for e in group), sum(e.mains for e in group)
                held = frozenset().union(*(e.holds for e in group))
                whole = mains and not others and not (k in TALK and scope.free)
                if "main" in held or whole and good >= scope.free:
                    open_.add(k)
                alone = mains == all_mains and (not scope.free if k in TALK else 20 * scope.free <= good)
                if good > most and need <= held and ("h1" in held or whole or alone):
                    wraps, most = k, good
            if wraps is None:
                break
            layer = groups[wraps]
            while all(layer):  # a group nested in it that holds the same would wrap in the next round
                for e in layer:
                    e.marks.pop(wraps)
                layer = [same_inside(e, wraps) for e in layer]
        for e in members:
            e.open = open_
    for e in elements:
        closed, opened = list(e.parent.closed), [0, 0] if e.place else list(e.parent.opened)
        for k, name in e.marks.items():
            into = opened if k in e.open and not e.place else closed
            into[name] = max(into[name], 1 if k in LAYOUT else 2)
        e.closed, e.opened = closed, opened
        e.boiler, e.named = max(closed[0], opened[0]), max(closed[1], opened[1])


class Block:
    __slots__ = ("element", "links", "parts", "words")

    def __init__(self, element: Element):
        self.element, self.parts, self.words, self.links = element, [], 0, 0


def ends_of(name: str, html: str) -> dict[int, int]:
    """By the end of each start tag of the name that is closed, the end of what it holds."""
    out: dict[int, int] = {}
    open_: list[int] = []
    for m in re.finditer(rf"<(/?){name}(?=[\s/>])[^>]*>?", html, re.I):
        if m[1]:
            if open_:
                out[open_.pop()] = m.end()
        elif not m[0].endswith("/>"):
            if name in ONE_AT_A_TIME:
                open_.clear()
            open_.append(m.end())
    return out


def blocks_of(html: str) -> list[Block]:
    """The flat text blocks of a page in order."""
    out: list[Block] = []
    page = Element("", {}, None)
    stack: list[Element] = [page]
    elements: list[Element] = []
    ends: dict[str, dict[int, int]] = {}
    block: Block | None = None

    def text(raw: str) -> None:
        nonlocal block
        if not raw or raw.isspace() and block is None:
            return
        top = stack[-1]
        told = unescape(raw) if "&" in raw else raw
        if top.hidden:
            aside = Block(top)
            aside.parts, aside.words = [told], len(told.split())
            if aside.words:
                out.append(aside)
            return
        if block is None:
            block = Block(top)
        n = len(told.split())
        block.parts.append(told)
        block.words += n
        block.links += n * top.link

    def end() -> None:
        nonlocal block
        if block is not None and block.words:
            out.append(block)
        block = None

    at = 0
    while (m := TAG.search(html, at)) is not None:
        text(html[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in BLOCK:
            end()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
                if name not in BLOCK and stack[i].name in BLOCK:  # an inline end tag closes no block
                    break
        elif name == "br":
            text(" ")
        elif name in RAW:
            if not m[0].endswith("/>"):
                if name in RAW_TO_END:
                    close = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                    at = close.end() if close else len(html)
                else:
                    if name not in ends:
                        ends[name] = ends_of(name, html)
                    if at in ends[name]:
                        at = ends[name][at]
                    else:
                        after = BLOCK_TAG.search(html, at)
                        at = after.start() if after else len(html)
            text(" ")
        elif name not in VOID:
            shut = CLOSES.get(name, ()) + (("p",) if name in BLOCK else ())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in shut:
                    del stack[i:]
                elif stack[i].name in HOLDERS:
                    break
            if not m[0].endswith("/>") or name in BLOCK or UNQUOTED.search(m[3]):
                stack.append(Element(name, attributes(m[3]) if m[3] else {}, stack[-1]))
                elements.append(stack[-1])
    if at < len(html) and not re.match(r"</?[A-Za-z]", html[at:]):
        text(html[at:])
    end()
    settle(page, elements, out)
    return out


def rows_of(blocks: list[Block]) -> list[tuple]:
    """The features of each block."""
    marked = any(b.element.main and not (b.element.boiler or b.element.named) for b in blocks)
    hinted = not marked and any(b.element.article for b in blocks)
    sizes = [(0, 0.0), *((b.words, b.links / b.words) for b in blocks), (0, 0.0)]
    out = []
    for i, b in enumerate(blocks, 1):
        e = b.element
        inside = e.main if marked else e.article
        place = IN_MAIN if inside else OUTSIDE if marked or hinted else NO_MAIN
        out.append((e.boiler, e.named, place, *sizes[i], *sizes[i - 1], *sizes[i + 1]))
    return out


def block_element(e: Element) -> Element:
    """The block-level element that an element belongs to."""
    while e.name not in BLOCK and e.parent is not None:
        e = e.parent
    return e


def second_pass(blocks: list[Block], rows: list[tuple], texts: list[str], taken: list[int], tree: Tree) -> list[int]:
    """The blocks taken, with those that the decisions on their neighbours speak for.

    Twice, since a heading may stand before a short paragraph that the first time takes.
    """
    left = [i for i, row in enumerate(rows) if not taken[i] and row[:3] == (0, 0, NO_MAIN)]
    if not left:
        return taken
    own = [block_element(b.element) for b in blocks]
    sentence = {i: int(texts[i].rstrip("\"'”’»)] ").endswith(ENDS) and not texts[i].lower().startswith(RIGHTS)) for i in left}
    for _ in range(2):
        told = LONG if any(taken) else SENTENCES if any(sentence[i] and rows[i][4] < 0.5 for i in left) else ALL_TEXT
        beside = {own[i].parent for i, t in enumerate(taken) if t}
        known = [0, *taken, 0]
        taken = list(taken)
        for i in left:
            taken[i] = taken[i] or decide(tree, (int(own[i].parent in beside), sentence[i], int(own[i].name in HEADINGS), rows[i][4],
                                                 known[i], known[i + 2], told))
    return taken


def main_text(html: str, tree: Tree, second: Tree) -> tuple[str, int, int]:
    """The text, and the numbers of blocks and of those taken."""
    blocks = blocks_of(html)
    rows = rows_of(blocks)
    texts = [" ".join("".join(b.parts).split()) for b in blocks]
    taken = second_pass(blocks, rows, texts, [decide(tree, row) for row in rows], second)
    return "\n".join(t for t, take in zip(texts, taken, strict=True) if take), len(blocks), sum(taken)


SCHEMA = "page_id long, url string, text string, n_chars long, n_blocks int, n_taken int"
ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_blocks", pa.int32()), ("n_taken", pa.int32())])


def extract_pages(pages: DataFrame, labelled: list[tuple] = LABELLED, second: list[tuple] = SECOND) -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks, n_taken`` per page; no shuffle."""
    tree, tree_of_rest = grow(labelled), grow(second, marks=0)

    def run(columns: list[list]) -> list[list]:
        found = [main_text(html or "", tree, tree_of_rest) for html in columns[2]]
        return [columns[0], columns[1], [f[0] for f in found], [len(f[0]) for f in found], [f[1] for f in found], [f[2] for f in found]]

    return map_rows(pages.select("page_id", "url", "html"), run, SCHEMA, ARROW)
