"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into text blocks at block-level tags. A block is described by its
number of words and its link density, the same of its neighbours, and by where
it stands: inside page furniture by tag, by a name in class or id that
tells furniture, or inside an article. Forms, and names that merely have a part that
tells furniture ("has-sidebar"), do not decide for an article or main element inside
them, nor if they hold most words of the page: then they are its layout. The same holds for whole names, but for those of
comments and of related pages. A decision tree, grown on the small labelled table below, decides which blocks are main
text. Time grows with the length of a page, however its elements are nested.

Nulls and edges: a null page is empty and has the text "". Tags that are never
closed end with the element around them; a script, style, title or text area goes
on to the end of the page, other elements without text of the page (svg, select)
to the next block of text. A tag cut off at the end of the page is dropped. Repeated rows are treated alike.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_NAME = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)

# Fixed lists: elements by their role in a page.
_RAW = {"script", "style", "noscript", "template", "textarea", "svg", "iframe", "object", "title", "select", "math"}
_TO_END = {"script", "style", "title", "textarea"}  # without an end tag the rest of the page is theirs
_BREAK_OUT = set(
    "address article aside blockquote body center dd div dl dt footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p"
    " pre section table td tr ul".split()
)
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr".split()
)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE = set("nav footer aside form button head menu dialog fieldset".split())
_FORM = {"form", "fieldset"}  # furniture unless they are around the text
_BODY = {"article", "main"}
_ITEMS = {"li", "dt", "dd", "tr", "td", "th", "option"}
_COMMENT_NAME = re.compile(r"(?:^|[\s_-])(?:comments?|replies|reply|disqus)(?:$|[\s_-])", re.I)
_FURNITURE_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|menu|nav\w*|breadcrumbs?|sidebar|side|widget\w*|footer|"
    r"masthead|topbar|toolbar|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|newsletter|subscri\w+|signup|"
    r"login|search\w*|form|comments?|replies|reply|respon\w+|disqus|discussion|related|recommend\w*|share\w*|sharing|"
    r"social|tags?|pagination|pager|copyright|legal|disclaimer|complementary|contentinfo|navigation)(?:$|[\s_-])",
    re.I,
)
# Names of what stands beside the text, whichever part of a name tells it.
_BESIDE_NAME = re.compile(
    r"(?:^|[\s_-])(?:comments?|replies|reply|respon\w+|disqus|discussion|related|recommend\w*)(?:$|[\s_-])", re.I
)

#: Names of the features of a block, in order.
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "furniture", "article", "heading")

# Labelled blocks: the features, then 1 for main text. Link density is the share of words in links.
LABELLED = (
    # paragraphs of an article between paragraphs, also very short ones
    (85, 0.0, 60, 0.0, 70, 0.0, 0, 1, 0, 1),
    (40, 0.0, 9, 0.0, 55, 0.0, 0, 1, 0, 1),
    (3, 0.0, 70, 0.0, 90, 0.0, 0, 1, 0, 1),
    (1, 0.0, 45, 0.0, 20, 0.0, 0, 1, 0, 1),
    (2, 0.0, 30, 0.0, 8, 0.0, 0, 1, 0, 1),
    (25, 0.1, 40, 0.0, 30, 0.0, 0, 1, 0, 1),
    (60, 0.3, 50, 0.05, 5, 0.0, 0, 1, 0, 1),
    (6, 1.0, 50, 0.0, 60, 0.0, 0, 1, 0, 1),
    (5, 1.0, 60, 0.0, 0, 0.0, 0, 1, 0, 1),
    (3, 1.0, 70, 0.0, 65, 0.0, 0, 1, 0, 1),
    (12, 0.5, 80, 0.0, 12, 0.4, 0, 1, 0, 1),
    # first and last block of an article, next to furniture
    (14, 0.0, 9, 0.0, 70, 0.0, 0, 1, 1, 1),
    (8, 0.0, 6, 1.0, 30, 0.0, 0, 1, 1, 1),
    (4, 0.0, 1, 1.0, 4, 0.0, 0, 1, 1, 1),
    (45, 0.0, 60, 0.0, 9, 0.1, 0, 1, 0, 1),
    (5, 0.0, 60, 0.0, 10, 0.0, 0, 1, 0, 1),
    (2, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1),
    # paragraphs of an article before, behind and between blocks of links
    (60, 0.0, 40, 0.0, 5, 1.0, 0, 1, 0, 1),
    (45, 0.0, 3, 1.0, 70, 0.0, 0, 1, 0, 1),
    (30, 0.0, 5, 1.0, 4, 1.0, 0, 1, 0, 1),
    (50, 0.1, 60, 0.0, 12, 0.9, 0, 1, 0, 1),
    # pages without an article element: long text, or shorter text among long
    (90, 0.0, 60, 0.0, 75, 0.0, 0, 0, 0, 1),
    (55, 0.05, 12, 0.0, 40, 0.0, 0, 0, 0, 1),
    (30, 0.0, 45, 0.0, 20, 0.1, 0, 0, 0, 1),
    (22, 0.1, 3, 1.0, 60, 0.0, 0, 0, 0, 1),
    (7, 0.0, 50, 0.0, 45, 0.0, 0, 0, 0, 1),
    (3, 0.0, 40, 0.0, 80, 0.0, 0, 0, 0, 1),
    (9, 0.0, 2, 1.0, 60, 0.0, 0, 0, 1, 1),
    (6, 0.0, 30, 0.0, 40, 0.0, 0, 0, 1, 1),
    (18, 0.0, 35, 0.0, 0, 0.0, 0, 0, 0, 1),
    (40, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    # the same beside blocks of links
    (60, 0.0, 0, 0.0, 3, 1.0, 0, 0, 0, 1),
    (50, 0.0, 40, 0.0, 2, 1.0, 0, 0, 0, 1),
    (35, 0.0, 2, 1.0, 12, 0.9, 0, 0, 0, 1),
    (70, 0.05, 60, 0.0, 9, 1.0, 0, 0, 0, 1),
    (28, 0.0, 5, 1.0, 5, 1.0, 0, 0, 0, 1),
    # menus, lists of links and lone links outside an article
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0),
    (2, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0),
    (3, 1.0, 2, 1.0, 14, 0.0, 0, 0, 0, 0),
    (6, 0.8, 40, 0.0, 5, 0.9, 0, 0, 0, 0),
    (12, 0.9, 9, 0.9, 11, 1.0, 0, 0, 0, 0),
    (30, 0.9, 2, 1.0, 3, 1.0, 0, 0, 0, 0),
    (2, 1.0, 60, 0.0, 0, 0.0, 0, 0, 0, 0),
    (3, 1.0, 50, 0.0, 2, 1.0, 0, 0, 0, 0),
    (9, 1.0, 40, 0.0, 0, 0.0, 0, 0, 0, 0),
    (5, 1.0, 0, 0.0, 60, 0.0, 0, 0, 0, 0),
    (12, 0.9, 60, 0.0, 45, 0.0, 0, 0, 0, 0),
    (25, 0.8, 50, 0.0, 55, 0.0, 0, 0, 0, 0),
    (2, 1.0, 45, 0.0, 70, 0.0, 0, 0, 0, 0),
    # short text at the edge of a page
    (4, 0.0, 2, 1.0, 1, 1.0, 0, 0, 0, 0),
    (6, 0.2, 3, 1.0, 0, 0.0, 0, 0, 0, 0),
    (5, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0),
    (3, 0.0, 4, 0.9, 5, 0.0, 0, 0, 1, 0),
    # furniture by tag or name: also long, without links, inside an article, beside text
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0),
    (9, 0.0, 1, 1.0, 14, 0.0, 1, 0, 0, 0),
    (9, 0.0, 45, 0.0, 0, 0.0, 1, 0, 0, 0),
    (30, 0.0, 60, 0.0, 70, 0.0, 1, 0, 0, 0),
    (75, 0.0, 60, 0.0, 40, 0.0, 1, 0, 0, 0),
    (120, 0.0, 20, 0.0, 4, 1.0, 1, 0, 0, 0),
    (40, 0.1, 50, 0.0, 45, 0.0, 1, 0, 0, 0),
    (15, 0.0, 70, 0.0, 80, 0.0, 1, 1, 0, 0),
    (60, 0.0, 70, 0.0, 80, 0.0, 1, 1, 0, 0),
    (2, 0.0, 60, 0.0, 30, 0.0, 1, 1, 0, 0),
    (4, 1.0, 30, 0.0, 60, 0.0, 1, 1, 0, 0),
    (3, 1.0, 40, 0.0, 0, 0.0, 1, 1, 0, 0),
    (2, 1.0, 2, 1.0, 2, 1.0, 1, 1, 0, 0),
    (3, 0.0, 9, 0.0, 20, 0.0, 1, 0, 1, 0),
    (5, 0.0, 60, 0.0, 20, 0.0, 1, 1, 1, 0),
)


def grow_tree(table: np.ndarray, least_rows: int = 2, depth: int = 8):
    """Decision tree by Gini impurity. A node is (feature, limit, at most, above), a leaf the share of label 1."""
    rows, labels = table[:, :-1], table[:, -1]
    share = labels.mean()
    if depth == 0 or share in (0.0, 1.0) or len(labels) < 2 * least_rows:
        return float(share)
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for limit in (values[:-1] + values[1:]) / 2:
            under = rows[:, feature] <= limit
            if min(under.sum(), (~under).sum()) < least_rows:
                continue
            impurity = sum(len(part) * part.mean() * (1 - part.mean()) for part in (labels[under], labels[~under]))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, feature, float(limit), under)
    if best is None:
        return float(share)
    _, feature, limit, under = best
    return feature, limit, grow_tree(table[under], least_rows, depth - 1), grow_tree(table[~under], least_rows, depth - 1)


def is_main(tree, block: tuple) -> bool:
    while isinstance(tree, tuple):
        feature, limit, at_most, above = tree
        tree = at_most if block[feature] <= limit else above
    return tree >= 0.5


def _tells_furniture(names: str) -> int:
    """0 if names do not tell furniture, 2 if they tell what stands beside a text whatever is in it, else 1."""
    if not _FURNITURE_NAME.search(names):
        return 0
    return 2 if _BESIDE_NAME.search(names) else 1


def _ends(page: str, name: str) -> dict[int, int]:
    """Where the elements of a name end, by the end of their start tag, if they have an end tag of their own."""
    ends, starts = {}, []
    for match in re.finditer(rf"<(/?){re.escape(name)}(?=[\s/>]|\Z)([^>]*)(?:>|\Z)", page, re.I):
        if not match[1] and not match[2].endswith("/"):
            starts.append(match.end())
        elif match[1] and starts:
            ends[starts.pop()] = match.end()
    return ends


class _Blocks:
    """Text blocks of a page in order: [text, words, linked words, furniture, article, heading]."""

    def __init__(self, page: str):
        self.found: list[list] = []
        # element, furniture, number of the possible furniture around (0: none), article, hidden
        self.open: list[tuple[str, bool, int, bool, bool]] = []
        self.count: Counter = Counter()  # of open elements by name
        self.around = [0]  # per possible furniture the one around it
        self.parts: list[str] = []
        self.linked = 0
        self.in_link = False
        self.heading = False
        at, page = 0, page.replace("\x00", "")
        ends: dict[str, dict[int, int]] = {}
        while match := _TOKEN.search(page, at):
            self.text(page[at : match.start()])
            at = match.end()
            if not match[2]:
                continue
            name = match[2].lower()
            if not match[1] and name in _RAW:
                if not match[3].endswith("/"):
                    at = self.skip(page, name, at, ends)
                continue
            self.tag(name, bool(match[1]), match[3])
        self.text(page[at:])
        self.end()
        self.settle()

    def skip(self, page: str, name: str, at: int, ends: dict[str, dict[int, int]]) -> int:
        """End of an element whose content is no text of the page. One without end tag stays open, hidden."""
        if name in _TO_END:
            close = re.compile(rf"</{re.escape(name)}\s*(?:>|\Z)", re.I).search(page, at)
            return close.end() if close else len(page)
        if name not in ends:
            ends[name] = _ends(page, name)
        if at in ends[name]:
            return ends[name][at]
        self.end()
        _, furniture, possible, article, _ = self.inside()
        self.push((name, furniture, possible, article, True))
        return at

    def inside(self) -> tuple[str, bool, int, bool, bool]:
        return self.open[-1] if self.open else ("", False, 0, False, False)

    def push(self, element: tuple[str, bool, int, bool, bool]) -> None:
        self.open.append(element)
        self.count[element[0]] += 1

    def pop(self) -> str:
        name = self.open.pop()[0]
        self.count[name] -= 1
        return name

    def text(self, raw: str) -> None:
        if raw and not (self.open and self.open[-1][4]):
            self.parts.append(raw)
            if self.in_link:
                self.linked += len(raw.split())

    def end(self) -> None:
        text = " ".join(html.unescape("".join(self.parts)).split())
        if text:
            _, furniture, possible, article, _ = self.inside()
            words = text.count(" ") + 1
            self.found.append([text, words, min(1.0, self.linked / words), (furniture, possible), article, self.heading])
        self.parts, self.linked = [], 0

    def settle(self) -> None:
        """Possible furniture is none if it holds most of the words that are not in links or in sure furniture.

        On a page with an article it is none only for the article inside it.
        """
        held, whole = [0.0] * len(self.around), 0.0
        elsewhere = any(article and not furniture for _, _, _, (furniture, _), article, _ in self.found)
        for _, words, links, (furniture, possible), _, _ in self.found:
            if not furniture:
                whole += words * (1 - links)
                held[possible] += words * (1 - links)
        for number in range(len(held) - 1, 0, -1):  # an inner one has the greater number
            held[self.around[number]] += held[number]
        small = [False] * len(held)
        for number in range(1, len(held)):
            small[number] = elsewhere or held[number] <= whole / 2 or small[self.around[number]]
        for block in self.found:
            furniture, possible = block[3]
            block[3] = furniture or small[possible]

    def tag(self, name: str, closing: bool, rest: str) -> None:
        if name == "a":
            self.in_link = not closing
        if name in _INLINE:
            return
        self.end()
        if not closing and name in _BREAK_OUT:
            while self.open and self.open[-1][0] in _RAW:
                self.pop()
        if name in _VOID:
            return
        self.heading = not closing and len(name) == 2 and name[0] == "h" and name[1].isdigit()
        if closing:
            while self.count[name] and self.pop() != name:
                pass
            return
        # a paragraph ends at any block, an item of a list or table at the next of its kind
        if self.open and (self.open[-1][0] == "p" or self.open[-1][0] == name and name in _ITEMS):
            self.pop()
        _, furniture, possible, article, hidden = self.inside()
        names = " ".join(a or b or c for a, b, c in _NAME.findall(rest)) if rest else ""
        if name in _BODY:
            furniture, possible = furniture and name != "main", 0
        if name in ("article", "section"):
            furniture = furniture or bool(names and _COMMENT_NAME.search(names))
        if name not in ("html", "body", "article", "main"):
            told = _tells_furniture(names) if names else 0
            furniture = furniture or (name in _FURNITURE and name not in _FORM) or (name == "header" and not article)
            furniture = furniture or told == 2
            if not furniture and (told or name in _FORM):
                # a form or such a name inside an article is beside its text
                if article:
                    furniture = True
                else:
                    self.around.append(possible)
                    possible = len(self.around) - 1
        hidden = hidden or bool(rest and _HIDDEN.search(rest))
        self.push((name, furniture, possible, article or name in _BODY, hidden))


def blocks(page: str | None) -> list[tuple[str, tuple]]:
    """(text, features) of every text block of a page."""
    found = _Blocks(page or "").found
    described = []
    for i, (text, words, links, furniture, article, heading) in enumerate(found):
        before = found[i - 1][1:3] if i else (0, 0.0)
        after = found[i + 1][1:3] if i + 1 < len(found) else (0, 0.0)
        described.append((text, (words, links, *before, *after, int(furniture), int(article), int(heading))))
    return described


def main_text(page: str | None, tree) -> str:
    """Blocks of main text in page order, joined by one space."""
    return " ".join(text for text, block in blocks(page) if is_main(tree, block))


def extract(page: Column, labelled: tuple = LABELLED) -> Column:
    """Main text of a column of pages, by a tree grown on a table of labelled blocks."""
    tree = grow_tree(np.array(labelled, float))

    @F.pandas_udf("string")
    def text(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(page, tree) for page in pages], dtype=object)

    return text(page)
