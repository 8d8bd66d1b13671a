"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text; a block's tag path is the chain of block elements from the root to it, with
their classes. Text length and punctuation are summed per path and divided by its number of blocks; both ratios
are smoothed along the page and fused. A path of a part of an article (a heading, a paragraph, a list's item, ...)
may borrow from the path of the element that holds it, so short parts stand with the prose around them. Links,
and names by which pages call menus, adverts and the like, lower a path's score. The paths whose score reaches a
share of the page's mean are the content; their blocks, and no others, are the text. Where a page says by
`article` or `main` where its text is, this raises the paths inside: in an article all stay but those that links, adverts,
comments or names of other parts speak against. Paths outside stay where they read as what is inside does.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.llm.common import bound_batches

# Elements of HTML by their part in the page.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rb rt rp s samp small span "
    "strike strong sub sup time tt u var".split()
)
NEVER = frozenset("nav footer aside form button select option datalist noscript template svg canvas object audio video map menu dialog head fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXTUAL = HEADINGS | frozenset("p blockquote pre li dd dt td th caption figcaption summary address".split())
#: A start tag closes these, up to the given limits.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Words in class and id by which pages name what is mostly no article text, and what often is none.
STRONG = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promos promotion banner banners cookie cookies "
    "consent gdpr popup modal newsletter subscribe subscription signup login sidebar sidebars nav navbar navigation menu menus breadcrumb "
    "breadcrumbs pagination pager masthead topbar footer copyright comment comments commentlist disqus respond reply replies toolbar".split()
)
WEAK = frozenset("notice notices notification notifications alert alerts overlay side aside widget widgets header foot discussion share sharing social related recommended recommendations search form disclaimer".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# The names among them that tell of adverts and of readers' comments, whatever stands there.
ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promos promotion banner banners".split())
COMMENTS, ONE_COMMENT = frozenset("comments commentlist disqus respond replies".split()), frozenset("comment reply".split())
#: Elements that are part of an article, never the whole of it.
PARTS = TEXTUAL | frozenset("ul ol dl table thead tbody tfoot tr figure details center hgroup".split())

#: What the score of a path is multiplied with under a strong name, and under a weak one outside and inside article or main.
STRONG_FACTOR, WEAK_FACTOR, WEAK_INSIDE = 0.15, 0.35, 0.5
#: What a score borrowed over an element is multiplied with.
DECAY = 0.85
#: Share of the mean score that content has at least, and content outside of the article or main of a page that has one.
LEAST, LEAST_OUTSIDE = 0.45, 0.8
#: Share of the page's text that makes an article or main count as such: one of them, and several together.
LEAST_REGION, LEAST_REGIONS = 0.1, 0.5
#: Share of linked text from which a path inside an article is one of links.
LINKED = 0.6
#: Characters and punctuation marks a block at which the two ratios count half of their most: the page's mean within these.
HALF_TEXT, HALF_MARKS = (60.0, 400.0), (1.0, 4.0)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…](?=[\s\"')\]]|\Z)|[。，、；：！？।؟،]")
_NOTICE = re.compile(r"\b(?:we|this (?:web)?site|our (?:web)?site|this page)\b.{0,80}\bcookies?\b|\baccept (?:all )?cookies\b|\ball rights reserved\b|\bsubscribe to our newsletter\b", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW}


def _judged(name: str, attributes: str) -> tuple[bool, int, str, int]:
    """Whether an element is hidden or of a role that is no text, how its names count (0, 1 weak, 2 strong), its classes, and whether its
    names tell of an advert (3), of comments (2), or of a comment (1)."""
    if not attributes or attributes.isspace():
        return False, 0, "", 0
    found = {}
    for m in _ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), next((x for x in m.groups()[1:] if x is not None), ""))
    classes = found.get("class", "").lower().split()
    own = "." + ".".join(classes) if classes else ""
    if name in ("html", "body"):
        return False, 0, own, 0
    if "hidden" in found or found.get("aria-hidden", "").strip().lower() == "true":
        return True, 0, own, 0
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return True, 0, own, 0
    if name == "main":
        return False, 0, own, 0
    if found.get("role", "").strip().lower() in ROLES:
        return True, 0, own, 0
    named = sure = 0
    for word in [*classes, *found.get("id", "").lower().split()]:
        parts = re.split(r"[-_:]+", word)
        ends = {word} if name == "article" or parts[0] in ("has", "no", "with", "without") else {word, parts[0], parts[-1]}
        named = max(named, 2 if ends & STRONG else 1 if ends & WEAK else 0)
        sure = max(sure, 3 if ends & ADVERTS else 2 if ends & COMMENTS else 1 if ends & ONE_COMMENT else 0)
    return False, named, own, sure


class _Page:
    """Blocks of a page (path, text, characters within links) and the paths themselves. What is open is counted by name, so a page of
    elements that are never closed takes time in proportion to its length."""

    def __init__(self) -> None:
        # Of each path: its element, the path around it, its mark, what its names tell of, elements, and whether it is in main (1) or an article (2).
        self.names, self.above, self.named, self.sure, self.elements, self.within = [""], [0], [0], [0], [1], [0]
        self.paths: dict[tuple[int, str, str, int], int] = {}
        self.stack: list[tuple[str, int, bool]] = [("", 0, False)]  # open elements: name, path, left out
        self.places: dict[str, list[int]] = {}  # of each name, in the stack
        self.inline: dict[str, list[bool]] = {}  # open inline elements of each name, hidden or not
        self.hidden = 0  # of them
        self.parts: list[str] = []
        self.linked = 0
        self.blocks: list[tuple[int, str, int]] = []

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append((self.stack[-1][1], text, self.linked))
            self.parts = []
        self.linked = 0

    def text(self, raw: str) -> None:
        if self.stack[-1][2] or self.hidden:
            return
        text = html.unescape(raw) if "&" in raw else raw
        self.parts.append(text)
        if self.inline.get("a"):
            self.linked += len(text)

    def _cut(self, place: int) -> None:
        """Closes all open elements from a place of the stack on, and what is open within."""
        while len(self.stack) > place:
            self.places[self.stack.pop()[0]].pop()
        self.inline, self.hidden = {}, 0

    def start(self, name: str, attributes: str) -> None:
        if name in ("br", "hr"):
            self.flush()
            return
        if name in VOID:
            return
        hidden, named, classes, sure = _judged(name, attributes)
        if name in INLINE:
            self.inline.setdefault(name, []).append(hidden)
            self.hidden += hidden
            return
        self.flush()
        if name in CLOSES:
            closed, limits = CLOSES[name]
            limit = max((self.places[x][-1] for x in limits if self.places.get(x)), default=0)
            low = [own[at] for x in closed if (own := self.places.get(x)) and (at := bisect_right(own, limit)) < len(own)]
            if low:
                self._cut(min(low))
        elif self.stack[-1][0] == "p" or self.stack[-1][0] in HEADINGS and name in HEADINGS:
            self._cut(len(self.stack) - 1)
        elif name == "body" and self.places.get("head"):
            self._cut(self.places["head"][0])
        _, above, out = self.stack[-1]
        out = out or hidden or name in NEVER or name == "header" and not self.within[above]
        key = (above, name, classes, named)
        path = self.paths.get(key)
        if path is None:
            path = self.paths[key] = len(self.names)
            self.names.append(name)
            self.above.append(above)
            self.named.append(named)
            self.sure.append(sure)
            self.elements.append(0)
            self.within.append(max(self.within[above], {"article": 2, "main": 1}.get(name, 0)))
        self.elements[path] += 1
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, path, out))

    def end(self, name: str) -> None:
        if name in INLINE:
            if self.inline.get(name):
                self.hidden -= self.inline[name].pop()
            return
        if name in VOID:
            if name == "br":
                self.flush()
            return
        self.flush()
        if self.places.get(name):
            self._cut(self.places[name][-1])


def read(page: str) -> _Page:
    own, at, n = _Page(), 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            own.text(page[at:])
            break
        if m.start() > at:
            own.text(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            if m[0].startswith("<![CDATA["):
                own.text(m[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if m[1] or m[4]:
            own.end(name)
        elif name in RAW:
            close = _RAW_END[name].search(page, at)
            at = close.end() if close else n
        else:
            own.start(name, m[3] or m[6] or "")
    own.flush()
    return own


#: How strongly a block's neighbours count in its smoothed ratios, by distance.
KERNEL = (0.025, 0.075, 0.8, 0.075, 0.025)


def _smooth(values: np.ndarray) -> np.ndarray:
    padded = np.pad(values, 2, mode="edge")
    return sum(KERNEL[i] * padded[i : i + len(values)] for i in range(5))


def _fuse(text, marks, half):
    """One score of 0 to 1 from the two ratios; each saturates, so a very long block does not dwarf the others."""
    return text / (text + half[0]) * (0.5 + marks / (marks + half[1])) / 1.5


def _regions(own: _Page, blocks: list[tuple[int, str, int]]) -> list[int]:
    """Of each path, whether it lies in the page's main (1) or in an article (2) that holds enough of the text to count as such."""
    strongest = own.named[:]
    for p in range(1, len(own.names)):
        strongest[p] = max(strongest[p], strongest[own.above[p]])
    weight = [0.0] * 3
    for path, text, _ in blocks:
        weight[own.within[path]] += len(text) * (STRONG_FACTOR if strongest[path] == 2 else 1.0)
    total = sum(weight)
    articles = sum(n for name, n in zip(own.names, own.elements) if name == "article")
    has_main = weight[1] + weight[2] >= LEAST_REGION * total and "main" in own.names
    has_article = weight[2] > 0 and weight[2] >= (LEAST_REGION if articles == 1 else LEAST_REGIONS) * total
    in_main = [0] * len(own.names)
    for p in range(1, len(own.names)):
        in_main[p] = max(in_main[own.above[p]], own.names[p] == "main")
    return [2 if w == 2 and has_article else 1 if has_main and m else 0 for w, m in zip(own.within, in_main)]


def _marks(own: _Page, path: np.ndarray, length: np.ndarray, region: list[int]) -> list[int]:
    """The mark of each path by its own names.

    An element that holds (nearly) all that is judged, or everything in the articles and main, is not judged by its name. Inside an article
    a part of the text is not either, unless it is an advert; nor is a single comment, as reader's comments come in numbers.
    """
    n, inner = len(own.names), np.array(region)[path] > 0
    chosen = inner if inner.any() else np.ones(len(path), dtype=bool)
    total, rows = np.bincount(path[chosen], length[chosen], n), np.bincount(path[chosen], minlength=n)
    for p in range(n - 1, 0, -1):
        total[own.above[p]] += total[p]
        rows[own.above[p]] += rows[p]
    around = rows == rows[0] if inner.any() else (rows > 2) & (total >= 0.8 * total[0])
    out = []
    for p, mark in enumerate(own.named):
        name, sure = own.names[p], own.sure[p]
        if around[p] and name not in PARTS:
            mark = 0
        elif region[p] == 2 and mark and (sure < 3 if name in TEXTUAL - {"li"} else sure == 1 and own.elements[p] < 2):
            mark = 0
        out.append(mark)
    return out


def path_ratios(own: _Page) -> tuple[np.ndarray, ...]:
    """Of each path its blocks, characters a block outside of links, punctuation marks a block, share of linked characters."""
    n = len(own.names)
    path = np.array([b[0] for b in own.blocks])
    size = np.array([len(b[1]) - b[2] for b in own.blocks], dtype=np.float64).clip(0)
    linked = np.array([min(b[2], len(b[1])) for b in own.blocks], dtype=np.float64)
    marks = np.array([len(_PUNCTUATION.findall(b[1])) for b in own.blocks], dtype=np.float64)
    number = np.bincount(path, minlength=n)
    some = np.maximum(number, 1)
    return number, np.bincount(path, size, n) / some, np.bincount(path, marks, n) / some, np.bincount(path, linked, n) / np.maximum(np.bincount(path, linked + size, n), 1)


def path_scores(own: _Page, region: list[int]) -> tuple[np.ndarray, np.ndarray, list[int], list[int]]:
    """(score, score without marks, strongest mark, path of the element it is a part of) of each path of the page; paths without
    blocks have 0."""
    n = len(own.names)
    number, text_ratio, mark_ratio, share = path_ratios(own)
    path = np.array([b[0] for b in own.blocks])
    length = np.array([len(b[1]) for b in own.blocks], dtype=np.float64)
    size, marks = text_ratio * number, mark_ratio * number
    inner = np.array(region)[path] > 0
    half = []
    for ratio, limits in ((text_ratio, HALF_TEXT), (mark_ratio, HALF_MARKS)):
        own_size = np.array([max(0, len(b[1]) - b[2]) for b in own.blocks], dtype=np.float64) + 1e-9
        half.append(float(np.clip(np.average(ratio[path], weights=np.where(inner, own_size, 0) if inner.any() else own_size), *limits)))
    score = np.bincount(path, _fuse(_smooth(text_ratio[path]), _smooth(mark_ratio[path]), half), n) / np.maximum(number, 1)
    # The parts of an element, taken together. Paths are numbered from the root down, so what is above is known before.
    named = _marks(own, path, length, region)
    holders, strongest = list(range(n)), named[:]
    for p in range(1, n):
        above = own.above[p]
        strongest[p] = max(named[p], strongest[above])
        if own.names[p] in PARTS and not named[p]:
            holders[p] = holders[above]
    held = np.array(holders)
    count = np.maximum(np.bincount(held, number, n), 1)
    pooled = _fuse(np.bincount(held, size, n) / count, np.bincount(held, marks, n) / count, half)
    # The best of an element and of those in it, each further one counting less.
    best = np.maximum(pooled, score)
    for p in range(n - 1, 0, -1):
        if not named[p]:
            best[own.above[p]] = max(best[own.above[p]], (1.0 if own.names[p] in PARTS else DECAY) * best[p])
    # What a part may borrow from the elements around it, up to one with a mark: less from each further one, but for an article or main.
    lent, whole = pooled.copy(), np.zeros(n)
    for p in range(n):
        if region[p] and own.names[p] in ("article", "main"):
            whole[p] = best[p]
        if p and not named[p]:
            lent[p], whole[p] = max(lent[p], DECAY * lent[own.above[p]]), max(whole[p], whole[own.above[p]])
    plain, marked = np.zeros(n), np.zeros(n)
    for p in np.flatnonzero(number).tolist():
        name, holder = own.names[p], holders[p]
        found = float(score[p])
        if holder != p:  # a part of an article
            if name in HEADINGS:
                found = max(found, float(best[holder]))
                if name == "h1" and not named[holder]:
                    found = max(found, DECAY * float(best[own.above[holder]]))
            found = max(found, float(lent[holder]), float(whole[holder]))
        listed = share[p] >= LINKED and number[p] > 1 and name in ("li", "dd", "dt", "td")  # a list of links
        plain[p] = found * (1.0 - (0.5 if region[p] and not listed or name in HEADINGS else 1.0) * share[p])
        marked[p] = plain[p] * (1.0, WEAK_INSIDE if region[p] else WEAK_FACTOR, STRONG_FACTOR)[strongest[p]]
    notices = np.bincount(path, [len(b[1]) < 400 and bool(_NOTICE.search(b[1])) for b in own.blocks], n)
    marked[(number > 0) & (number < 3) & (2 * notices >= number) & (np.array(region) < 2)] *= WEAK_FACTOR
    return marked, plain, strongest, holders


def chosen_paths(own: _Page, region: list[int]) -> np.ndarray:
    """Which paths are content: those over their share of the mean, and in an article all without a mark that are not lists of links.

    Of a page with an article or main, paths outside have to stand right beside it, not in a part of their own.
    """
    score, plain, strongest, holders = path_scores(own, region)
    weight = np.zeros(len(own.names))
    for path, text, _ in own.blocks:
        weight[path] += len(text)
    inner = np.array(region)
    judged = weight * np.where(plain > 0, score / np.where(plain > 0, plain, 1), 1.0)
    mean = np.average(plain, weights=np.maximum(np.where(inner > 0, judged, 0) if (weight[inner > 0] > 0).any() else judged, 1e-9))
    least = np.where(inner > 0, LEAST, LEAST_OUTSIDE) if inner.any() else LEAST
    number, _, _, share = path_ratios(own)
    listed = np.array([name in TEXTUAL for name in own.names])
    links = (share >= LINKED) & (~listed | (number > 1)) & np.array([name not in HEADINGS for name in own.names])
    kept = (inner == 2) & (np.array(strongest) == 0) & ~links & (number > 0)
    around = {own.above[p] for p, name in enumerate(own.names) if region[p] and name in ("article", "main")}
    beside = np.array([bool(r) or not around or h in around for r, h in zip(region, holders)])
    return kept | beside & (score > 0) & (score >= least * mean)


def content(page: str | None) -> list[str]:
    """The blocks of the content paths, in page order. Where the articles and main have no `h1`, the last one before them that no name
    speaks against is their title."""
    own = read(page) if page else _Page()
    if not own.blocks:
        return []
    region = _regions(own, own.blocks)
    chosen = chosen_paths(own, region)
    title = lambda b: own.names[b[0]] == "h1"
    inner = [i for i, b in enumerate(own.blocks) if region[b[0]]]
    heading = None
    if inner and not any(title(own.blocks[i]) for i in inner):
        strongest = path_scores(own, region)[2]
        heading = next((i for i in range(inner[0] - 1, -1, -1) if title(own.blocks[i]) and not strongest[own.blocks[i][0]]), None)
    return [b[1] for i, b in enumerate(own.blocks) if chosen[b[0]] or i == heading]


def main_text(page: str | None) -> str:
    """The text of a page: its content blocks, white space folded, joined by line ends. Null gives ''."""
    return "\n".join(content(page))


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points of the text).

    A null or empty page, or one without text, has the text ''. Null ids and repeated rows stay, other columns
    are left out. Pages are read whole, however long; broken markup is read as far as it goes.
    """

    bound_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p) for p in pages], dtype=object)

    own = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), text(F.col("html").cast("string")).alias("text"))
    return own.withColumn("n_chars", F.length("text").cast("long"))
