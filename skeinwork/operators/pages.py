"""Typed columns from product pages: one parse per page in Arrow batches, regular expressions where they suffice."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property, lru_cache
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# The selectors of each field of a product page, in order of preference. The subset of CSS is tag, #id, .class,
# [attribute], [attribute=value], [attribute*=value], a blank for "inside" and a + for "right behind"; @attribute at the
# end takes that instead of the text.
SPEC: dict[str, list[str]] = {
    "name": ["#productDetailsMain h3.text-primary", "h1.product-title", ".product-name h1", "h1[data-product-name]", ".product-header h1", "h1"],
    "sku": ["span.product-number.ng-binding", "span.product-number", ".product-sku", "[data-product-sku]", ".product-id", 'span[translate*="PRODUCT_NO"]'],
    "description": ["#productDetailsMain div.product-info p.ng-binding", ".product-description p", ".product-summary p", "[data-product-description]"],
    "price": [".product-price a.ng-binding", '.product-price a[ng-click*="scrollTo"]', ".product-price .ng-binding", ".product-price strong + a", "[data-product-price]", ".price-range"],
    "cpn": ["div.product-cpn.ng-binding", ".product-cpn", "[data-product-cpn]"],
    "shipping_time": ['div[ng-repeat*="ProductionTime"]', ".shipping-time"],
    "origin": ['p[ng-if*="Origin"]', ".origin"],
    "prop_65": ['p[ng-repeat*="PROP"]', ".prop-65"],
    "supplier_name": [".supplier-name"],
    "supplier_phone": [".supplier-phone"],
    "supplier_fax": [".supplier-fax"],
}
# Selectors of the image list; the first one that any element fits gives it.
IMAGES = ['#productImages input[type="image"]@src', ".product-images img@src", ".variant-images img@src", "img[data-product-image]@src", "img.main-image@src", "img.gallery@src"]
#: Fields whose text loses this prefix.
PREFIXES = {"sku": "Product #:"}
PARSED = """fields map<string,string>, images array<string>, attributes map<string,array<string>>,
warnings array<string>, certifications array<string>, rush boolean, supplier_text string, supplier_link string,
related array<struct<name: string, image: string, id: string>>,
prices array<struct<label: string, quantity: int, price: double, discount_code: string>>,
product_json string, product_number string""".replace("\n", " ")


_NONE: dict[str, str] = {}
#: Tags and comments on which all readers of HTML agree: names of ASCII letters, digits and hyphens, quoted values or none.
_PLAIN = re.compile(
    r"""<(?:([a-zA-Z][a-zA-Z0-9-]*)((?:[ \t\n\r\f]+[a-zA-Z][\w:.-]*(?:="[^"]*"|='[^']*')?)*)[ \t\n\r\f]*(/?)>|/([a-zA-Z][a-zA-Z0-9-]*)[ \t\n\r\f]*>|!--(?![->])(?:[^-]|-[^-])*-->|![dD][oO][cC][tT][yY][pP][eE][ ]+[a-zA-Z]+>)""",
    re.ASCII,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:.-]*)(?:="([^"]*)"|='([^']*)')?""", re.ASCII)
_REFERENCES = re.compile(r"(?:[^&]|&(?:quot|amp|lt|gt|apos|nbsp|#[0-9]+);)*")
#: A text and the tag or comment behind it.
_TOKEN = re.compile(r"""([^<]*)(<!--(?![->])(?:[^-]|-[^-])*-->|<[^<>"']+(?:"[^"]*"[^<>"']*|'[^']*'[^<>"']*)*>)""")
_RAW = {tag: re.compile(rf"[^<]*(?:<(?!!--|/\s*{tag})[^<]*)*</{tag}>", re.I) for tag in ("script", "style")}
#: Elements whose content some versions of the standard parser read as text.
_OWN_RULES = frozenset("title textarea iframe noembed noframes xmp plaintext noscript".split())
_START, _EMPTY, _END, _NOTHING = range(4)


def _keys(tag: str, own: dict[str, str]) -> list[tuple[str, str]]:
    """What an element is listed by."""
    if not own:
        return [("tag", tag)]
    names = set(own["class"].split()) if "class" in own else set()
    if tag == "meta" and "name" in own:
        names.add(own["name"])
    return [("tag", tag), *[("attribute", name) for name in own], *([("id", own["id"])] if "id" in own else []), *[("class", name) for name in names]]


def _plain_tag(text: str) -> tuple[int, str, dict[str, str], list[tuple[str, str]]] | None:
    """(kind, tag, attributes, keys) of a plain tag or comment; None for another."""
    m = _PLAIN.fullmatch(text)
    if not m or "&" in (m[2] or "") and not _REFERENCES.fullmatch(m[2]):
        return None
    if not m[1]:
        return (_END, m[4].lower(), _NONE, []) if m[4] else (_NOTHING, "", _NONE, [])
    tag = m[1].lower()
    own = {k.lower(): unescape(v or w) for k, v, w in _ATTRIBUTE.findall(m[2])} if m[2] else _NONE
    return _EMPTY if m[3] else _START, tag, own, _keys(tag, own)


_known_tag = lru_cache(8192)(_plain_tag)  # for short ones, which come again


class Page(HTMLParser):
    """A page's elements, numbered as they open: element i holds those from i + 1 to end[i], and text[start[i]:stop[i]].

    Text is kept once, in one buffer. Elements are listed by tag, id, class and attribute. All of it grows with the page
    alone, however deep elements nest and however many are never closed.
    """

    def __init__(self, html: str = "") -> None:
        super().__init__(convert_charrefs=True)
        self.tags: list[str] = []
        self.attrs: list[dict[str, str]] = []
        self.up: list[int] = []
        self.before: list[int] = []
        self.end: list[int] = []
        self.start: list[int] = []
        self.stop: list[int] = []
        self.index: defaultdict[tuple[str, str], list[int]] = defaultdict(list)
        self.pieces: list[str] = []
        self.length = self.off = 0
        self.stack: list[int] = []
        self.open: defaultdict[str, int] = defaultdict(int)
        self.youngest: dict[int, int] = {}
        self.feed(html[self._read(html) :])
        self.close()

    def _read(self, html: str) -> int:
        """Hands on plain tags and texts, as the standard parser would; returns where it has to go on: at the text before the
        first thing that is not plain, or behind the last tag."""
        at, goes_on = 0, True
        while goes_on:
            goes_on = False
            for m in _TOKEN.finditer(html, at):
                text, source = m.groups()
                known = _known_tag(source) if len(source) < 200 else _plain_tag(source)
                if known is None or m.start() != at:
                    return at
                kind, tag, own, keys = known
                end = m.end()
                if goes_on := kind <= _EMPTY and tag in _RAW:
                    if kind == _EMPTY or not (raw := _RAW[tag].match(html, end)):
                        return at
                    end = raw.end()
                elif kind <= _EMPTY and tag in _OWN_RULES and (tag not in ("title", "textarea") or kind == _EMPTY or not html.startswith(f"</{tag}>", html.find("<", end))):
                    return at
                if text and not self.off:
                    self.handle_data(unescape(text) if "&" in text else text)
                at = end
                if kind == _START:
                    self._enter(tag, own, keys)
                elif kind == _END:
                    self.handle_endtag(tag)
                elif kind == _EMPTY:
                    self._enter(tag, own, keys)
                    if tag not in VOID:
                        self.handle_endtag(tag)
                if goes_on:
                    self.handle_endtag(tag)
                    break  # the content was passed over
        return at

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        own = {k: v or "" for k, v in attrs} if attrs else _NONE
        self._enter(tag, own, _keys(tag, own))

    def _enter(self, tag: str, own: dict[str, str], keys: list[tuple[str, str]]) -> None:
        i, stack, length = len(self.tags), self.stack, self.length
        up = stack[-1] if stack else -1
        self.tags.append(tag)
        self.attrs.append(own)
        self.up.append(up)
        self.before.append(self.youngest.get(up, -1) if up >= 0 else -1)
        self.youngest[up] = i
        self.end.append(i + 1)
        self.start.append(length)
        self.stop.append(length)
        for key in keys:
            self.index[key].append(i)
        if tag not in VOID:
            stack.append(i)
            self.open[tag] += 1
            if tag in _RAW:
                self.off += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _leave(self) -> str:
        i = self.stack.pop()
        tag = self.tags[i]
        self.end[i], self.stop[i] = len(self.tags), self.length
        self.open[tag] -= 1
        if tag in _RAW:
            self.off -= 1
        return tag

    def handle_endtag(self, tag: str) -> None:
        if self.open.get(tag):  # else no element ends here, and none is looked at
            while self._leave() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if not self.off:
            self.pieces.append(data)
            self.length += len(data)

    def close(self) -> None:
        super().close()
        while self.stack:
            self._leave()
        self.buffer = "".join(self.pieces)

    def text(self, i: int) -> str:
        return " ".join(self.buffer[self.start[i] : self.stop[i]].split())

    def of(self, kind: str, name: str) -> list[int]:
        """Elements of a tag, id, class or attribute, in page order."""
        return self.index.get((kind, name), [])

    def children(self, kind: str, name: str) -> dict[int, list[int]]:
        """By parent, its children of a tag, id, class or attribute."""
        out: dict[int, list[int]] = {}
        for i in self.of(kind, name):
            out.setdefault(self.up[i], []).append(i)
        return out

    def inside(self, found: list[int], tops: list[int]) -> list[int]:
        """Those of found (in page order) that lie in one of tops (in page order): the furthest end of the tops before tells."""
        out, at, furthest = [], 0, 0
        for i in found:
            while at < len(tops) and tops[at] < i:
                furthest = max(furthest, self.end[tops[at]])
                at += 1
            if furthest > i:
                out.append(i)
        return out

    def nearest(self, found: list[int], tops: list[int]) -> dict[int, list[int]]:
        """By top, those of found whose innermost one it is; found and tops are in page order."""
        out: dict[int, list[int]] = {t: [] for t in tops}
        stack, at = [], 0
        for i in found:
            while at < len(tops) and tops[at] < i:
                while stack and self.end[stack[-1]] <= tops[at]:
                    stack.pop()
                stack.append(tops[at])
                at += 1
            while stack and self.end[stack[-1]] <= i:
                stack.pop()
            if stack:
                out[stack[-1]].append(i)
        return out

    @cached_property
    def numbers(self) -> tuple[list[int], list[int]]:
        """Where runs of digits, dots and commas with two characters up to a last digit start, and where they end."""
        runs = [(m.start(), m.start() + len(m.group().rstrip(".,"))) for m in re.finditer(r"[\d.,]+", self.buffer)]
        long = [r for r in runs if r[1] - r[0] > 1]
        return [s for s, _ in long], [e for _, e in long]

    def first_number(self, i: int) -> str | None:
        """The first number of two characters or more in an element's text, as far as it lies in it."""
        starts, ends = self.numbers
        at = bisect_right(ends, self.start[i])
        while at < len(starts) and starts[at] < self.stop[i]:
            own = self.buffer[max(starts[at], self.start[i]) : min(ends[at], self.stop[i])].rstrip(".,")
            if len(own) > 1:
                return own
            at += 1
        return None


_COMPOUND = re.compile(r"""([\w-]+)|#([\w-]+)|\.([\w-]+)|\[\s*([\w-]+)\s*(?:(\*?=)\s*(?:"([^"]*)"|'([^']*)'|([^\]\s]+)))?\s*\]""")


@lru_cache(1024)
def selector(text: str) -> tuple[tuple[tuple[str, tuple], ...], str]:
    """((relation to the one before, conditions), ...) of a selector, and the attribute that it takes ('': the text)."""
    m = re.fullmatch(r"""((?:[^@"'\[]|"[^"]*"|'[^']*'|\[[^\]]*\])*)(?:@([\w-]+))?""", text.strip())
    if m is None:
        raise ValueError(f"no selector: {text}")
    out, relation = [], " "
    for part in re.findall(r"""(?:\[[^\]]*\]|[^\s\[])+""", m[1]):
        if part == "+":
            relation = "+"
            continue
        found, at = [], 0
        for c in _COMPOUND.finditer(part):
            if c.start() != at:
                raise ValueError(f"no selector: {text}")
            at = c.end()
            value = next((x for x in c.groups()[5:] if x is not None), "")
            found.append(("tag", c[1].lower()) if c[1] else ("id", c[2]) if c[2] else ("class", c[3]) if c[3] else ("attribute", c[4].lower(), c[5], value))
        if at != len(part):
            raise ValueError(f"no selector: {text}")
        out.append((relation, tuple(found)))
        relation = " "
    return tuple(out), m[2] or ""


def _fitting(page: Page, conditions: tuple) -> list[int]:
    """The elements that fit all conditions of one part of a selector, in page order; the rarest condition is taken first."""
    lists = [page.of(c[0], c[1]) for c in conditions]
    found = min(lists, key=len)
    for c, own in zip(conditions, lists):
        if own is not found:
            there = set(own)
            found = [i for i in found if i in there]
        if c[0] == "attribute" and c[2]:
            value = lambda i: page.attrs[i][c[1]]  # noqa: B023, E731
            found = [i for i in found if (value(i) == c[3] if c[2] == "=" else c[3] in value(i))]
    return found


@lru_cache(1024)
def _needed(text: str) -> tuple[tuple[str, str], ...]:
    """What a page has to have an element of for a selector to fit any; the last part's first."""
    return tuple((c[0], c[1]) for _, conditions in reversed(selector(text)[0]) for c in conditions)


def select(page: Page, text: str) -> list[int]:
    """The elements that a selector fits, in page order: each of its parts is found for the whole page at once."""
    for key in _needed(text):
        if key not in page.index:
            return []
    found: list[int] | None = None
    for relation, conditions in selector(text)[0]:
        own = _fitting(page, conditions)
        if found is None:
            found = own
        elif relation == "+":
            there = set(found)
            found = [i for i in own if page.before[i] in there]
        else:
            found = page.inside(own, found)
    return found or []


def _value(page: Page, i: int, text: str) -> str:
    attribute = selector(text)[1]
    return (page.attrs[i].get(attribute, "") if attribute else page.text(i)).strip()


def first_value(page: Page, selectors: list[str], prefix: str = "") -> str | None:
    """What the first selector gives whose first element is not empty."""
    for text in selectors:
        found = select(page, text)
        if found and (v := _value(page, found[0], text).replace(prefix, "").strip() if prefix else _value(page, found[0], text)):
            return v
    return None


def _texts(page: Page, cls: str) -> list[str]:
    return [t for i in page.of("class", cls) if (t := page.text(i))]


def _is_price(text: str) -> bool:
    return re.fullmatch(r"\$?\d+(\.\d+)?", text.strip()) is not None


def price_grid(page: Page) -> list[tuple[str, int, float, str | None]]:
    """(label, quantity, price, code) of tables whose first row holds quantities and whose rows hold prices."""
    out = []
    tables = page.nearest(page.of("tag", "tr"), page.of("tag", "table"))
    cells_of: dict[int, list[int]] = {}
    for i in sorted([*page.of("tag", "td"), *page.of("tag", "th")]):
        cells_of.setdefault(page.up[i], []).append(i)
    codes = page.children("class", "price-code")
    for rows in tables.values():
        if len(rows) < 2:
            continue
        quantity = {i: int(d) for i, c in enumerate(cells_of.get(rows[0], [])) if i and (d := re.sub(r"\D", "", page.text(c))) and 0 < int(d) < 2**31}
        for row in rows[1:]:
            cells = cells_of.get(row, [])
            if len(cells) < 2 or not any(i in quantity for i in range(len(cells))):
                continue
            label = page.text(cells[0])
            if not label or _is_price(label):
                continue
            for i, cell in enumerate(cells):
                number = page.first_number(cell) if i in quantity else None
                if number is None:
                    continue
                try:
                    price = float(number.replace(",", ""))
                except ValueError:
                    continue
                code = next((page.text(c).strip("()") for c in codes.get(cell, []) if page.tags[c] in ("small", "span")), None)
                out.append((label, quantity[i], price, code))
    return out


def parse_page(page: str | None, spec: dict[str, list[str]] = SPEC, images: list[str] = IMAGES, wanted: frozenset[str] | None = None) -> dict | None:
    """What PARSED names, of one page; None for null. With `wanted`, only those of its names are looked for."""
    if page is None:
        return None
    tree, want = Page(page), lambda name: wanted is None or name in wanted
    out = dict(NOTHING)
    if want("fields") or want("product_number"):
        out["fields"] = {k: v for k, own in spec.items() if (v := first_value(tree, own, PREFIXES.get(k, "")))}
    if want("images"):
        for text in images:
            if found := select(tree, text):
                out["images"] = list(dict.fromkeys(v for i in found if (v := _value(tree, i, text))))
                break
    if want("attributes"):
        own: dict[str, list[str]] = {}
        labels, values = tree.children("class", "label"), tree.children("class", "value")
        for i in tree.of("class", "attribute"):
            label = tree.text(labels[i][0]).rstrip(":") if i in labels else ""
            if label:
                own.setdefault(label, []).extend(t for c in values.get(i, []) if (t := tree.text(c)))
        out["attributes"] = own
    if want("warnings"):
        out["warnings"] = _texts(tree, "warning") + [t for i in select(tree, 'p[ng-repeat*="SWCH"]') if (t := tree.text(i))]
    if want("certifications"):
        out["certifications"] = _texts(tree, "certification") + [t for i in select(tree, 'p[ng-if*="Certifications"]') if (t := tree.text(i))]
    if want("rush"):
        out["rush"] = bool(tree.of("class", "rush-available") or select(tree, 'p[ng-if*="HasRushService"]'))
    if want("supplier_text"):
        out["supplier_text"] = " ".join(_texts(tree, "supplier"))
    if want("supplier_link"):
        links = [i for i in tree.of("tag", "a") if tree.attrs[i].get("href", "").startswith("http")]
        suppliers = tree.of("class", "supplier")
        own, within = set(suppliers), set(tree.inside(links, suppliers))
        out["supplier_link"] = next((tree.attrs[i]["href"] for i in links if i in own or i in within), None)
    if want("related"):
        related, shown = [], tree.of("tag", "img")
        for i in tree.of("class", "related-item"):
            at = bisect_right(shown, i)
            image = tree.attrs[shown[at]].get("src", "") if at < len(shown) and shown[at] < tree.end[i] else ""
            digits = re.search(r"/(\d+)", image)
            related.append({"name": tree.text(i), "image": image, "id": digits[1] if digits else None})
        out["related"] = related
    if want("prices"):
        out["prices"] = [{"label": a, "quantity": q, "price": p, "discount_code": c} for a, q, p, c in price_grid(tree)]
    data = tree.of("attribute", "data-product")
    if want("product_json"):
        out["product_json"] = next((v for i in data if (v := tree.attrs[i]["data-product"])), None)
    if want("product_number"):
        number = next((n[1] for i in data if (n := re.search(r'"[Nn]umber"\s*:\s*"?([\w-]+)', tree.attrs[i]["data-product"]))), None)
        out["product_number"] = out["fields"]["sku"] if number is None and out["fields"].get("sku", "").isdigit() else number
    return out


NAMES = ("fields", "images", "attributes", "warnings", "certifications", "rush", "supplier_text", "supplier_link", "related", "prices", "product_json", "product_number")
NOTHING = {"fields": {}, "images": [], "attributes": {}, "warnings": [], "certifications": [], "rush": False, "supplier_text": "", "related": [], "prices": []}


def parsed(html: Column, spec: dict[str, list[str]] = SPEC, images: list[str] = IMAGES, wanted: frozenset[str] | None = None) -> Column:
    """What PARSED names, as a struct. A page is parsed once, whatever is made of the struct: the function counts as
    nondeterministic, so the optimiser neither repeats it nor moves a filter over it."""
    for own in [*spec.values(), images]:
        for text in own:
            selector(text)  # a bad one fails here

    @F.pandas_udf(PARSED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for pages in batches:
            rows = [parse_page(p, spec, images, wanted) or NOTHING for p in pages]
            yield pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype=bool if n == "rush" else object) for n in NAMES})

    return run.asNondeterministic()(html)


def extract_pages(pages: DataFrame, spec: dict[str, list[str]] = SPEC, images: list[str] = IMAGES, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """keep columns (page_id and url by default) with the typed fields of each page; nulls and empty lists for what a
    page does not have. `spec` names the fields and their selectors, `images` those of the image list."""
    own = pages.select(*(keep or ["page_id", "url"]), html, parsed(F.col(html), spec, images).alias("p"))
    f = F.col("p.fields")
    image = F.transform("p.images", lambda x: clean_image(x))
    return own.select(
        *(keep or ["page_id", "url"]),
        *[f[k].alias(k) for k in spec],
        F.array_distinct(image).alias("images"),
        F.coalesce(F.try_element_at(image, F.lit(1)), F.lit("N/A")).alias("main_image"),
        F.col("p.attributes").alias("attributes"),
        F.col("p.warnings").alias("warnings"),
        F.col("p.certifications").alias("certifications"),
        F.col("p.rush").alias("rush"),
        _found(F.regexp_extract("p.supplier_text", r"asi/(\d+)", 1)).alias("asi_number"),
        F.col("p.supplier_link").alias("supplier_link"),
        F.col("p.related").alias("related"),
        F.col("p.prices").alias("prices"),
        update_date(F.col(html)).alias("update_date"),
        F.col("p.product_json").alias("product_json"),
        F.col("p.product_number").alias("product_number"),
    )


def price_rows(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """keep columns with a row for each price of the page's tables: label, quantity, price, discount_code."""
    own = pages.select(*(keep or ["page_id"]), parsed(F.col(html), {}, [], frozenset({"prices"})).alias("p"))
    return own.select(*(keep or ["page_id"]), F.explode("p.prices").alias("p")).select(*(keep or ["page_id"]), "p.*")


def _found(c: Column) -> Column:
    return F.when(c != "", c)


def first_heading(html: Column) -> Column:
    """Text of the first h1 without inner tags; null if there is none."""
    return _found(F.trim(F.regexp_replace(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1), "<[^>]*>", "")))


def title(html: Column) -> Column:
    return _found(F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)))


def first_link(html: Column) -> Column:
    return _found(F.regexp_extract(html, r"""(?i)<a\s[^>]*href=["']([^"']*)["']""", 1))


def clean_image(url: Column) -> Column:
    """Absolute, and of full size."""
    return F.replace(F.when(url.startswith("//"), F.concat(F.lit("https:"), url)).otherwise(url), F.lit("/400/"), F.lit("/"))


def _exactly(c: Column) -> Column:
    """A column's text as a pattern for itself."""
    return F.concat(F.lit("\\Q"), F.replace(c, F.lit("\\E"), F.lit("")), F.lit("\\E"))


def _pattern(base: str, *parts: str | Column) -> Column:
    return F.concat(_exactly(F.lit(base.rstrip("/"))), *[F.lit(p) if isinstance(p, str) else _exactly(F.coalesce(p, F.lit(""))) for p in parts])


def links(html: Column) -> Column:
    """The targets of a page's links, in order."""
    return F.regexp_extract_all(html, F.lit(r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""), F.lit(1))


def art_template(html: Column, number: Column, base: str) -> Column:
    """URL of the art template of a product: the first of three forms below `base` that holds its number, else the first
    link to a template or download that does, made absolute. Null if there is none, or no number."""
    # The three forms, in order.
    forms = [("/fs/artTemplates/", number, r'/[^"\s]+'), ("/artTemplates/", number, r'/[^"\s]+'), (r'/fs/artTemplates/[^"\s]*', number, r'[^"\s]*')]
    named = [F.regexp_substr(html, _pattern(base, *form)) for form in forms]
    link = F.try_element_at(F.filter(links(html), lambda x: x.contains(number) & (x.contains("artTemplates") | x.contains("download"))), F.lit(1))
    return F.when(number != "", F.coalesce(*named, absolute(link, base)))


def absolute(url: Column, base: str) -> Column:
    host = base.rstrip("/")
    return F.when(url.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), url).when(url.startswith("//"), F.concat(F.lit(host.split("//")[0]), url)).when(url.startswith("/"), F.concat(F.lit(host), url)).otherwise(F.concat(F.lit(host + "/"), url))


def color_images(html: Column, number: Column, colors: Column, base: str, most: int = 5) -> Column:
    """array<struct<color, color_code, vendor_code, sku, images>>: for each of colors (array<struct<Name, VendorCode, SKU, Code>>)
    with a vendor code or SKU the images below `base` that are named by it, distinct, `most` at most (the field's size);
    colors without images are left out."""
    host = re.sub(r"^\w+://(www\.)?", "", base.rstrip("/"))

    def of(c: Column) -> Column:
        own, name = F.coalesce(_found(c["VendorCode"]), _found(c["SKU"])), F.coalesce(c["Name"], F.lit(""))
        # How images are named, in order.
        forms = [
            ("/imageManager/show/", number, "_", own, "_"), ("/imageManager/show/", own, "_"), ("/imageManager/show/", number, "_", name, "_"),
            ("/fs/images/", number, "_", own, "_"), ("/fs/images/", own, "_"),
        ]
        named = [F.regexp_extract_all(html, _pattern(base, *form, r'[^"\s]+\.(jpg|png)'), F.lit(0)) for form in forms]
        shown = F.filter(F.regexp_extract_all(html, F.lit(r'<img[^>]+src="([^"]*)"[^>]*>'), F.lit(1)), lambda x: x.contains(host) & (x.contains(own) | F.lower(x).contains(F.lower(name))))
        images = F.when(own.isNull() | html.isNull(), F.array().cast("array<string>")).otherwise(F.slice(F.array_distinct(F.concat(*named, shown)), 1, most))
        return F.struct(name.alias("color"), c["Code"].alias("color_code"), c["VendorCode"].alias("vendor_code"), c["SKU"].alias("sku"), images.alias("images"))

    return F.filter(F.transform(colors, of), lambda x: F.size(x["images"]) > 0)


def update_date(html: Column) -> Column:
    return _found(F.trim(F.regexp_extract(html, r"(?i)Last updated:\s*([^<]+)", 1)))


def embedded_json(html: Column) -> Column:
    """The JSON in the attribute data-product, with its quotes decoded; null if it is none."""
    raw = F.regexp_extract(html, r"""data-product=(?:'([^']*)'|"([^"]*)")""", 1)
    other = F.regexp_extract(html, r"""data-product=(?:'([^']*)'|"([^"]*)")""", 2)
    text = F.replace(F.when(raw != "", raw).otherwise(other), F.lit("&quot;"), F.lit('"'))
    return F.to_json(F.try_parse_json(_found(text)))
