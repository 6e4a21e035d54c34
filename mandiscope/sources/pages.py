"""Landed HTML pages to records.

A page is parsed once per row inside ``mapInPandas``; which elements make a field is given as a
selector table, so a new site is new rows of that table and no new code.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from mandiscope.session import spread

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSHOWN = {"script", "style", "template"}


class Selector(NamedTuple):
    """Where a field lives: the first element of a tag whose class matches, or all of them with ``many``.

    ``attribute`` takes an attribute instead of the text. ``having`` is an attribute and a pattern that it must match,
    ``text`` a pattern that the element's text must match. Without a tag a field is found by its text: the first piece
    of text that matches ``text`` counts, and the element that holds it. ``take`` says what is taken: the text of the
    ``element``, of its ``parent``, or the ``piece`` alone. Several selectors of one field are tried in order; with
    ``many`` their matches are listed together, in the order of the page.
    """

    field: str
    tag: str | None
    css_class: str | None = None
    attribute: str | None = None
    having: tuple[str, str] | None = None
    text: str | None = None
    take: str = "element"
    many: bool = False


class _Element:
    __slots__ = ("tag", "attributes", "children", "texts", "parent")

    def __init__(self, tag, attributes, parent):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children, self.texts = [], []

    def nodes(self) -> Iterator[tuple[_Element | str, _Element]]:
        """Elements and pieces of text below, in the order of the page, each with the element that holds it."""
        stack = [(child, self) for child in reversed(self.children)]
        while stack:
            node, holder = stack.pop()
            yield node, holder
            if isinstance(node, _Element):
                stack.extend((child, node) for child in reversed(node.children))

    def walk(self) -> Iterator[_Element]:
        return (node for node, _ in self.nodes() if isinstance(node, _Element))

    def text(self) -> str:
        out, stack = [], list(reversed(self.children))
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node.strip())
            elif node.tag not in UNSHOWN:
                stack.extend(reversed(node.children))
        return "".join(out)

    def matches(self, tag: str, css_class: re.Pattern | None) -> bool:
        if self.tag != tag:
            return False
        return css_class is None or bool(css_class.search(self.attributes.get("class") or ""))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.top = _Element("", {}, None)

    def handle_starttag(self, tag, attrs):
        element = _Element(tag, dict(attrs), self.top)
        self.top.children.append(element)
        if tag not in VOID:
            self.top = element

    def handle_startendtag(self, tag, attrs):
        self.top.children.append(_Element(tag, dict(attrs), self.top))

    def handle_endtag(self, tag):
        node = self.top
        while node is not self.root and node.tag != tag:
            node = node.parent
        if node is not self.root:
            self.top = node.parent

    def handle_data(self, data):
        self.top.children.append(data)


def _tree(html: str | None) -> _Element:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


class _Rule:
    """A selector with its patterns compiled, once per task."""

    def __init__(self, selector: Selector):
        self.selector = selector
        self.css = re.compile(selector.css_class) if selector.css_class else None
        self.having = re.compile(selector.having[1]) if selector.having else None
        self.pattern = re.compile(selector.text) if selector.text else None

    def matches(self, node: _Element | str, holder: _Element) -> bool:
        s = self.selector
        if isinstance(node, str):
            return s.tag is None and holder.tag not in UNSHOWN and bool(self.pattern.search(node))
        if s.tag is None or not node.matches(s.tag, self.css):
            return False
        if self.having and not self.having.search(node.attributes.get(s.having[0]) or ""):
            return False
        return self.pattern is None or bool(self.pattern.search(node.text()))

    def taken(self, node: _Element | str, holder: _Element) -> str | None:
        s = self.selector
        if isinstance(node, str):
            return node.strip() if s.take == "piece" else holder.text()
        if s.attribute:
            return node.attributes.get(s.attribute)
        return (holder if s.take == "parent" else node).text()


def _fields(scope: _Element, rules: Sequence[_Rule]) -> dict[str, str | list[str] | None]:
    out = {r.selector.field: [] if r.selector.many else None for r in rules}
    best: dict[str, int] = {}
    for node, holder in scope.nodes():
        for rank, rule in enumerate(rules):
            field = rule.selector.field
            if rule.selector.many:
                if rule.matches(node, holder):
                    out[field].append(rule.taken(node, holder))
            elif rank < best.get(field, len(rules)) and rule.matches(node, holder):
                best[field] = rank
                out[field] = rule.taken(node, holder)
    return out


def _typed(selectors: Sequence[Selector]) -> list[T.StructField]:
    kinds = {s.field: T.ArrayType(T.StringType()) if s.many else T.StringType() for s in selectors}
    return [T.StructField(name, kind) for name, kind in kinds.items()]


def extract_cards(
    pages: DataFrame,
    fields: Sequence[Selector],
    card_tag: str = "div",
    card_class: str | None = None,
    key: str = "page_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per card of a page: the key, columns to ``keep``, the card's position, its whole text and the fields."""
    carried = [key, *keep]
    found = [T.StructField("pos", T.IntegerType()), T.StructField("card_text", T.StringType()), *_typed(fields)]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = [_Rule(s) for s in fields]
        css = re.compile(card_class) if card_class else None
        for batch in batches:
            at, rows = [], []
            for page, html in enumerate(batch.column("html").to_pylist()):
                cards = (e for e in _tree(html).walk() if e.matches(card_tag, css))
                for pos, card in enumerate(cards):
                    at.append(page)
                    rows.append({"pos": pos, "card_text": card.text()} | _fields(card, rules))
            yield _beside(batch.select(carried), at, rows, found)

    schema = T.StructType([*(pages.schema[c] for c in carried), *found])
    return spread(pages.select(*carried, "html")).mapInArrow(parse, schema)


def _beside(carried: pa.RecordBatch, at: list[int], rows: list[dict], fields: Sequence[T.StructField]) -> pa.RecordBatch:
    """``rows`` beside the carried values of the pages ``at``, which stay in Arrow, so ids keep all digits beside nulls."""
    kept = carried.take(pa.array(at, pa.int64()))
    made = pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(T.StructType(list(fields))))
    return pa.RecordBatch.from_arrays([*kept.columns, *made.columns], [*kept.schema.names, *made.schema.names])


def extract_detail(
    pages: DataFrame, fields: Sequence[Selector], key: str = "page_id", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per page: the key, columns to ``keep`` and the fields."""
    carried = [key, *keep]
    found = _typed(fields)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = [_Rule(s) for s in fields]
        for batch in batches:
            rows = [_fields(_tree(html), rules) for html in batch.column("html").to_pylist()]
            yield _beside(batch.select(carried), list(range(len(rows))), rows, found)

    schema = T.StructType([*(pages.schema[c] for c in carried), *found])
    return spread(pages.select(*carried, "html")).mapInArrow(parse, schema)


def extract_with(
    pages: DataFrame, extractor: Callable[[str, str], dict], schema: T.StructType, url: str = "url"
) -> DataFrame:
    """Run a caller's ``extractor(html, url) -> dict`` over pages; failures become an ``error`` text."""
    full = T.StructType([*schema.fields, T.StructField("error", T.StringType())])
    names = full.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for html, address in zip(batch["html"], batch[url]):
                try:
                    record = extractor(html, address)
                    rows.append({n: record.get(n) for n in names})
                except Exception as failure:  # a caller's code may raise anything
                    rows.append({"error": str(failure)})
            yield pd.DataFrame(rows, columns=names, dtype=object)

    return spread(pages.select("html", url)).mapInPandas(run, full)


# Selectors of the supported sites. A site is a name, how its cards look and its fields.
CARD_SITES: dict[str, tuple[str, str, list[Selector]]] = {
    "tradeindia": (
        "div",
        "product|item|result",
        [
            Selector("name", "a", "title|name|product-name"),
            Selector("href", "a", "title|name|product-name", "href"),
            Selector("price_raw", "span", "price|amount|cost"),
        ],
    ),
    "indiamart": (
        "div",
        "card|product",
        [
            Selector("name", "a", "title|name"),
            Selector("href", "a", "title|name", "href"),
            Selector("price_raw", "span", "price"),
        ],
    ),
    "tradeindia_search": (
        "div",
        "fullwidthcard",
        [
            Selector("name", "h2", "card_title"),
            Selector("heading", "h2"),
            Selector("href", "a", None, "href", having=("href", "/products/")),
            Selector("supplier_name", "span", "anchor-wrapper"),
            Selector("texts", "p", many=True),
            Selector("texts", "span", many=True),
            Selector("price_raw", "div", "price"),
            Selector("moq_raw", "p", text="MOQ"),
            Selector("specs", "p", "wordbreak", many=True),
        ],
    ),
}
# Fields found by a label or a word in the text.
FOUND_BY_TEXT = [
    Selector("moq_raw", None, text="(?i)MOQ|Minimum Order"),
    Selector("unit", None, text="(?i)Unit|Packaging"),
    Selector("response_rate", None, text="(?i)Response Rate"),
    Selector("badge", None, text="(?i)Verified|Trusted", take="piece"),
]
CITIES_IN_TEXT = "Mumbai|Delhi|Bangalore|Chennai|Hyderabad|Pune|Kolkata|Ahmedabad|Jaipur|Surat|Lucknow|Indore"
# Selectors of the detail pages by site.
DETAIL_SITES: dict[str, list[Selector]] = {
    "tradeindia": [
        Selector("name", "h1"),
        Selector("name", "div", "product-name|title"),
        Selector("price_raw", "span", "price|amount"),
        Selector("supplier_name", "a", "supplier|company|seller"),
        Selector("supplier_location_raw", "span", "location|city|address"),
        Selector("description", "div", "description|about|details"),
        Selector("certifications_raw", "div", "certification|badge|approval"),
        Selector("supplier_rating", "span", "rating|score"),
        *FOUND_BY_TEXT,
    ],
    "indiamart": [
        Selector("name", "h1"),
        Selector("name", "div", "product-name|title"),
        Selector("price_raw", "span", "price|amount"),
        Selector("supplier_name", "a", "supplier|company"),
        Selector("supplier_location_raw", "span", "location|city"),
        Selector("description", "div", "description|about"),
        Selector("certifications_raw", "div", "certification|badge"),
    ],
    "tradeindia_search": [
        Selector("price_raw", "span", "price"),
        Selector("supplier_rating", "span", "rating"),
        Selector("supplier_location_raw", "span", "city", take="parent"),
        Selector("supplier_location_raw", None, text=CITIES_IN_TEXT, take="piece"),
        Selector("description", "div", "description"),
    ],
}


# Addresses that relative links of a site start from.
SITE_ROOTS = {
    "tradeindia": "https://www.tradeindia.com",
    "indiamart": "https://www.indiamart.com",
    "tradeindia_search": "https://www.tradeindia.com",
}


def site_cards(pages: DataFrame, site: str, key: str = "page_id", keep: Sequence[str] = ()) -> DataFrame:
    tag, css, fields = CARD_SITES[site]
    return extract_cards(pages, fields, tag, css, key, keep)


def site_detail(pages: DataFrame, site: str, key: str = "page_id", keep: Sequence[str] = ()) -> DataFrame:
    return extract_detail(pages, DETAIL_SITES[site], key, keep)
