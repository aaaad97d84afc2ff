"""Stored JSON responses and HTML pages."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# One page of the vacancy API. A field an item lacks is read as null.
VACANCY_PAGE = (
    "struct<items: array<struct<id: string, name: string, area: struct<id: string>, "
    "employer: struct<id: string, name: string>, "
    "salary: struct<`from`: bigint, `to`: bigint, gross: boolean>, published_at: string, "
    "type: struct<id: string>, snippet: struct<requirement: string>>>, pages: int>"
)
AREA_TREE = "array<struct<id: string, name: string, areas: array<struct<id: string, name: string>>>>"


def json_items(df: DataFrame, json: str, schema: str, items: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of an array inside a JSON text, as struct ``item``."""
    page = F.from_json(F.col(json), schema)
    return df.select(*keep, F.explode(page[items]).alias("item"))


def unread_pages(df: DataFrame, json: str, schema: str, items: str, keep: Sequence[str]) -> DataFrame:
    """Pages of which ``json_items`` gets nothing because they are no JSON or have no list of items.

    A page with an empty list is not among them.
    """
    page = F.from_json(F.col(json), schema)
    return df.filter(page[items].isNull()).select(*keep, F.length(json).alias("page_length"))


def json_tree_ids(df: DataFrame, json: str, keep: Sequence[str] = ()) -> DataFrame:
    """Ids of the areas below the first country of an area tree."""
    tree = F.from_json(F.col(json), AREA_TREE)
    areas = F.get(tree, F.lit(0))["areas"]
    return df.select(*keep, F.explode(areas["id"]).alias("_id")).select(
        *keep, F.col("_id").cast("int").alias("area_id")
    )


def plain_text(markup: Column) -> Column:
    """Text of a short piece of markup: tags removed, the named entities decoded."""
    text = F.regexp_replace(markup, r"<[^>]*>", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", "\u00a0"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def html_links(df: DataFrame, html: str, keep: Sequence[str]) -> DataFrame:
    """Every link of a page as ``(link_no, href, label)``, found in one pass over the markup."""
    anchor = r"""(?s)<a\s[^>]*?href\s*=\s*(?:"[^"]*"|'[^']*')[^>]*>.*?</a>"""
    found = F.regexp_extract_all(F.col(html), F.lit(anchor), F.lit(0))
    links = df.select(*keep, F.posexplode(found).alias("link_no", "_link"))
    quoted = r"""href\s*=\s*(?:"([^"]*)"|'([^']*)')"""
    href = F.concat(F.regexp_extract("_link", quoted, 1), F.regexp_extract("_link", quoted, 2))
    return links.select(*keep, "link_no", href.alias("href"), plain_text(F.col("_link")).alias("label"))


def _span(css: str) -> str:
    """Pattern of a span whose class begins so; its second group is the markup inside, nested spans included."""
    inner = r"(?:(?!</?span)[\s\S])*"
    nested = rf"{inner}(?:<span[^>]*>{inner}</span>{inner})*"
    return rf"""<span[^>]*class\s*=\s*(["']){css}[^"']*["'][^>]*>({nested})</span>"""


def page_count(html: Column, pager: str, counter: str, full: int = 100, least: int = 4000) -> Column:
    """Largest number among the pager labels, 0 when there is none.

    A pager that ends exactly at ``full`` is trusted only if the page announces at least ``least``
    results. ``pager`` and ``counter`` are prefixes of the class of the spans to read.
    """
    # a label is the text of the span, tags inside it left out
    labels = F.regexp_extract_all(html, F.lit(_span(pager)), F.lit(2))
    labels = F.transform(labels, plain_text)
    pages = F.coalesce(F.array_max(F.transform(labels, lambda x: F.trim(x).try_cast("int"))), F.lit(0))
    shown = plain_text(F.regexp_extract(html, _span(counter), 2))
    results = F.regexp_replace(shown, r"(?U)\s", "").try_cast("int")
    return F.when((pages == full) & (results < least), F.lit(0)).otherwise(pages)


@dataclass(frozen=True)
class CardMarkup:
    """Where a card and its fields are found: class prefixes, tags and attributes."""

    card_class: str
    description_class: str
    employer_marker: str
    title_tag: str = "h3"
    card_tag: str = "div"


VOID_TAGS = frozenset(
    ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
)


# An ampersand that opens no complete character reference stands for itself.
BARE_AMPERSAND = re.compile(r"&(?!(?:[A-Za-z][A-Za-z0-9]*|#[0-9]+|#[xX][0-9A-Fa-f]+);)")


class _Cards(HTMLParser):
    """Collects the first link, title, description, price and employer of each card."""

    def __init__(self, markup: CardMarkup):
        super().__init__(convert_charrefs=True)
        self.markup = markup
        self.cards: list[dict] = []
        self.open: list[tuple[str, str | None]] = []  # (tag, field whose text it holds)

    def handle_starttag(self, tag, attrs):
        attr = dict(attrs)
        css = attr.get("class") or ""
        if not self.open:
            if tag == self.markup.card_tag and css.startswith(self.markup.card_class):
                self.cards.append({})
                self.open.append((tag, None))
            return
        card, field = self.cards[-1], None
        if tag == "a":
            card.setdefault("href", attr.get("href"))
        if tag == "meta" and attr.get("itemprop") == "price":
            card.setdefault("price", attr.get("content"))
        if tag == self.markup.title_tag and "title" not in card:
            field = "title"
        elif tag == "div" and self.markup.description_class in css and "description" not in card:
            field = "description"
        elif attr.get("data-marker") == self.markup.employer_marker and "employer" not in card:
            field = "employer"
        if field:
            card[field] = ""
        if tag not in VOID_TAGS:
            self.open.append((tag, field))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.open and tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if any(name == tag for name, _ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        for _, field in self.open:
            if field:
                self.cards[-1][field] += data


CARD_FIELDS = ("href", "title", "description", "price", "employer")


def html_cards(df: DataFrame, html: str, keep: Sequence[str], markup: CardMarkup) -> DataFrame:
    """Cards of a page as ``(card_no, href, title, description, price, employer)``.

    Cards nest tags freely and pages hold scripts and comments that look like markup, so whole
    pages go through an HTML parser, in Arrow batches. Extract once and store the cards.
    """
    source = df.select(*keep, html)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema)
    schema = f"{kept}, card_no int, " + ", ".join(f"{f} string" for f in CARD_FIELDS)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for *ids, page in batch.itertuples(index=False, name=None):
                parser = _Cards(markup)
                parser.feed(BARE_AMPERSAND.sub("&amp;", page or ""))
                parser.close()
                for number, card in enumerate(parser.cards):
                    out.append((*ids, number, *[card.get(f) for f in CARD_FIELDS]))
            yield pd.DataFrame(out, columns=[*keep, "card_no", *CARD_FIELDS])

    return source.mapInPandas(parse, schema)
