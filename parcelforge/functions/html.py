"""Fields out of captured pages: text of elements, cards, definition lists, icons."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .selectors import Page

YES_NO_UNKNOWN = ("Yes", "No", "Unknown")


def texts_of(html: str, css: str, sep: str = " ") -> list[str]:
    page = Page(html or "")
    return [page.text(e, sep) for e in page.select(css)]


def select_texts(html: Column, css: str) -> Column:
    """The texts of all elements that a selector names (see ``selectors``), nested ones too; null html gives an empty array."""

    @F.pandas_udf("array<string>")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: texts_of(page or "", css))

    return run(html)


def select_text(html: Column, css: str) -> Column:
    """The text of the first such element, ``''`` where there is none."""
    return F.coalesce(F.get(select_texts(html, css), 0), F.lit(""))


def _paired(kinds: list[bool], texts: list[str]) -> list[dict]:
    """Titles with the first value that follows each before the next title."""
    out: list[dict] = []
    for title_here, text in zip(kinds, texts, strict=True):
        if title_here:
            out.append({"key": text, "value": None})
        elif out and out[-1]["value"] is None:
            out[-1]["value"] = text
    return out


def fields_of(html: str, selectors: list[str], pair: tuple[str, str] | None = None) -> tuple[list[list[str]], list[dict]]:
    """The texts of the elements of each selector, and title-value pairs, from one reading of the page."""
    page = Page(html or "")
    own = [[page.text(e) for e in page.select(css)] for css in selectors]
    titles, values = (set(page.select(css)) for css in pair) if pair else (set(), set())
    told = sorted(titles | values)
    return own, _paired([e in titles for e in told], [page.text(e) for e in told])


def fields(html: Column, selectors: dict[str, str], pair: tuple[str, str] | None = None) -> Column:
    """Struct of ``name: texts`` for each selector, and ``pairs`` of titles and values; each page is read once."""
    kind = ",".join([*(f"`{n}`:array<string>" for n in selectors), "pairs:array<struct<key:string,value:string>>"])

    @F.pandas_udf(f"struct<{kind}>")
    def run(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for page in pages:
            own, pairs = fields_of(page or "", list(selectors.values()), pair)
            rows.append((*own, pairs))
        return pd.DataFrame(rows, columns=[*selectors, "pairs"])

    return run(html)


# What else parts lines, which markup shows as spaces.
_SPACES = dict.fromkeys((0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x85, 0x2028, 0x2029), " ")


def elements_of(html: str, css: str) -> list[str]:
    """The markup of the outermost elements that a selector names; one that isn't closed goes to where its parent ends."""
    page = Page((html or "").translate(_SPACES))
    return [page.markup(e) for e in page.outermost(page.select(css))]


def elements(html: Column, css: str) -> Column:
    """Array of the markup of such elements, such as the cards of a listing page; null html gives an empty array."""

    @F.pandas_udf("array<string>")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: elements_of(page or "", css))

    return run(html)


def pair_texts(html: str, title: str, value: str) -> list[dict]:
    """Titles and values of a list: each title with the first value that follows before the next title."""
    return fields_of(html, [], (title, value))[1]


def definition_list(html: Column, title: str, value: str) -> Column:
    """Array of ``struct(key, value)`` from elements for titles and for values."""

    @F.pandas_udf("array<struct<key:string,value:string>>")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: pair_texts(page or "", title, value))

    return run(html)


def blocks_of(page: Page, block: str, title: str, values: tuple[str, ...], container: str | None = None) -> list[dict]:
    out = []
    titles, options, blocks = page.select(title), [page.select(v) for v in values], page.select(block)
    if container:
        blocks = [x for e in page.select(container)[:1] for x in page.within(e, blocks)]
    for e in blocks:
        t = page.within(e, titles)[:1]
        v = next((found[:1] for found in (page.within(e, x) for x in options) if found), [])
        if t and v:
            out.append({"key": page.text(t[0]), "value": page.text(v[0])})
    return out


def block_lists(html: Column, lists: dict[str, tuple[str, str, tuple[str, ...], str | None]], texts: dict[str, str] | None = None) -> Column:
    """Struct of several lists of blocks (``name: (block, title, values, container)``, see ``block_list``) and of texts (``name:
    selector``, see ``select_text``), from one reading of each page."""
    firsts = texts or {}
    kind = ",".join([*(f"`{n}`:array<struct<key:string,value:string>>" for n in lists), *(f"`{n}`:string" for n in firsts)])

    @F.pandas_udf(f"struct<{kind}>")
    def run(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for markup in pages:
            page = Page(markup or "")
            rows.append([*(blocks_of(page, *x) for x in lists.values()), *(next((page.text(e) for e in page.select(css)), "") for css in firsts.values())])
        return pd.DataFrame(rows, columns=[*lists, *firsts])

    return run(html)


def block_list(html: Column, block: str, title: str, *values: str, container: str | None = None) -> Column:
    """Array of ``struct(key, value)``: of each block, in the first ``container`` if one is named, the first title in it and the first
    value, of the first of the value selectors that names any. Blocks without a title or a value are passed over."""
    return block_lists(html, {"blocks": (block, title, values, container)})["blocks"]


# The fields of an estate's card, by selector within the card, and the sibling after a label.
CARD_TEXTS = {"Name": "div.main-text", "Address": "div.address.f-middle"}
CARD_LABELS = {"Blocks": "No. of Block(s)", "Units": "No. of Units", "UnitRate": "Unit Rate of Saleable Area", "MoM": "MoM", "ForSale": "For Sale", "ForRent": "For Rent"}
ESTATE_CARD = CARD_TEXTS | {n: f"div:contains('{label}') + div" for n, label in CARD_LABELS.items()}


def cards_of(html: str, item: str, fields: dict[str, str], attrs: dict[str, str]) -> list[tuple]:
    page = Page(html or "")
    found = {css: page.select(css) for css in set(fields.values())}
    text = lambda e, css: next((page.text(x, "") for x in page.within(e, found[css])), "")
    return [(*(text(e, css) for css in fields.values()), *(page.attrs[e].get(a) for a in attrs.values())) for e in page.select(item)]


def cards(html: Column, item: str, fields: dict[str, str], attrs: dict[str, str] | None = None) -> Column:
    """Array of structs, one for each element that ``item`` names: for each of ``fields`` the text of the first element in it
    that its selector names (``''`` without one), for each of ``attrs`` an attribute of the item itself (null without)."""
    given = attrs or {}
    kind = ",".join(f"`{n}`:string" for n in (*fields, *given))
    names = [*fields, *given]

    @F.pandas_udf(f"array<struct<{kind}>>")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: [dict(zip(names, row, strict=True)) for row in cards_of(page, item, fields, given)])

    return run(html)


def estate_cards(pages: DataFrame, html: str, item: str, context: list[str], now: Column | None = None) -> DataFrame:
    """The 14 fields of every estate's card of captured listing pages: ``ESTATE_CARD``, Link, the context columns
    (Region, District, Subdistrict, Code) and LastScraped."""
    told = pages.select(*context, F.explode(cards(F.col(html), item, ESTATE_CARD, {"Link": "href"})).alias("card"))
    return told.select("card.*", *context, F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd HH:mm:ss").alias("LastScraped"))


def card_fields(html: Column, labels: dict[str, str], label_css: str = "div", texts: dict[str, str] | None = None) -> Column:
    """Struct of fields of a card: for each ``name: label`` the text of the element right after one that has the label in its
    text, null where there is none; for each ``name: selector`` of ``texts`` the first such element's (see ``select_text``)."""
    firsts = texts or {}
    kind = ",".join(f"`{n}`:string" for n in (*labels, *firsts))
    selectors = {n: f"{label_css}:contains('{label}') + {label_css}" for n, label in labels.items()}

    @F.pandas_udf(f"struct<{kind}>")
    def run(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for markup in pages:
            page = Page(markup or "")
            found = [next((page.text(e, "") for e in page.select(css)), None) for css in selectors.values()]
            rows.append([*found, *(next((page.text(e) for e in page.select(css)), "") for css in firsts.values())])
        return pd.DataFrame(rows, columns=[*labels, *firsts])

    return run(html)


def icon_meaning(icon: Column, yes: str, no: str) -> Column:
    """Yes or No by what the icon's data holds, else Unknown."""
    return F.when(F.contains(icon, F.lit(yes)), YES_NO_UNKNOWN[0]).when(F.contains(icon, F.lit(no)), YES_NO_UNKNOWN[1]).otherwise(YES_NO_UNKNOWN[2])


def content_or_icon(content: Column, icon: Column, missing: str = "N/A") -> Column:
    """The content, else the icon's meaning, else ``missing``; empty texts count as missing."""
    return F.coalesce(F.nullif(content, F.lit("")), F.nullif(icon, F.lit("")), F.lit(missing))


def tag_text(html: Column, tag: str) -> Column:
    """The text between the first start and end tag of a kind, by pattern; null where there is none."""
    return F.nullif(F.regexp_extract(html, rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1), F.lit(""))
