"""Review pages (url, html) turned into city rows and review rows.

One Arrow-batched pass reads the markup; every rule on the extracted texts is a column expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoledger import constants as C
from geoledger.functions.codes import (
    city_code,
    department_of,
    is_city_url,
    review_count,
    score_field,
    score_text,
    url_class,
)
from geoledger.functions.numbers import struct_of
from geoledger.sources.scratch import materialise

#: Pages whose extracts are handed on together.
PAGES_AT_ONCE = 128
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

RAW = (
    "url string, h1_html string, h1_text string, total string, total_reviews string, "
    "ratings array<struct<label:string,value:string>>, "
    "comments array<struct<review_id:string,author:string,score:string,scores:array<string>,"
    "review_date:string,description:string,up:string,down:string>>"
)


class _Node:
    def __init__(self, tag: str, attrs: dict[str, str], parent: _Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.parts: list[_Node | str] = []

    def __iter__(self) -> Iterator[_Node]:
        """Elements below this one in document order."""
        return (part for part, closing in self._walk() if isinstance(part, _Node) and not closing)

    def _walk(self) -> Iterator[tuple[_Node | str, bool]]:
        """Parts below this one in document order, elements again when they close; pages can be nested thousands deep."""
        waiting: list[tuple[_Node | str, bool]] = [(part, False) for part in reversed(self.parts)]
        while waiting:
            part, closing = waiting.pop()
            yield part, closing
            if isinstance(part, _Node) and not closing:
                waiting.append((part, True))
                waiting.extend((below, False) for below in reversed(part.parts))

    def let_go(self) -> None:
        """Take the tree apart: parents and parts refer to each other, and a worker would hold many pages until its next full collection."""
        for node in [self, *self]:
            node.parent, node.parts = None, []

    def text(self) -> str:
        return "".join(part for part, _ in self._walk() if isinstance(part, str))

    def html(self) -> str:
        inner = (part if isinstance(part, str) else f"</{part.tag}>" if closing else f"<{part.tag}>" for part, closing in self._walk())
        return f"<{self.tag}>{''.join(inner)}</{self.tag}>"

    def inside(self, tag: str, css: str | None = None) -> bool:
        node = self.parent
        while node is not None:
            if node.tag == tag and (css is None or node.has(css)):
                return True
            node = node.parent
        return False

    def has(self, css: str) -> bool:
        return css in (self.attrs.get("class") or "").split()

    def all(self, tag: str, css: str | None = None) -> Iterator[_Node]:
        return (node for node in self if node.tag == tag and (css is None or node.has(css)))

    def first(self, tag: str, css: str | None = None) -> _Node | None:
        return next(self.all(tag, css), None)


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.top = _Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = _Node(tag, dict(attrs), self.top)
        self.top.parts.append(node)
        if tag not in _VOID:
            self.top = node

    def handle_endtag(self, tag: str) -> None:
        node = self.top
        while node is not self.root and node.tag != tag:
            node = node.parent
        if node is not self.root:
            self.top = node.parent

    def handle_data(self, data: str) -> None:
        self.top.parts.append(data)


def _text(node: _Node | None) -> str | None:
    return None if node is None else node.text().strip()


def _vote(comment: _Node, side: str) -> str | None:
    boxes = (box for box in comment.all("div", "pouce") if box.attrs.get("data-pouce") == side)
    return _text(next((span for box in boxes for span in box.all("span")), None))


def _comment(node: _Node) -> dict:
    return {
        "review_id": node.attrs.get("data-pouce") or "",
        "author": _text(node.first("div", "auteur")),
        "score": _text(node.first("span", "note_total")),
        "scores": [_text(span) for box in node.all("div", "notes") for span in box.all("span")],
        "review_date": _text(node.first("div", "date")),
        "description": _text(node.first("p", "description")),
        "up": _vote(node, "1"),
        "down": _vote(node, "0"),
    }


def _rating(row: _Node) -> dict | None:
    cell = row.first("td")
    value = next((span for span in row.all("span") if span.inside("td")), None)
    return {"label": _text(cell), "value": _text(value)} if cell and value else None


def _extract(url: str, html: str) -> dict:
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    page = reader.root
    title = page.first("h1")
    ratings = [_rating(row) for row in page.all("tr") if row.inside("table", "bloc_chiffre")]
    comments = [
        _comment(node) for node in page.all("div", "commentaire") if not node.has("reponse") and not node.has("bdmv")
    ]
    found = {
        "url": url,
        "h1_html": None if title is None else title.html(),
        "h1_text": _text(title),
        "total": _text(page.first("div", "total")),
        "total_reviews": None if (n := page.first("div", "nbtotal")) is None else n.text(),
        "ratings": [rating for rating in ratings if rating],
        "comments": comments,
    }
    page.let_go()
    return found


def _read_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), PAGES_AT_ONCE):
            some = batch.iloc[at : at + PAGES_AT_ONCE]
            yield pd.DataFrame([_extract(url, html) for url, html in zip(some["url"], some["html"])])


def raw_pages(pages: DataFrame) -> DataFrame:
    """Texts of interest of each page, untouched by any rule."""
    return pages.select("url", "html").mapInPandas(_read_batches, RAW)


# --- rules on extracted texts -------------------------------------------------------------------


def heading_fields(h1_html: Column, h1_text: Column) -> tuple[Column, Column]:
    """City name and postal code of a page heading."""
    name = F.regexp_replace(h1_text, r"\s*<small>.*?</small>\s*", "")
    return name, F.regexp_extract(h1_html, r"<small>(\d+)</small>", 1)


def _rating_of(label: Column, value: Column) -> tuple[Column, Column]:
    """Category and number of a rating line; null where unreadable."""
    return score_field(label), F.trim(value).try_cast("double")


def pivot_scores(ratings: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, value) rows as one column per category; the last readable value of a label wins."""
    field, value = _rating_of(F.col("label"), F.col("value"))
    known = ratings.select(*keys, "position", field.alias("field"), value.alias("value")).where(
        F.col("field").isNotNull() & F.col("value").isNotNull()
    )
    last = {name: F.when(F.col("field") == name, F.struct("position", "value")) for name in C.CATEGORIES}
    return known.groupBy(*keys).agg(*[F.max(col)["value"].alias(name) for name, col in last.items()])


def _category(name: str) -> Column:
    """The same rule inside a row, on its array of ratings."""

    def of(r: Column) -> Column:
        field, value = _rating_of(r["label"], r["value"])
        return F.when(field == name, value)

    values = F.filter(F.transform("ratings", of), lambda value: value.isNotNull())
    return F.coalesce(F.try_element_at(values, F.lit(-1)), F.lit(0.0))


def city_rows(raw: DataFrame) -> DataFrame:
    """One city row per page that has a heading, absent values at their defaults."""
    name, postal = heading_fields(F.col("h1_html"), F.col("h1_text"))
    code = city_code(F.col("url"))
    scores = {"mean": score_text(F.col("total"))} | {c: _category(c) for c in C.CATEGORIES}
    return raw.where(F.col("h1_text").isNotNull()).select(
        code.alias("city_id"),
        name.alias("name"),
        postal.alias("postal_code"),
        code.alias("insee_code"),
        department_of(code).alias("department_id"),
        "url",
        struct_of(scores).alias("scores"),
        review_count(F.col("total_reviews")).alias("review_count"),
        F.lit("unprocessed").alias("status"),
    )


def review_rows(raw: DataFrame) -> DataFrame:
    """Reviews of each page; a review with an unreadable number is left out."""
    c = F.col("comment")

    def number(col: Column, kind: str = "double") -> Column:
        return F.coalesce(F.trim(col).try_cast(kind), F.lit(0).cast(kind))

    def unreadable(col: Column, kind: str = "double") -> Column:
        return col.isNotNull() & F.trim(col).try_cast(kind).isNull()

    parts = [F.get(c["scores"], F.lit(i)) for i in range(len(C.CATEGORIES))]
    broken = unreadable(c["score"]) | unreadable(c["up"], "bigint") | unreadable(c["down"], "bigint")
    for part in parts:
        broken = broken | unreadable(part)
    rows = raw.select("url", F.explode("comments").alias("comment")).where(~broken)
    scores = {name: number(part) for name, part in zip(C.CATEGORIES, parts)}
    return rows.select(
        c["review_id"].alias("review_id"),
        city_code(F.col("url")).alias("city_id"),
        F.split("url", r"\?")[0].alias("url"),
        F.coalesce(c["author"], F.lit(C.ANONYMOUS)).alias("author"),
        F.coalesce(c["review_date"], F.lit("")).alias("review_date"),
        F.try_to_date(c["review_date"], "dd/MM/yyyy").alias("review_day"),
        number(c["score"]).alias("score"),
        struct_of(scores).alias("scores"),
        F.coalesce(c["description"], F.lit("")).alias("description"),
        number(c["up"], "bigint").alias("thumbs_up"),
        number(c["down"], "bigint").alias("thumbs_down"),
        F.lit("unprocessed").alias("status"),
    )


def extract_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """City rows and review rows of a table of (url, html); pages are parsed once, into a written table."""
    raw = materialise(raw_pages(pages), "raw-pages")
    return city_rows(raw), review_rows(raw)


# --- addresses ----------------------------------------------------------------------------------


def valid_city_urls(df: DataFrame, pattern: str = C.CITY_URL) -> DataFrame:
    return df.where(is_city_url(F.col("url"), pattern))


def classify_urls(df: DataFrame, pattern: str = C.CITY_URL) -> DataFrame:
    """Addresses per class, with the first one in text order as example."""
    return (
        df.select("url", url_class(F.col("url"), pattern).alias("class"))
        .groupBy("class")
        .agg(F.count(F.lit(1)).alias("urls"), F.min("url").alias("example"))
    )
