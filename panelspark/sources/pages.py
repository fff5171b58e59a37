"""Links, tables and glossaries out of a table of web pages."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from html.parser import HTMLParser
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

_HIDDEN = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>"
_ANCHOR = r"(?is)<a\b[^>]*?\shref\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)[^>]*>(.*?)</a\s*>"
_ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def _decoded(text: Column) -> Column:
    for entity, sign in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return text


def extract_links(pages: DataFrame, targets: Sequence[str], base_url: str = "", skip: str = "squads",
                  html: str = "html", keys: Sequence[str] = ("page_id",), by_url: bool = False) -> DataFrame:
    """(keys, text, url) of anchors whose text is a target and whose address lacks ``skip``; distinct.

    Runs as regular expressions inside the JVM: comments, scripts and styles are cut out, then every
    anchor becomes a row. ``by_url`` keeps one row per page and address (the least text).
    """
    visible = F.regexp_replace(F.col(html), _HIDDEN, "")
    anchors = F.regexp_extract_all(visible, F.lit(_ANCHOR), F.lit(0))
    rows = pages.select(*keys, F.explode(anchors).alias("__a"))
    href = F.regexp_replace(F.regexp_extract("__a", _ANCHOR, 1), "^[\"']|[\"']$", "")
    text = F.regexp_replace(F.regexp_extract("__a", _ANCHOR, 2), "<[^>]*>", "")
    links = rows.select(*keys, F.regexp_replace(_decoded(text), r"^\s+|\s+$", "").alias("text"),
                        _decoded(href).alias("__href"))
    links = links.where(F.col("text").isin(list(targets)) & ~F.col("__href").contains(skip))
    found = links.select(*keys, "text", F.concat(F.lit(base_url), F.col("__href")).alias("url"))
    return found.groupBy(*keys, "url").agg(F.min("text").alias("text")) if by_url else found.distinct()


MAX_COLSPAN, MAX_ROWSPAN = 1_000, 65_534  # as browsers read them: a wider cell covers one column, a longer one so many rows


def _span(text: str | None, most: int) -> int:
    digits = (text or "").strip()
    if not (digits.isascii() and digits.isdigit()):
        return 1
    wide = int(digits) if len(digits) < 10 else most + 1
    return wide if wide <= most else 1 if most == MAX_COLSPAN else most


class _Tables(HTMLParser):
    """Collects the tables of a page: their class, and cells with their row, span, tag, tip and section."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[dict] = []
        self._open: list[dict] = []
        self._cell: dict | None = None

    def handle_starttag(self, tag, attrs):
        attributes = dict(attrs)
        if tag == "table":
            table = {"class": (attributes.get("class") or "").split(), "rows": [], "section": "", "open": True}
            self.tables.append(table)
            self._open.append(table)
            self._cell = None
        elif not self._open:
            return
        elif tag in ("thead", "tbody", "tfoot"):
            self._open[-1]["section"] = tag
        elif tag == "tr":
            self._open[-1]["rows"].append({"section": self._open[-1]["section"], "cells": []})
            self._cell = None
        elif tag in ("td", "th") and self._open[-1]["rows"]:
            span = [_span(attributes.get(a), most) for a, most in (("colspan", MAX_COLSPAN), ("rowspan", MAX_ROWSPAN))]
            self._cell = {"tag": tag, "text": [], "span": span,
                          "tip": attributes.get("data-tip") or attributes.get("title") or ""}
            self._open[-1]["rows"][-1]["cells"].append(self._cell)
        elif self._cell is not None and not self._cell["tip"]:
            self._cell["tip"] = attributes.get("data-tip") or ""

    def handle_endtag(self, tag):
        if tag == "table" and self._open:
            self._open.pop()["open"] = False
        elif tag in ("thead", "tbody", "tfoot") and self._open:
            self._open[-1]["section"] = ""
        if tag in ("td", "th", "tr", "table"):
            self._cell = None

    def handle_data(self, data):
        if self._cell is not None:
            self._cell["text"].append(data)


PIECE = 1 << 16  # code points of a page parsed at a time


def _tables(page: str | None, done: Callable[[list[dict]], bool] = lambda _: False, piece: int = PIECE) -> list[dict]:
    """Tables of a page in the order they open; the page is read until they are enough."""
    parser, page = _Tables(), page or ""
    for start in range(0, len(page), piece):
        parser.feed(page[start:start + piece])
        if done(parser.tables):
            return parser.tables
    parser.close()
    return parser.tables


def _text(cell: dict) -> str:
    return " ".join("".join(cell["text"]).split())


def _grid(rows: list[dict]) -> list[list[str]]:
    """Cell texts with column and row spans repeated."""
    out: list[list[str]] = []
    carried: dict[int, tuple[int, str]] = {}
    for row in rows:
        line: list[str] = []
        cells = iter(row["cells"])
        cell = next(cells, None)
        while cell is not None or len(line) in carried:
            if len(line) in carried:
                left, text = carried.pop(len(line))
                if left > 1:
                    carried[len(line)] = (left - 1, text)
                line.append(text)
                continue
            across, down = cell["span"]
            for _ in range(max(1, across)):
                if down > 1:
                    carried[len(line)] = (down - 1, _text(cell))
                line.append(_text(cell))
            cell = next(cells, None)
        out.append(line)
    return out


def _first_table(page: str | None) -> list[tuple[int, int, str, str | None]]:
    """(row number, column number, flattened column name, value) of the first table."""
    tables = _tables(page, lambda found: bool(found) and not found[0]["open"])
    if not tables:
        return []
    rows = [r for r in tables[0]["rows"] if r["cells"]]
    head = [r for r in rows if r["section"] == "thead"]
    if not head and rows and all(c["tag"] == "th" for c in rows[0]["cells"]):
        head = rows[:1]
    body = [r for r in rows if not any(r is h for h in head)]
    levels, lines = _grid(head), _grid(body)
    width = max([len(x) for x in levels + lines] or [0])

    def title(i: int) -> str:
        many = len(levels) > 1
        parts = [(line[i] if i < len(line) else "") or (f"Unnamed: {i}_level_{n}" if many else f"Unnamed: {i}")
                 for n, line in enumerate(levels)]
        return "_".join(parts).strip() if parts else str(i)

    titles = [title(i) for i in range(width)]
    return [(n, i, titles[i], (line[i] if i < len(line) else "") or None)
            for n, line in enumerate(lines, 1) for i in range(width)]


CELLS_PER_FRAME = 50_000


def _frames(found: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Rows as frames of bounded size, however many a batch of pages yields."""
    while rows := list(islice(found, CELLS_PER_FRAME)):
        yield pd.DataFrame(rows, columns=columns)


def extract_table_cells(pages: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """Long form (key, row_no, column_no, column_name, value) of each page's first table.

    Header rows are flattened to ``top_sub``; a blank header part reads ``Unnamed: i_level_n``.
    """
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = ((k, *cell) for k, page in zip(batch[key], batch[html]) for cell in _first_table(page))
            yield from _frames(cells, [key, "row_no", "column_no", "column_name", "value"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(
        parse, f"`{key}` {kind}, row_no int, column_no int, column_name string, value string")


def table_rows(cells: DataFrame, columns: Sequence[str], key: str = "page_id") -> DataFrame:
    """Cells back to one row per table row with the given columns."""
    named = F.col("column_name")
    return cells.groupBy(key, "row_no").agg(*[F.max(F.when(named == c, F.col("value"))).alias(c) for c in columns])


def _glossary(page: str | None) -> list[tuple[int, str, str]]:
    """(position, column name, raw tooltip) of the header cells of the page's statistics table."""
    tables = _tables(page, lambda found: next((not t["open"] for t in found if "stats_table" in t["class"]), False))
    chosen = next((t for t in tables if "stats_table" in t["class"]), tables[0] if tables else None)
    if chosen is None:
        return []
    cells = [c for r in chosen["rows"] if r["section"] == "thead" for c in r["cells"] if c["tag"] == "th"]
    return [(i, "".join(c["text"]).strip(), c["tip"]) for i, c in enumerate(cells, 1) if c["tip"]]


def extract_glossary(pages: DataFrame, table_name: str = "table_name", html: str = "html",
                     order: str = "page_id") -> DataFrame:
    """(table_name, column_name, definition) of header tooltips; the first one per table and column wins."""
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = ((t, o, *entry) for t, o, page in zip(batch[table_name], batch[order], batch[html])
                     for entry in _glossary(page))
            yield from _frames(found, ["table_name", "__order", "__position", "column_name", "definition"])

    kind = pages.schema[order].dataType.simpleString()
    raw = pages.select(F.col(table_name), order, html).mapInPandas(
        parse, f"table_name string, `__order` {kind}, `__position` int, column_name string, definition string")
    plain = F.replace(F.regexp_replace("definition", "<[^>]+>", ""), F.lit("&nbsp;"), F.lit(" "))
    plain = F.replace(plain, F.lit(" "), F.lit(" "))
    known = raw.withColumn("definition", plain).where("column_name <> '' AND definition <> ''")
    first = Window.partitionBy("table_name", "column_name").orderBy("__order", "__position")
    return (known.withColumn("__n", F.row_number().over(first)).where("__n = 1")
            .select("table_name", "column_name", "definition"))
