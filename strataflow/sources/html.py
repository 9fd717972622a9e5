"""Structure of HTML pages: title, headings, paragraphs, links, figures, table rows and glossary entries.

A page is read as a stream of tags. Text counts since the last tag that ended, or since the last element began that
gathers text, so what stands before a nested element isn't part of the element around it; cells gather all of theirs.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The title of a page that has none, and what a figure without texts is called.
NO_TITLE, NO_LABEL = "Untitled HTML Document", "figure"
HEADINGS = {f"h{i}": i for i in range(1, 7)}
#: Elements whose beginning starts the text anew.
GATHERING = {"title", "p", "li", "a", "caption", "dt", "dd", *HEADINGS}

Element = tuple[str, str, str | None, int | None, int | None]  # kind, text, address, table, row

SCHEMA = [T.StructField("place", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("text", T.StringType()), T.StructField("address", T.StringType()), T.StructField("table", T.IntegerType()), T.StructField("row", T.IntegerType())]


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.title, self.out = NO_TITLE, []
        self.words: list[str] = []
        self.href: str | None = None
        self.rows: list[list[str]] | None = None  # of the table that is open
        self.row: list[str] | None = None
        self.cell: list[str] = []
        self.caption: str | None = None
        self.captions: list[str] | None = None  # parts of the caption that is open
        self.tables = 0
        self.term: str | None = None

    def emit(self, kind: str, text: str, address: str | None = None, table: int | None = None, row: int | None = None) -> None:
        self.out.append((kind, text, address, table, row))

    def handle_starttag(self, tag, attrs):
        named = dict(attrs)
        if tag in GATHERING:
            self.words = []
        match tag:
            case "a":
                self.href = named.get("href")
            case "table":
                self.rows, self.caption = [], None
            case "tr":
                self.row = []
            case "td" | "th":
                self.cell = []
            case "caption":
                self.captions = []
            case "img":
                self.emit("figure", (named.get("alt") or named.get("src") or NO_LABEL).strip(), named.get("title"))

    def handle_data(self, data):
        if word := data.strip():
            self.words.append(word)
            if self.row is not None:
                self.cell.append(word)
            if self.captions is not None:
                self.captions.append(word)

    def handle_endtag(self, tag):
        text, self.words = " ".join(self.words), []
        ended = getattr(self, f"end_{tag if tag not in HEADINGS else 'heading'}", None)
        if ended is not None:
            ended(text, tag)

    def end_title(self, text, tag):
        self.title = text or self.title

    def end_p(self, text, tag):
        if text:
            self.emit("paragraph", text)

    end_li = end_p

    def end_heading(self, text, tag):
        if text:
            self.emit(f"heading{HEADINGS[tag]}", text)

    def end_a(self, text, tag):
        if text:
            self.emit("link", text, self.href)
            self.href = None

    def end_caption(self, text, tag):
        if self.captions:
            self.caption = " ".join(self.captions)
        self.captions = None

    def end_td(self, text, tag):
        if self.row is not None:
            self.row.append(" ".join(self.cell))
            self.cell = []

    end_th = end_td

    def end_tr(self, text, tag):
        if self.rows is not None and self.row is not None:
            self.rows.append(self.row)
            self.row = None

    def end_table(self, text, tag):
        kept = [row for row in self.rows or () if any(row)]
        if kept:
            self.tables += 1
            for i, row in enumerate(kept):
                self.emit("table_row", "|".join(row), self.caption, self.tables, i + 1)
        if self.rows:
            self.rows, self.caption = None, None

    def end_dt(self, text, tag):
        self.term = text or None

    def end_dd(self, text, tag):
        if text and self.term:
            self.emit("glossary", f"{self.term}: {text}")
            self.term = None


def elements(page: str) -> list[Element]:
    """The title, then a page's elements as they end. A link's address is its target, a figure's its title, a row's its table's caption."""
    parser = _Page()
    parser.feed(page)
    return [("title", parser.title, None, None, None), *parser.out]


def structure(df: DataFrame, key: str, html: str) -> DataFrame:
    """key, place, kind, text, address, table, row of each element; a null page has a title alone."""
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *SCHEMA])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32())
        for batch in batches:
            rows = [(k, i, *e) for k, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for i, e in enumerate(elements(page or ""))]
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (batch.schema.field(0).type, *types), strict=True)], schema.names)

    return df.select(key, html).mapInArrow(parse, schema)


def table_rows(elements_: DataFrame, names: list[str], key: str, least: int = 9) -> DataFrame:
    """Rows of all tables that have enough cells, with the first ones under ``names``."""
    cells = F.split("text", r"\|", -1)
    rows = elements_.filter((F.col("kind") == "table_row") & (F.size(cells) >= least))
    return rows.select(key, "table", "row", *(F.get(cells, i).alias(n) for i, n in enumerate(names)))
