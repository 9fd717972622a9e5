"""Documents by suffix: plain text, Markdown, HTML, Word files, workbooks and PDF, and archives of them."""

from __future__ import annotations

import functools
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import html

#: Formats by file suffix.
FORMATS = {"pdf": "pdf", "docx": "docx", "xlsx": "xlsx", "html": "html", "htm": "html", "md": "markdown", "markdown": "markdown", "txt": "text", "log": "text"}
#: Titles of texts that have none.
NO_MARKDOWN_TITLE, NO_TEXT_TITLE = "Untitled Markdown Document", "Untitled Text Document"


def format_of(path: Column) -> Column:
    """The format that a path's suffix tells; null of one that isn't supported."""
    suffix = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in FORMATS.items() for x in pair)), suffix)


def paragraphs(df: DataFrame, key: str, text: str) -> DataFrame:
    """Paragraphs of plain text, the parts between blank lines. The first is the title, and the only one is both."""
    parts = F.filter(F.transform(F.split(F.col(text), r"\n\s*\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")
    listed = F.concat(F.transform(F.slice(parts, F.lit(1), F.lit(1)), lambda x: F.struct(F.lit("title").alias("kind"), x.alias("text"))), F.transform(F.when(F.size(parts) > 1, F.slice(parts, F.lit(2), F.size(parts))).otherwise(parts), lambda x: F.struct(F.lit("paragraph").alias("kind"), x.alias("text"))))
    rows = df.select(F.col(key), F.posexplode(listed).alias("place", "x"))
    return rows.select(key, F.col("place").cast("long").alias("place"), "x.kind", "x.text")


class Markdown:
    """Reads a Markdown text line by line; ``found`` has (kind, text, address, table, row) in order."""

    LINK = re.compile(r"\[(.+?)\]\((.+?)\)")

    def __init__(self, text: str):
        self.title: str | None = None
        self.found: list[tuple[str, str, str | None, int | None, int | None]] = []
        self.open: list[str] = []  # lines of the paragraph that goes on
        self.glossary, self.table, self.rows, self.figures = False, 0, 0, 0
        for line in text.splitlines():
            self.line(line.strip())
        self.end_paragraph()

    def add(self, kind: str, text: str, address: str | None = None, table: int | None = None, row: int | None = None) -> None:
        self.found.append((kind, text, address, table, row))

    def end_paragraph(self) -> None:
        if self.open:
            self.add("paragraph", " ".join(self.open))
        self.open = []

    def line(self, line: str) -> None:
        if self.glossary and line:  # until a blank line
            term, mark, meaning = line.partition(":")
            if mark:
                self.add("glossary", f"{term.strip()}: {meaning.strip()}")
            return
        self.glossary = False
        if not line.startswith("|"):
            self.rows = 0
        if line.startswith("#"):
            self.heading(line)
        elif line.startswith("!["):
            self.figures += 1
            self.add("figure", line[2:].split("]", 1)[0] or f"figure_{self.figures}")
        else:
            links = list(self.LINK.finditer(line))
            for m in links:
                self.add("link", m[1], m[2])
            if links and line == links[0][0]:
                return
            if line.lower().startswith("glossary:"):
                self.end_paragraph()
                self.glossary = True
            elif line.startswith("|"):
                self.row(line)
            elif line:
                self.open.append(line)
            else:
                self.end_paragraph()

    def heading(self, line: str) -> None:
        self.end_paragraph()
        text = line.lstrip("#")
        level = len(line) - len(text)
        if level == 1 and self.title is None:
            self.title = text.strip()
        self.add(f"heading{level}", text.strip())

    def row(self, line: str) -> None:
        self.end_paragraph()
        cells = [c.strip() for c in line.strip("|").split("|")]
        self.rows += 1
        if self.rows == 1:
            self.table += 1
        if self.rows != 2 or not all(set(c) <= set("-:") for c in cells):  # the line below the head
            self.add("table_row", "|".join(cells), None, self.table, self.rows)


def markdown_blocks(text: str) -> list[tuple[str, str, str | None, int | None, int | None]]:
    """The title, then (kind, text, address, table, row) of a text's blocks in order."""
    read = Markdown(text)
    return [("title", read.title if read.title is not None else NO_MARKDOWN_TITLE, None, None, None), *read.found]


def _xml(archive: zipfile.ZipFile, name: str) -> ElementTree.Element | None:
    return ElementTree.fromstring(archive.read(name)) if name in archive.namelist() else None


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _named(node: ElementTree.Element, name: str) -> list[ElementTree.Element]:
    return [x for x in node.iter() if _local(x.tag) == name]


def _value(node: ElementTree.Element, name: str) -> str | None:
    return next((v for k, v in node.attrib.items() if _local(k) == name), None)


def docx_blocks(content: bytes, name: str) -> list[tuple[str, str, str | None, int | None, int | None]]:
    """Paragraphs, headings by their style, references of lines that begin with 'See ', and tables of a Word file."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        body, core, styles = (_xml(archive, x) for x in ("word/document.xml", "docProps/core.xml", "word/styles.xml"))
    known = {} if styles is None else {_value(s, "styleId"): (_value(n[0], "val") or "") for s in _named(styles, "style") if (n := _named(s, "name"))}
    titles = [] if core is None else [t.text.strip() for t in _named(core, "title") if t.text and t.text.strip()]
    found = [("title", titles[0] if titles else _stem(name), None, None, None)]
    text_of = lambda p: "".join((t.text or "") if _local(t.tag) == "t" else "\t" if _local(t.tag) == "tab" else "" for t in p.iter())
    top = next((x for x in body.iter() if _local(x.tag) == "body"), None) if body is not None else None
    tables = 0
    for node in top if top is not None else ():
        if _local(node.tag) == "p":
            whole = text_of(node)
            if text := whole.strip():
                style = next((known.get(_value(s, "val"), _value(s, "val") or "") for s in _named(node, "pStyle")), "").lower()
                level = re.search(r"\d+", style)
                found.append((f"heading{level[0] if level else 1}" if style.startswith("heading") else "paragraph", text, None, None, None))
                if whole.lower().startswith("see "):
                    found.append(("reference", whole, None, None, None))
        elif _local(node.tag) == "tbl":
            rows = [["\n".join(text_of(p) for p in _named(c, "p")).strip() for c in row if _local(c.tag) == "tc"] for row in node if _local(row.tag) == "tr"]
            if any(map(any, rows)):
                tables += 1
                found += [("table_row", "|".join(r), None, tables, i + 1) for i, r in enumerate(rows)]
    return found


def _cell_text(cell: ElementTree.Element, shared: list[str]) -> str:
    kind, value = cell.attrib.get("t", "n"), next((x.text or "" for x in cell if _local(x.tag) == "v"), "")
    if kind == "s":
        return shared[int(value)].strip() if value else ""
    if kind == "inlineStr":
        return "".join(t.text or "" for t in _named(cell, "t")).strip()
    if kind == "b":
        return {"1": "TRUE", "0": "FALSE"}.get(value, "")
    if kind == "n" and value and re.fullmatch(r"[-+]?\d+", value) is None:
        return format(float(value), ".15g")
    return value.strip()


def xlsx_blocks(content: bytes, name: str) -> list[tuple[str, str, str | None, int | None, int | None]]:
    """A heading, a sentence and the rows, padded to one width, of each sheet of a workbook; blank rows go."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        strings, book, links = (_xml(archive, x) for x in ("xl/sharedStrings.xml", "xl/workbook.xml", "xl/_rels/workbook.xml.rels"))
        shared = [] if strings is None else ["".join(t.text or "" for t in _named(s, "t")) for s in strings if _local(s.tag) == "si"]
        targets = {} if links is None else {r.attrib["Id"]: r.attrib["Target"] for r in links}
        sheets = [(s.attrib.get("name", ""), _xml(archive, f"xl/{targets.get(_value(s, 'id'), '').removeprefix('/xl/')}")) for s in _named(book, "sheet")]
    found = [("title", _stem(name), None, None, None)]
    file = name.rpartition("/")[2]
    for i, (title, sheet) in enumerate(sheets, 1):
        title = title.strip() or f"Sheet{i}"
        found.append(("heading1", title, None, None, None))
        rows = []
        for row in _named(sheet, "row") if sheet is not None else ():
            cells: dict[int, str] = {}
            for at, cell in enumerate(c for c in row if _local(c.tag) == "c"):
                letters = re.match("[A-Z]+", cell.attrib.get("r", ""))
                place = functools.reduce(lambda n, x: n * 26 + ord(x) - 64, letters[0], 0) - 1 if letters else at
                cells[place] = _cell_text(cell, shared)
            if any(cells.values()):
                rows.append([cells.get(j, "") for j in range(max(cells) + 1)])
        if rows:
            width = max(map(len, rows))
            rows = [r + [""] * (width - len(r)) for r in rows]
            found.append(("table_caption", f"Sheet {title} from file {file}. Columns: {' | '.join(rows[0])}. Data rows: {len(rows) - 1}.", None, None, None))
            found += [("table_row", "|".join(r), f"file={file}; sheet={title}; columns={width}; rows={len(rows)}", i, j + 1) for j, r in enumerate(rows)]
    return found


def _stem(name: str) -> str:
    file = name.rpartition("/")[2]
    return file.rpartition(".")[0].replace("_", " ").strip() or file


def pdf_blocks(content: bytes, name: str) -> list[tuple[str, str, str | None, int | None, int | None]]:
    """Paragraphs of a PDF file, with pypdf; an error that names it where it isn't installed."""
    try:
        from pypdf import PdfReader
    except ModuleNotFoundError:
        return [("error", "missing_pdf_dependency: pypdf", None, None, None)]
    found = [("title", _stem(name), None, None, None)]
    for page in PdfReader(io.BytesIO(content)).pages:
        found += [("paragraph", p.strip(), None, None, None) for p in re.split(r"\n\s*\n", page.extract_text() or "") if p.strip()]
    return found


def _text_blocks(text: str) -> list[tuple[str, str, str | None, int | None, int | None]]:
    parts = [p.strip() for p in re.split(r"\n\s*\n", text) if p.strip()]
    return [("title", parts[0] if parts else NO_TEXT_TITLE, None, None, None), *(("paragraph", p, None, None, None) for p in parts[1:] or parts)]


PARSERS = {
    "pdf": pdf_blocks, "docx": docx_blocks, "xlsx": xlsx_blocks, "html": lambda c, n: html.elements(c.decode()), "markdown": lambda c, n: markdown_blocks(c.decode()), "text": lambda c, n: _text_blocks(c.decode()),
}


def blocks(path: str, content: bytes) -> list[tuple[str, str, str | None, int | None, int | None]]:
    """What a file's format makes of it; one 'error' block of a format that isn't supported or a file that can't be read."""
    suffix = path.rpartition(".")[2].lower()
    if suffix not in FORMATS:
        return [("error", f"unsupported_document_format: {suffix}", None, None, None)]
    try:
        return PARSERS[FORMATS[suffix]](content, path)
    except Exception as problem:  # noqa: BLE001  a broken file is a row, not the end of all others
        return [("error", f"unreadable: {type(problem).__name__}", None, None, None)]


def parsed(files: DataFrame, strict: bool = False) -> DataFrame:
    """path, place, kind, text, address, table, row of each block of each file (path, content).

    A file that can't be parsed has one row of the kind 'error'; with ``strict`` it fails the query.
    """
    schema = T.StructType([T.StructField("path", T.StringType()), *html.SCHEMA])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32())
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = blocks(path, content.as_py() or b"")
                if strict and found[0][0] == "error":
                    raise ValueError(f"{path}: {found[0][1]}")
                columns = list(zip(*((path, i, *b) for i, b in enumerate(found)), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], schema.names)

    return files.select("path", "content").mapInArrow(parse, schema)


def markdown(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, place, kind, text, address, table, row of each block; a null text has a title alone."""
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *html.SCHEMA])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32())
        for batch in batches:
            rows = [(k, i, *b) for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for i, b in enumerate(markdown_blocks(x or ""))]
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (batch.schema.field(0).type, *types), strict=True)], schema.names)

    return df.select(key, text).mapInArrow(parse, schema)


def expand_archives(files: DataFrame) -> DataFrame:
    """Members of zip files (path, content), each named after its archive; other files stay as they are."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                members = [(path, None, content)]
                if content is not None and zipfile.is_zipfile(io.BytesIO(content)):
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        members = [(f"{path}!{n}", path, archive.read(n)) for n in sorted(archive.namelist()) if not n.endswith("/")]
                for member in members:
                    yield pa.RecordBatch.from_arrays([pa.array([member[0]], pa.string()), pa.array([member[1]], pa.string()), pa.array([member[2]], pa.binary())], ["path", "parent", "content"])

    return files.select("path", "content").mapInArrow(expand, "path string, parent string, content binary")
