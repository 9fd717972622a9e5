"""LAS well logs as data sources: ``las_header`` reads no data rows, ``las_data`` gives a row a curve and value.

Both are registered with ``register(spark)`` and read with ``spark.read.format("las_header").load(path)``. The path
may be a glob or a folder, on file systems that pyarrow opens. For any other that Spark reads, ``headers_of`` and
``data_of`` take the rows (path, content) of Spark's own binaryFile source. A header's file is read up to its data
section; the option ``hash`` reads all of it for its checksum.
"""

from __future__ import annotations

import fnmatch
import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: The null value of files that name none, and the encodings that are tried in order.
NULL_VALUE = -999.25
ENCODINGS = ("utf-8-sig", "utf-8", "latin-1", "cp1252", "ascii")
#: Bytes of a header that are read at a time.
HEAD_BYTES = 64 << 10

HEADER_SCHEMA = "path string, section string, place int, mnemonic string, unit string, value string, description string, sha256 string"
DATA_SCHEMA = "path string, row bigint, place int, mnemonic string, unit string, value double, text string"
_DATA = re.compile(rb"^[ \t]*~[Aa][^\n]*$", re.MULTILINE)
_LINE = re.compile(r"^\s*([^.:\s][^.]*?)\s*\.(\S*)\s*(.*?)\s*:\s*([^:]*)$")


def decode(raw: bytes) -> str:
    for name in ENCODINGS:
        try:
            return raw.decode(name)
        except UnicodeDecodeError:
            continue
    return raw.decode("latin-1")


def header(lines: list[str]) -> Iterator[tuple[str, int, str, str, str, str]]:
    """(section, place, mnemonic, unit, value, description) of each header line before the data."""
    section, place = "", 0
    for line in lines:
        stripped = line.strip()
        if stripped.startswith("~"):
            section, place = stripped[1:2].upper(), 0
            if section == "A":
                return
        elif stripped and not stripped.startswith("#") and section not in ("", "O"):
            found = _LINE.match(stripped)
            if found:
                yield section, place, found[1], found[2], found[3], found[4]
                place += 1


def data(lines: list[str]) -> Iterator[tuple[int, int, str, str, float | None, str | None]]:
    """(row, place, mnemonic, unit, value, text) of each cell; null values, NaN and text give a null value."""
    heads = list(header(lines))
    option = lambda name, none: next((v.strip().upper() for s, _, m, _, v, _ in heads if s == "V" and m.upper() == name), none)
    separator, wrapped = {"COMMA": ",", "TAB": "\t"}.get(option("DLM", "SPACE")), option("WRAP", "NO") == "YES"
    curves = [(m, u) for s, _, m, u, _, _ in heads if s == "C"]
    null = next((float(v) for s, _, m, _, v, _ in heads if s == "W" and m.upper() == "NULL" and re.fullmatch(r"[-+0-9.eE]+", v)), NULL_VALUE)
    inside, row = False, 0
    cells: list[str] = []
    for line in lines:
        stripped = line.strip()
        if stripped.startswith("~"):
            inside = stripped[1:2].upper() == "A"
        elif inside and stripped and not stripped.startswith("#"):
            cells += [c.strip() for c in stripped.split(separator)]
            if wrapped and len(cells) < len(curves):  # a row goes on in the next line
                continue
            for place, (cell, (mnemonic, unit)) in enumerate(zip(cells, curves)):
                try:
                    number = float(cell)
                    text = None
                except ValueError:
                    number, text = None, cell
                if number is not None and (number != number or number == null):
                    number = None
                yield row, place, mnemonic, unit, number, text
            row, cells = row + 1, []


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], whole: bool):
        self.path, self.whole = options["path"], whole
        self.recursive, self.hash = options.get("recursive", "false") == "true", options.get("hash", "false") == "true"

    def partitions(self) -> list[_File]:
        base, _, pattern = self.path.rpartition("/") if any(c in self.path for c in "*?[") or self.path.lower().endswith(".las") else (self.path, "", "*.las")
        source, root = fs.FileSystem.from_uri(base)
        prefix = base[: len(base) - len(root)] if base.endswith(root) else ""
        found = source.get_file_info(fs.FileSelector(root, recursive=self.recursive))
        return [_File(prefix + f.path) for f in sorted(found, key=lambda f: f.path) if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name.lower(), pattern.lower())]

    def read(self, partition: _File) -> Iterator[tuple]:
        source, at = fs.FileSystem.from_uri(partition.path)
        with source.open_input_stream(at) as file:
            raw = file.read() if self.whole or self.hash else head_of(file)
        lines = decode(raw).splitlines()
        if self.whole:
            for cell in data(lines):
                yield (partition.path, *cell)
        else:
            digest = hashlib.sha256(raw).hexdigest() if self.hash else None
            for line in header(lines):
                yield (partition.path, *line, digest)


def head_of(file) -> bytes:
    """A file's bytes up to the line that begins its data section; pieces are read until one has it."""
    raw = b""
    while piece := file.read(HEAD_BYTES):
        raw += piece
        if found := _DATA.search(raw):
            return raw[: found.start()]
    return raw


class LasHeader(DataSource):
    @classmethod
    def name(cls) -> str:
        return "las_header"

    def schema(self) -> str:
        return HEADER_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, False)


class LasData(LasHeader):
    @classmethod
    def name(cls) -> str:
        return "las_data"

    def schema(self) -> str:
        return DATA_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, True)


def _parsed(files: DataFrame, schema: str, parse) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = parse(path, content.as_py() or b"")
                while part := list(itertools.islice(rows, 50_000)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), types, strict=True)], names)

    return files.select("path", "content").mapInArrow(run, schema)


def headers_of(files: DataFrame) -> DataFrame:
    """The header lines of files (path, content), with the checksum of each."""
    return _parsed(files, HEADER_SCHEMA, lambda path, raw: ((path, *line, hashlib.sha256(raw).hexdigest()) for line in header(decode(raw).splitlines())))


def data_of(files: DataFrame) -> DataFrame:
    """The cells of files (path, content)."""
    return _parsed(files, DATA_SCHEMA, lambda path, raw: ((path, *cell) for cell in data(decode(raw).splitlines())))


def register(spark: SparkSession) -> None:
    for source in (LasHeader, LasData):
        spark.dataSource.register(source)


def file_metadata(df: DataFrame, path: str = "path") -> DataFrame:
    """rig and date of files named RIG_WELL_dd-mm-yyyy...; a date that isn't one is null."""
    name = F.element_at(F.split(F.col(path), "/"), -1)
    day = F.regexp_extract(name, r"(\d{2}[-_]\d{2}[-_]\d{4})", 1)
    return df.withColumns({"rig": F.element_at(F.split(name, "_"), 1), "file_date": F.try_to_timestamp(F.replace(day, F.lit("_"), F.lit("-")), F.lit("dd-MM-yyyy")).cast("date")})


def curve_order(headers: DataFrame) -> DataFrame:
    """Each curve's place by the leading digits of its description, else by the file, and how many there are."""
    given = F.nullif(F.regexp_extract(F.trim("description"), r"^(\d+)", 1), F.lit("")).cast("int")
    curves = headers.filter("section = 'C'").withColumn("given", given)
    totals = curves.groupBy("path").agg(F.coalesce(F.max("given"), F.count("mnemonic")).alias("total"))
    return curves.join(totals, "path").select("path", "mnemonic", "unit", F.coalesce("given", F.col("place") + 1).alias("position"), "total")


def to_json(data_rows: DataFrame) -> DataFrame:
    """A JSON text a file: curves in order with their values; a missing value is written as the null value."""
    cell = F.coalesce(F.col("value").cast("string"), F.col("text"), F.lit(str(NULL_VALUE)))
    curves = data_rows.groupBy("path", "place", "mnemonic", "unit").agg(F.transform(F.array_sort(F.collect_list(F.struct("row", cell.alias("cell")))), lambda x: x["cell"]).alias("data"))
    return curves.groupBy("path").agg(F.to_json(F.array_sort(F.collect_list(F.struct("place", "mnemonic", "unit", "data")))).alias("json"))
