"""Delimited files and databases, in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates

#: Columns of the well list and of the quality export.
WELL_LIST = ("Operator", "Well Name", "Contractor", "Rig", "Spud Date", "Latest EDR")
WELL_LIST_SCHEMA = "operator string, well_name string, contractor string, rig string, spud_date string, latest_edr string"
BOM = "\ufeff"


def load_csv(spark: SparkSession, path: str, schema: str, columns: dict[str, Column] | None = None) -> DataFrame:
    """A file with a head line, read as text columns, and columns made of them. Short lines have nulls."""
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE").option("quote", '"').option("escape", '"').csv(path)
    return rows.withColumns(columns) if columns else rows


def well_list(spark: SparkSession, path: str, now: Column) -> DataFrame:
    """The well list as it is loaded: stamped, with its dates parsed, and online if the latest record is under six hours old."""
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    latest = dates.spelled(blank("latest_edr"), "Y-m-d T")
    hours = F.timestamp_diff("HOUR", latest, now)
    return load_csv(spark, path, WELL_LIST_SCHEMA, {"import_datetime": now, "spud_date": dates.spelled(blank("spud_date"), "Y-m-d").cast("date"), "latest_edr": latest, "status": F.when(hours < 6, "online").otherwise("offline")})


def in_order(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The columns in their order; one that is missing is null."""
    return df.select(*(F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns))


def save_csv(df: DataFrame, path: str, columns: tuple[str, ...] | None = None, separator: str = ",", bom: bool = False) -> None:
    """Writes a folder of CSV files with a head line each, quoted where needed; nulls are empty.

    With ``bom`` the name of the first column begins with a byte-order mark, as spreadsheets expect of UTF-8.
    """
    rows = in_order(df, columns) if columns else df
    if bom:
        rows = rows.withColumnRenamed(rows.columns[0], BOM + rows.columns[0])
    rows.write.option("header", True).option("sep", separator).option("escape", '"').option("emptyValue", "").option("nullValue", "").mode("overwrite").csv(path)


def database_table(spark: SparkSession, url: str, table: str, options: dict[str, str] | None = None, split: tuple[str, int, int, int] | None = None) -> DataFrame:
    """A table of a database; with ``split`` (column, lowest, highest, parts) it is read in parallel. Credentials come in ``options``."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {}))
    if split is not None:
        for name, value in zip(("partitionColumn", "lowerBound", "upperBound", "numPartitions"), split, strict=True):
            reader = reader.option(name, value)
    return reader.load()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
