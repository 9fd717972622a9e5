"""Sharding by jump consistent hashing: a stable key and the number of shards decide, without a ring table."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._scratch import Scratch

#: Shards of the documents query, and the bytes that a row counts beside its text.
SHARDS, ROW_BYTES = 40, 16
#: Rows that are numbered by one sort; a shard of more rows is numbered in several runs.
RUN_ROWS = 1 << 16

#: Fixed values of the published algorithm: the multiplier of its random numbers.
_MULTIPLIER = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key. With one shard more, a key stays or goes to the new shard."""
    if shards < 1:
        raise ValueError("there must be a shard")
    state = keys.astype(np.uint64, copy=True)
    shard = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    jump = np.zeros(len(state), np.int64)
    while len(live):
        shard[live] = jump
        state[live] = state[live] * _MULTIPLIER + np.uint64(1)
        step = (1 << 31) / ((state[live] >> np.uint64(33)).astype(np.float64) + 1)
        jump = ((shard[live] + 1) * step).astype(np.int64)
        on = jump < shards
        live, jump = live[on], jump[on]
    return shard.astype(np.int32)


def _jump_column(shards: int):
    @F.pandas_udf("int")
    def jump(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series(jump_hash(keys.to_numpy().view(np.uint64), shards))

    return jump


def with_shard(df: DataFrame, key: str, shards: int, out: str = "shard") -> DataFrame:
    """``df`` with the shard of each row. Equal keys, nulls included, share a shard; a column named ``out`` is an error."""
    if out.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"there is a column {out} already")
    return df.withColumn(out, _jump_column(shards)(F.xxhash64(F.col(key))))


def shard_rows(df: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", shards: int = SHARDS, run_rows: int = RUN_ROWS) -> DataFrame:
    """key, size, text_crc32, law, shard, slot, grown_shard of each row of ``df``.

    ``size`` is the UTF-8 bytes of the text plus ROW_BYTES, a null text has none and the checksum 0. Slots
    number the rows of a shard from 0 without gaps: rows are dealt into runs of about ``run_rows``, sorted
    within each, and each run begins where the one before it ends, so no shard is ever in one task. The
    rows are written first, so a repeated task numbers the same runs. Repeated rows have slots of their own;
    a null key is a key like any other; rows that tie in key and text take any order; only the sizes and checksums
    of texts are kept, however long they are; an empty table gives an empty one; other columns aren't read.
    """
    bytes_ = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    rows = df.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(bytes_).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(bytes_).alias("text_crc32"),
        F.xxhash64(F.col(key)).alias("hash"),
        F.xxhash64(F.col(key), F.monotonically_increasing_id()).alias("deal"),
    )
    rows = rows.withColumns({"shard": _jump_column(shards)("hash"), "grown_shard": _jump_column(shards + 1)("hash")})
    rows = scratch.table(rows, "rows")
    runs = max(8, math.ceil(rows.count() / shards / run_rows))
    rows = rows.withColumn("run", F.pmod(F.col("deal"), F.lit(runs)))
    sizes = rows.groupBy("shard", "run").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("shard", "run", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("begin"))
    within = Window.partitionBy("shard", "run").orderBy("doc_id", "text_crc32", "deal")
    placed = rows.withColumn("place", F.row_number().over(within) - 1).join(begins, ["shard", "run"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("begin") + F.col("place")).cast("long").alias("slot"), "grown_shard")


def documents_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark, "shards") as scratch:
        return scratch.publish(shard_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch))
