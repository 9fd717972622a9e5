"""A polled work queue as a stream of files, each processed once, with idempotent appends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Folders that a table's keys are dealt into: a batch looks only into those of its own keys.
BUCKETS = 256


def pending_files(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """New Parquet files of a folder, as they come."""
    return spark.readStream.schema(schema).parquet(folder)


class ConflictError(ValueError):
    """A key came again with another payload."""


def append_once(rows: DataFrame, key: str, table_path: str, payload: list[str] = ()) -> None:
    """Appends the rows whose keys the table lacks; with ``payload``, a key that is there with other contents is an error.

    The table is dealt into folders by a hash of the key, so only those that the rows' keys lie in are read.
    """
    spark = rows.sparkSession
    done = rows.dropDuplicates([key]).withColumn("_bucket", F.pmod(F.xxhash64(F.col(key)), F.lit(BUCKETS)).cast("int"))
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        touched = [r["_bucket"] for r in done.select("_bucket").distinct().collect()]  # BUCKETS rows at most
        there = spark.read.parquet(table_path).filter(F.col("_bucket").isin(touched)).select(key, *(F.col(c).alias(f"_{c}") for c in payload))
        if payload:
            same = F.lit(True)
            for c in payload:
                same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
            if (clash := done.join(there, key).filter(~same).select(key).first()) is not None:
                raise ConflictError(f"{key} {clash[0]} is there with other contents")
        done = done.join(there.select(key), key, "left_anti")
    done.write.mode("append").partitionBy("_bucket").parquet(table_path)


def process_once(stream: DataFrame, work: Callable[[DataFrame], DataFrame], key: str, table_path: str, checkpoint: str, payload: list[str] = ()) -> StreamingQuery:
    """Appends ``work`` of each batch, leaving out keys that are there already, and stops when nothing is pending.

    The checkpoint remembers what was read; the look-up makes a batch that is run again append nothing.
    """
    return stream.writeStream.foreachBatch(lambda batch, batch_id: append_once(work(batch), key, table_path, payload)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def activity(stream: DataFrame, when: str, key: str, width: str = "1 hour", late: str = "6 hours") -> DataFrame:
    """Events of each key in windows of event time; rows later than ``late`` are dropped."""
    return stream.withWatermark(when, late).groupBy(F.window(when, width), key).agg(F.count("*").alias("n"))


def complete(files: DataFrame, name: str, size: str, polls: str) -> DataFrame:
    """Files whose size is more than 0 and the same in the last two polls: their download has ended."""
    last = files.groupBy(name).agg(F.slice(F.reverse(F.array_sort(F.collect_list(F.struct(polls, size)))), 1, 2).alias("_last"))
    steady = (F.size("_last") == 2) & (F.get("_last", 0)[size] == F.get("_last", 1)[size]) & (F.get("_last", 0)[size] > 0)
    return last.select(name, steady.alias("complete"))
