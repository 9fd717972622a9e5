"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"
#: Rows that Spark hands to Python at a time, at most: texts are long, and each task holds a batch on either side.
ARROW_ROWS, ARROW_SETTING = 4000, "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Shuffle files of a table go as soon as it is written: nothing reads them again.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; one of our own where that is unset, in local runs only."""
    found = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING, None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{SETTING} must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="strataflow-")
        spark.conf.set(SETTING, found)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(found)
    whole = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(jvm_path).toString()
    if whole.startswith("file:/") and not whole.startswith("file://"):
        whole = "file://" + whole[len("file:") :]
    return whole.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def _delete_quietly(spark: SparkSession, path: str) -> None:
    try:
        delete(spark, path)
    except Exception:  # noqa: BLE001  the session may have ended; the files are only leftovers
        pass


@contextlib.contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """The session's settings while one table is written; afterwards they are as the caller had them."""
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class Scratch:
    """Tables written as Parquet and read again, so that a lost executor never repeats more than one step.

    Leaving the block deletes every table but those kept by ``publish``; those go when the process ends.
    """

    def __init__(self, spark: SparkSession, name: str, tidy: Callable[[], None] | None = None):
        self.tidy, self.spark, self.root = tidy, spark, f"{shared_folder(spark)}/strataflow-{name}-{uuid.uuid4().hex}"
        self._parts: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def path(self, name: str) -> str:
        self._parts.append(found := f"{self.root}/{name}-{len(self._parts)}")
        return found

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        self._write(df, path)
        found = self.spark.read.schema(df.schema).parquet(path)
        found._scratch_path = path
        return found

    def _write(self, df: DataFrame, path: str) -> None:
        rows = int(self.spark.conf.get(ARROW_SETTING))
        with _settings(self.spark, {ARROW_SETTING: str(min(rows, ARROW_ROWS) if rows > 0 else ARROW_ROWS), CLEANUP_SETTING: "true"}):
            df.write.parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that nothing will read again; the application's ``tidy`` may then have Spark clean up."""
        for table in tables:
            _delete_quietly(self.spark, table._scratch_path)
        if self.tidy is not None:
            self.tidy()

    def broadcast_if_small(self, table: DataFrame, most_rows: int) -> DataFrame:
        """A hint to broadcast a table of the scratch folder that has been counted to hold ``most_rows`` at most."""
        return F.broadcast(table) if table.count() <= most_rows else table

    def publish(self, df: DataFrame) -> DataFrame:
        """A table that stays until the process ends."""
        path = f"{self.root}-out-{len(self._parts)}"
        self._parts.append(path)
        self._write(df, path)
        atexit.register(_delete_quietly, self.spark, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_: object) -> None:
        _delete_quietly(self.spark, self.root)
