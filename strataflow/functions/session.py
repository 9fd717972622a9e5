"""Session settings that operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def ensure_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go where spark.checkpoint.dir says; a folder of our own serves where that is unset, in local runs only."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="strataflow-"))


def local(name: str = "strataflow", cpus: int = 8, partitions: int | None = None) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in {"spark.sql.shuffle.partitions": partitions or cpus, "spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
