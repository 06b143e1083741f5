"""Session defaults for local use, and the folder for data a job has to write."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Spark's own setting, of 4.1 and later.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches. A cluster job brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("mostrador")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="mostrador-warehouse-"))
        .getOrCreate()
    )


def scratch_folder(spark: SparkSession) -> str:
    """A new folder that every executor can reach.

    On a cluster this lies under ``spark.checkpoint.dir``. A machine-local folder is
    taken only when the session itself runs on one machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/mostrador-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="mostrador-")
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What a job run inside shuffles is deleted when it ends, not when the driver next collects garbage."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)
