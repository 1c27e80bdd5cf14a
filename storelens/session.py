"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job in this package relies on. Skewed joins are
# split by adaptive execution even when a later step has to shuffle again. Joins
# of a large table with a cut of another one filter it by the other's keys first:
# the filter has 8 MB at most, whatever it is made from.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(8 << 23),
}


def build_session(app_name: str = "storelens", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; on a local master keep the shuffle small and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = (
                builder.config("spark.ui.enabled", "false")
                .config("spark.driver.memory", "8g")
                .config("spark.sql.shuffle.partitions", "8")
            )
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a session without ``spark.checkpoint.dir`` (a local test run) falls
    back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="storelens-")
        context.setCheckpointDir(base)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


class Stored:
    """Folders that ``stage`` wrote, for whoever knows when nothing reads them any more."""

    def __init__(self) -> None:
        self.folders: list[tuple[SparkSession, str]] = []

    def remove(self) -> None:
        """Delete the folders; what still reads them fails from now on."""
        while self.folders:
            spark, path = self.folders.pop()
            context = spark.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


_NOTED: ContextVar[tuple[Stored, ...]] = ContextVar("noted", default=())


@contextmanager
def stored_inside() -> Iterator[Stored]:
    """Take note of what ``stage`` writes inside, which stays until it is removed."""
    stored = Stored()
    token = _NOTED.set((*_NOTED.get(), stored))
    try:
        yield stored
    finally:
        _NOTED.reset(token)


# Shuffle files of a write go with its end, not when the driver collects its garbage.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table several later steps read, and read it back.

    The written table survives the loss of executors, ends the lineage and
    knows its size, so that joins with it are planned on facts. What was shuffled
    for it is deleted. It is packed tightly, as it stays longer than it takes.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.parquet(path, compression="zstd")
    finally:
        if before is None:
            spark.conf.unset(CLEAN_SHUFFLES)
        else:
            spark.conf.set(CLEAN_SHUFFLES, before)
    for noted in _NOTED.get():
        noted.folders.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)
