"""Session helpers: one place for the settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

#: Rows of an Arrow batch where texts travel to Python.
BATCH_ROWS = 512
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Page rows are wide (whole articles), so Python batches are kept short.
    _BATCH: str(BATCH_ROWS),
}


def build_session(app: str = "markloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def small_batches(spark: SparkSession) -> None:
    """Bound the rows that travel to Python at once, unless the session has a smaller bound.

    A batch is held by the JVM and by the worker, some of it twice; documents are kilobytes and more.
    """
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, BATCH_ROWS)


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="markloom-")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written tables, below the shared folder of the cluster.

    The folder is the one named in ``spark.checkpoint.dir``. Only a local
    session without that setting falls back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows of a table with too few files for the cores, spread over all of them.

    Text work is heavy per row, and one small file is one task. Tables with
    enough files stay as they are, so nothing large is ever shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or len(df.inputFiles()) >= cores:
        return df
    # A few more partitions than cores, so that long rows even out.
    return df.repartition(3 * cores, key)


def through_table(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result to the shared folder and go on from the written table.

    Cuts the lineage: what reads the result more than once, or loses an
    executor, does not compute it again.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
