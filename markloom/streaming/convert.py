"""Incremental conversion: new raw files in, converted pages out, each page once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.dims import TemplatePolicy
from ..operators.quality import OUT_COLUMNS, retry_input, to_output, with_status
from ..plans.convert import convert_pages
from ..schemas import RAW_SCHEMA
from ..session import small_batches, through_table
from ..sources.readers import read_raw


def convert_stream(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    expansions: DataFrame | None = None,
    with_styling: bool = False,
    policy: TemplatePolicy | DataFrame | None = None,
    max_files: int = 1_000,
    outcomes: bool = False,
) -> StreamingQuery:
    """Convert all raw files that are not yet done, then stop.

    Each micro-batch is converted like any table, with a dictionary and a policy of any size joined to it, and replaces the folder of its number below `out_dir`: a batch that a
    restarted stream repeats leaves every page once. The checkpoint remembers which files are done.

    The policy is written once when the stream starts. The dictionary is read by each batch where it lies, for the
    entries in use alone, and never copied whole: one that is costly to make should be a written table.

    Only converted pages are written, unless `outcomes` asks for all pages, with status and
    error, in one folder per status: the same run then says what is corrupt and what to retry.
    """
    small_batches(spark)  # a stream keeps the settings it starts with
    raw = (
        spark.readStream.schema(RAW_SCHEMA)
        .option("maxFilesPerTrigger", max_files)
        .parquet(in_dir)
    )
    if isinstance(policy, DataFrame):
        policy = through_table(policy, "names")

    def convert(batch: DataFrame, number: int) -> None:
        write_batch(convert_pages(batch, expansions, with_styling, policy), out_dir, number, outcomes)

    return (
        raw.writeStream.foreachBatch(convert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_batch(done: DataFrame, out_dir: str, number: int, outcomes: bool) -> None:
    """Write one batch; writing the same number again replaces what it wrote before."""
    target = f"{out_dir.rstrip('/')}/batch={number}"
    if outcomes:
        done.select(*OUT_COLUMNS, "error", "status").write.mode("overwrite").partitionBy("status").parquet(target)
    else:
        to_output(with_status(done, "ok")).write.mode("overwrite").parquet(target)


def read_converted(spark: SparkSession, out_dir: str) -> DataFrame:
    """The converted pages of all batches."""
    return spark.read.parquet(out_dir).select(*OUT_COLUMNS)


def read_outcomes(spark: SparkSession, out_dir: str) -> DataFrame:
    """What `convert_stream` wrote with `outcomes`; a page that was retried has its last outcome.

    Only failed pages are ever retried, so only their rows are looked at again: a failure goes if the
    page has another outcome, and of several failures the last one stays.
    """
    rows = spark.read.parquet(out_dir)
    failed, done = rows.where("status = 'failed'"), rows.where("status <> 'failed'")
    last = failed.groupBy("pageid").agg(F.max("batch").alias("batch"))
    still = failed.join(last, ["pageid", "batch"], "left_semi").join(done.select("pageid"), "pageid", "left_anti")
    return done.unionByName(still.select(*rows.columns)).drop("batch")


def retry_failed(spark: SparkSession, in_dir: str, out_dir: str) -> int:
    """Put the raw rows of failed pages before the stream once more, as a new file; corrupt pages stay corrupt.

    Returns how many pages that are.
    """
    raw = read_raw(spark, in_dir).dropDuplicates(["pageid", "revid"])
    again = through_table(retry_input(raw, read_outcomes(spark, out_dir)), "retry")
    count = again.count()
    if count:
        again.write.mode("append").parquet(in_dir)
    return count
