"""Writing page tables, censuses and line logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import slug
from ..schemas import OUT_SCHEMA, RAW_SCHEMA

# Wide article rows: keep files of a size that one task reads comfortably.
MAX_RECORDS_PER_FILE = 200_000


def run_path(path: str, run_ts: int | None) -> str:
    """Folder of one run below `path`, stamped with its UTC epoch."""
    return path if run_ts is None else f"{path.rstrip('/')}/{run_ts}"


def _write_table(df: DataFrame, schema, path: str, run_ts: int | None, mode: str | None) -> str:
    target = run_path(path, run_ts)
    # A run that is repeated replaces what it wrote before; without a stamp there is no telling runs apart.
    mode = mode or ("append" if run_ts is None else "overwrite")
    (
        df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        .write.mode(mode)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .parquet(target)
    )
    return target


def write_raw(df: DataFrame, path: str, run_ts: int | None = None, mode: str | None = None) -> str:
    return _write_table(df, RAW_SCHEMA, path, run_ts, mode)


def write_pages(df: DataFrame, path: str, run_ts: int | None = None, mode: str | None = None) -> str:
    return _write_table(df, OUT_SCHEMA, path, run_ts, mode)


MANIFEST = "_finished"


def finish_run(spark: SparkSession, path: str, run_ts: int) -> None:
    """Note that a run below `path` is complete. Readers of the table don't see the note."""
    spark.range(1).select(F.lit(run_ts).alias("run_ts")).write.mode("overwrite").parquet(f"{run_path(path, None)}/{MANIFEST}/{run_ts}")


def finished_runs(spark: SparkSession, path: str) -> DataFrame:
    """(run_ts) of the complete runs below `path`."""
    return spark.read.schema("run_ts long").parquet(f"{path.rstrip('/')}/{MANIFEST}/*")


def read_finished(spark: SparkSession, path: str, schema=RAW_SCHEMA) -> DataFrame:
    """The rows of all complete runs below `path`, with their `run_ts`; what a broken run left is not read."""
    stamp = F.regexp_extract(F.input_file_name(), r"/([0-9]+)/[^/]+\z", 1).cast("long")
    rows = spark.read.schema(schema).parquet(f"{path.rstrip('/')}/[0-9]*").withColumn("run_ts", stamp)
    return rows.join(F.broadcast(finished_runs(spark, path)), "run_ts", "left_semi")


def write_for_lookup(df: DataFrame, path: str, by: str = "title", also: str = "pageid") -> None:
    """Pages in order of `by`, with filters of both columns in the files: a lookup reads one row group, not the table."""
    options = {"parquet.enable.dictionary": "true"}
    for column in (by, also):
        options[f"parquet.bloom.filter.enabled#{column}"] = "true"
    df.repartitionByRange(by).sortWithinPartitions(by).write.mode("overwrite").options(**options).parquet(path)


def write_census_csv(census: DataFrame, path: str, name: str) -> None:
    """`name,count` with a header, most frequent first."""
    (
        census.select(F.col("name").alias(name), F.col("n").alias("count"))
        .orderBy(F.desc("count"), F.asc(name))
        .write.csv(path, header=True)
    )


def write_lines(df: DataFrame, path: str, cols: list[str | Column], sep: str) -> None:
    """One line of text per row, the columns joined by `sep`."""
    cells = [F.col(c) if isinstance(c, str) else c for c in cols]
    df.select(F.concat_ws(sep, *[c.cast("string") for c in cells]).alias("value")).write.text(path)


def export_article(found: DataFrame, path: str, runs: bool = False) -> None:
    """Markup of looked-up pages as text, in a folder named by the title's slug."""
    out = found.select(slug(F.col("title"), runs).alias("slug"), F.col("wikitext").alias("value"))
    out.write.partitionBy("slug").text(path)
