"""Whole runs: raw pages in, dataset and logs out.

Conversion is the expensive part, so it runs once: its result goes to a table in
the shared folder, and the dataset, the censuses and the logs read that table.
A lost executor costs the tasks it had, not the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dims import TemplatePolicy
from ..operators.catalog import assemble_raw, category_pages, label_articles, missing
from ..operators.census import sum_counters
from ..operators.quality import retry_input, run_summary, to_output, with_status
from ..session import through_table
from ..sources.readers import flatten_query_response, read_raw
from ..sources.writers import run_path, write_census_csv, write_lines, write_pages, write_raw
from .convert import convert_pages

_STAGED = (
    "pageid", "title", "revid", "description", "categories", "markdown",
    "unsupported_tags", "unsupported_templates", "status", "error",
)


def stage(converted: DataFrame) -> DataFrame:
    return through_table(converted.select(*_STAGED), "converted")


def generate(
    spark: SparkSession,
    data: str,
    out: str,
    log_dir: str,
    run_ts: int,
    expansions: DataFrame | None = None,
    with_styling: bool = False,
    policy: TemplatePolicy | DataFrame | None = None,
    retry: bool = False,
) -> DataFrame:
    """Convert a raw dataset and write the final one, with censuses and logs.

    Returns the run summary. `retry` converts failed pages a second time and
    counts their final state.
    """
    raw = read_raw(spark, data)
    done = stage(convert_pages(raw, expansions, with_styling, policy))
    if retry:
        failed = retry_input(raw, done)
        again = convert_pages(failed, expansions, with_styling, policy)
        settled = done.where(F.col("status") != "failed")
        done = settled.unionByName(stage(again))

    ok = with_status(done, "ok")
    logs = run_path(log_dir, run_ts)
    write_pages(to_output(ok), out)
    write_census_csv(sum_counters(ok, "unsupported_tags"), f"{logs}/unsupported_tags", "tag")
    write_census_csv(
        sum_counters(ok, "unsupported_templates"), f"{logs}/unsupported_templates", "template"
    )
    write_lines(with_status(done, "corrupt"), f"{logs}/corrupt", ["title"], "")
    write_lines(with_status(done, "failed"), f"{logs}/failures", ["title", "error"], " | ")
    return run_summary(done)


def download(
    spark: SparkSession,
    members: DataFrame,
    responses: DataFrame,
    out: str,
    log_dir: str,
    run_ts: int,
    good: str = "Category:Good_articles",
    featured: str = "Category:Featured_articles",
) -> DataFrame:
    """Raw dataset from stored listings and responses (title, response).

    Returns one row: how many articles were wanted and how many are there.
    """
    articles = label_articles(
        [(category_pages(members, good), "g", 1), (category_pages(members, featured), "f", 2)]
    )
    pages = flatten_query_response(responses).where(F.col("pageid").isNotNull())
    path = write_raw(assemble_raw(pages, articles), out, run_ts)
    there = read_raw(spark, path)
    gone = missing(articles, there)
    write_lines(gone, f"{run_path(log_dir, run_ts)}/missing_articles", ["articletype", "title"], " ")
    wanted = articles.select(F.lit(1).alias("wanted"), F.lit(0).alias("fetched"))
    fetched = there.select(F.lit(0).alias("wanted"), F.lit(1).alias("fetched"))
    return wanted.unionByName(fetched).agg(
        F.sum("wanted").alias("wanted"), F.sum("fetched").alias("fetched")
    )
