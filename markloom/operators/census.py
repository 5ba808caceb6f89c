"""Censuses: how often templates and tags are used, overall and per page.

An occurrence table (key, name) comes from one explode of the names inside each
row. Counting then goes through Spark's partial aggregation, so a name that
makes up a third of all uses leaves every task as one row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tags import markup_tag_names, tag_names
from ..functions.templates import census_names, streamline
from ..functions.text import let
from .ranking import ranked


def _template_names(text: str, streamlined: bool) -> Column:
    return census_names(streamline(F.col(text)) if streamlined else F.col(text))


def _tag_names(text: str, streamlined: bool, markup: bool) -> Column:
    source = streamline(F.col(text)) if streamlined else F.col(text)
    if not markup:
        return tag_names(source)
    return let(source, lambda t: F.concat(tag_names(t), markup_tag_names(t)))


def count_names(pages: DataFrame, names: Column) -> DataFrame:
    """(name, n) over all pages."""
    return pages.select(F.explode(names).alias("name")).groupBy("name").agg(F.count("*").alias("n"))


def count_names_by_page(pages: DataFrame, names: Column, keys: Iterable[str]) -> DataFrame:
    """(keys..., name, n) per page, counted inside the row: a page is one row."""
    return pages.select(*keys, F.explode(_counted(names)).alias("use")).select(*keys, "use.name", "use.n")


def _counted(names: Column) -> Column:
    """array<struct<n, name>> of the distinct names, by name."""

    def runs(ordered: Column) -> Column:
        # Where a run of equal names begins; the next beginning, or the end, tells its length.
        starts = F.filter(
            F.transform(ordered, lambda x, i: F.when((i == 0) | (F.get(ordered, i - 1) != x), i)), lambda i: i.isNotNull()
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda i, k: F.struct(
                    (F.coalesce(F.get(at, k + 1), F.size(ordered)) - i).cast("long").alias("n"),
                    F.get(ordered, i).alias("name"),
                ),
            ),
        )

    return let(F.array_sort(names), runs)


def top_names_by_page(pages: DataFrame, names: Column, keys: Iterable[str], k: int) -> DataFrame:
    """(keys..., name, n, rank) of the k most frequent names of each page; ties by name. No shuffle."""
    order = F.transform(_counted(names), lambda e: F.struct((-e["n"]).alias("less"), e["name"].alias("name")))
    top = pages.select(*keys, F.posexplode(F.slice(F.array_sort(order), 1, k)).alias("at", "e"))
    return top.select(*keys, F.col("e.name").alias("name"), (-F.col("e.less")).alias("n"), (F.col("at") + 1).alias("rank"))


def census_totals(pages: DataFrame, names: Column) -> DataFrame:
    """Articles with a name, distinct names and total uses, exactly, without a distinct expansion.

    A page is one row: its first name stands for the page, and the census by name is small.
    """
    uses = pages.select(F.posexplode(_counted(names)).alias("at", "use"))
    first = F.sum(F.when(F.col("at") == 0, 1).otherwise(0)).alias("articles")
    by_name = uses.groupBy("use.name").agg(first, F.sum("use.n").alias("uses"))
    return by_name.agg(
        F.coalesce(F.sum("articles"), F.lit(0)).alias("articles"), F.count("*").alias("names"), F.sum("uses").alias("uses")
    )


# Sketches of 2**18 registers: errors of 0.1 %, and exact up to some ten thousand values.
SKETCH = 18


def census_sketch(pages: DataFrame, names: Column, key: str = "pageid") -> DataFrame:
    """One row to keep beside a census: sketches of its articles and names, and the uses."""
    uses = pages.select(F.col(key).cast("string").alias("key"), F.explode(_counted(names)).alias("use"))
    return uses.agg(
        F.hll_sketch_agg("key", F.lit(SKETCH)).alias("articles"),
        F.hll_sketch_agg("use.name", F.lit(SKETCH)).alias("names"),
        F.sum("use.n").alias("uses"),
    )


def unite_sketches(sketches: DataFrame) -> DataFrame:
    """Approximate articles and names, and uses, over the censuses of several runs."""
    size = lambda c: F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c)
    return sketches.agg(size("articles"), size("names"), F.sum("uses").alias("uses"))


def template_census(
    pages: DataFrame,
    text: str = "wikitext",
    by_article: bool = False,
    keys: Iterable[str] = ("pageid", "title"),
    streamlined: bool = True,
) -> DataFrame:
    names = _template_names(text, streamlined)
    return count_names_by_page(pages, names, keys) if by_article else count_names(pages, names)


def tag_census(
    pages: DataFrame,
    text: str = "wikitext",
    by_article: bool = False,
    keys: Iterable[str] = ("pageid", "title"),
    streamlined: bool = True,
    markup: bool = True,
) -> DataFrame:
    names = _tag_names(text, streamlined, markup)
    return count_names_by_page(pages, names, keys) if by_article else count_names(pages, names)


def document_frequency(
    pages: DataFrame, text: str = "wikitext", streamlined: bool = True
) -> DataFrame:
    """(name, articles): in how many pages each template is used.

    Each page is one row, so its names are made distinct inside the row and the
    rest is a plain count with map-side combine; no distinct shuffle.
    """
    names = F.array_distinct(_template_names(text, streamlined))
    return count_names(pages, names).withColumnRenamed("n", "articles")


def distinct_names(pages: DataFrame, names: Column) -> DataFrame:
    """Per-page number of distinct names, counted in the row."""
    return pages.select("*", F.size(F.array_distinct(names)).cast("long").alias("n_distinct"))


def census_summary(by_page: DataFrame, key: str = "pageid", approximate: bool = False) -> DataFrame:
    """Articles, distinct names and total uses of a per-page census (key, name, n).

    One pass over the census; distinct values are combined in the tasks before
    the shuffle. `approximate` uses sketches and shuffles one row per task.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return by_page.agg(
        distinct(key).alias("articles"), distinct("name").alias("names"), F.sum("n").alias("uses")
    )


def derive_keep_list(
    pages: DataFrame,
    min_articles: int,
    exclude: Iterable[str] = (),
    text: str = "wikitext",
    streamlined: bool = True,
) -> DataFrame:
    """Template names worth keeping: used in enough pages, and no aside.

    `exclude` holds name prefixes of citations, boxes and tables.
    """
    common = document_frequency(pages, text, streamlined).where(F.col("articles") >= min_articles)
    for prefix in exclude:
        common = common.where(~F.col("name").startswith(prefix))
    return common


def keep_by_coverage(pages: DataFrame, percent: int, text: str = "wikitext", streamlined: bool = True) -> DataFrame:
    """(name, n, running): the fewest templates that make up `percent` of all uses, and how many those are so far."""
    used = ranked(template_census(pages, text, streamlined=streamlined), "n", "name", running="n")
    short = (F.col("running") - F.col("n")) * 100 < F.col("whole") * percent
    return used.where(short).select("name", "n", "running")


def sum_counters(counters: DataFrame, column: str) -> DataFrame:
    """Run-wide (name, n) from a map<string, bigint> column."""
    cells = counters.select(F.explode(column).alias("name", "n"))
    return cells.groupBy("name").agg(F.sum("n").alias("n"))
