"""Listings and raw pages: which articles to have, which are there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import py_strip


def category_pages(members: DataFrame, category: str) -> DataFrame:
    """Titles of a category that are articles (namespace 0)."""
    wanted = (F.col("category") == category) & (F.col("namespace") == 0)
    return members.where(wanted).select("title")


def label_articles(listings: list[tuple[DataFrame, str, int]]) -> DataFrame:
    """Union of listings (titles, label, priority); the highest priority labels a title."""
    tagged = [
        titles.select("title", F.lit(label).alias("articletype"), F.lit(priority).alias("priority"))
        for titles, label, priority in listings
    ]
    union = tagged[0]
    for more in tagged[1:]:
        union = union.unionByName(more)
    return union.groupBy("title").agg(F.max_by("articletype", "priority").alias("articletype"))


def assemble_raw(responses: DataFrame, articles: DataFrame) -> DataFrame:
    """Raw page records: content from the response, title and type from the listing.

    A listing is as long as the pages are many, and its files say little of its size in memory: titles are
    compressed there, or put together from other columns. So it is shuffled, never sent whole through the driver.
    """
    return responses.join(articles.hint("merge"), "title").select(
        "pageid", "title", F.lit("en").alias("lang"), "revid", "articletype", "wikitext"
    )


def missing(articles: DataFrame, raw: DataFrame) -> DataFrame:
    """Articles that were asked for but are not there.

    Fetched titles are made distinct first, which combines copies before the shuffle.
    """
    return articles.join(raw.select("title").distinct(), "title", "left_anti")


def merge_sets(a: DataFrame, b: DataFrame, key: str, element: str) -> DataFrame:
    """Keyed sets merged by union, in long form (key, element).

    The long form keeps a hot key spread over many tasks.
    """
    return a.select(key, element).unionByName(b.select(key, element)).distinct()


def lookup_title(raw: DataFrame, title: str | Column) -> DataFrame:
    """The page with this (trimmed) title; of several the one with the largest id."""
    wanted = F.lit(title.strip()) if isinstance(title, str) else py_strip(title)
    return raw.where(F.col("title") == wanted).orderBy(F.desc("pageid")).limit(1)


def members_of(table: DataFrame, names: DataFrame, on: str = "name", keep: bool = True) -> DataFrame:
    """Rows whose name is (or is not) in a set of names."""
    return table.join(names.select(on), on, "left_semi" if keep else "left_anti")


def members_of_policy(table: DataFrame, policy: DataFrame, on: str = "name", keep: bool = True) -> DataFrame:
    """Rows whose policy name is (or is not) kept by a table of rules (kind, name).

    A rule names a template, a prefix up to its first hyphen, or a parser function up to its colon.
    """
    keys = {
        "name": F.col(on),
        "prefix": F.concat(F.substring_index(on, "-", 1), F.lit("-")),
        "function": F.substring_index(on, ":", 1),
    }
    out = table.withColumns({f"_{kind}": key for kind, key in keys.items()})
    for kind in keys:
        rules = policy.where(F.col("kind") == kind).select(F.col("name").alias(f"_{kind}")).distinct()
        out = out.join(rules.withColumn(f"_is_{kind}", F.lit(True)), f"_{kind}", "left")
    kept = F.coalesce(*[F.col(f"_is_{kind}") for kind in keys], F.lit(False))
    return out.where(kept == keep).select(*table.columns)
