"""Template policies out of tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dims import ListedPolicy
from ..functions.templates import apply_template_policy, asked_names
from ..session import through_table


def with_listed_names(pages: DataFrame, names: DataFrame, text: str = "wikitext", out: str = "listed") -> DataFrame:
    """Adds `out`: those of a page's own template names that the first column of `names` has.

    The pages are written once, each with a number of its own, since page ids may repeat. Only the different names
    of each page meet the table; Spark sends a small one to them and splits the pages of a hot name
    otherwise (AQE). The answers of a page are one row, never more than its own names. Null and
    repeated names in the table are harmless; a null text has no names.
    """
    numbered = pages.withColumns({"_row": F.monotonically_increasing_id(), "_asked": asked_names(F.col(text))})
    numbered = through_table(numbered, "policy")
    first = F.col(names.columns[0])
    lowered = F.concat(F.lower(F.substring(first, 1, 1)), first.substr(F.lit(2), F.length(first)))
    rules = names.select(lowered.alias("_name")).distinct()
    listed = (
        numbered.select("_row", F.explode("_asked").alias("_name"))
        .join(rules, "_name", "left_semi")
        .groupBy("_row").agg(F.collect_list("_name").alias(out))
    )
    none = F.array().cast("array<string>")
    return numbered.drop("_asked").join(listed, "_row", "left").withColumn(out, F.coalesce(out, none)).drop("_row")


def keep_listed_templates(pages: DataFrame, names: DataFrame, text: str = "wikitext") -> DataFrame:
    """Remove every template whose name is neither in the table nor kept by the prefix or as a parser function."""
    listed = with_listed_names(pages, names, text, "_listed")
    return listed.withColumn(text, apply_template_policy(F.col(text), ListedPolicy("_listed"))).drop("_listed")
