"""Template expansion from a stored dictionary instead of a remote service."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.templates import invocation_segments
from ..functions.text import built_once, py_strip
from ..session import through_table

def one_per_invocation(expansions: DataFrame) -> DataFrame:
    return expansions.groupBy("invocation").agg(F.max("expansion").alias("expansion"))


def _splice(segments: Column, pick) -> Column:
    """Segments back to one text, with `pick(segment, n)` for the n-th template."""
    return F.array_join(
        F.transform(
            segments,
            lambda s, i: F.when(i % 2 == 1, pick(s, ((i - 1) / 2).cast("int"))).otherwise(s),
        ),
        "",
    )


@built_once
def _segments(text: str) -> Column:
    return invocation_segments(F.col(text))


def expand_by_dictionary(
    pages: DataFrame,
    expansions: DataFrame | None,
    text: str = "wikitext",
    out: str = "expanded",
) -> DataFrame:
    """Replace every outermost template by its expansion; unmatched ones vanish.

    Adds `out` (trimmed) and `unmatched`, the number of templates without an entry. Without a
    dictionary that is a narrow stage.

    With one, of any size, the pages are written once, each with a number of its own: whatever made them is
    not computed again, and page ids may repeat. The different uses are written too, and only the entries of those
    go on: Spark sends the uses to the dictionary if they are few, so that it is read where it lies, however long
    it is, and shuffles both once otherwise. The entries in use then meet the uses, those of a hot template split
    (AQE). One row per page goes back to its text.
    """
    segs = _segments(text)
    if expansions is None:
        uses = ((F.size("_segments") - 1) / 2).cast("long")
        spliced = _splice(F.col("_segments"), lambda s, _: F.lit(""))
        return pages.withColumn("_segments", segs).withColumns({out: py_strip(spliced), "unmatched": uses}).drop("_segments")

    pages = through_table(pages.withColumn("_row", F.monotonically_increasing_id()), "expanding")
    uses = pages.select("_row", F.posexplode(F.filter(segs, lambda _, i: i % 2 == 1)).alias("pos", "invocation"))
    asked = through_table(uses.select("invocation").distinct(), "asked")
    entries = one_per_invocation(expansions.join(asked, "invocation", "left_semi"))
    # The expansions of one page, in the order of its templates.
    found = (
        uses.join(entries, "invocation", "left")
        .groupBy("_row")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "expansion"))).alias("_found"))
        .withColumn("_found", F.transform("_found", lambda e: e["expansion"]))
        .withColumn("unmatched", F.size(F.filter("_found", lambda e: e.isNull())).cast("long"))
    )
    spliced = _splice(segs, lambda _, n: F.coalesce(F.get(F.col("_found"), n), F.lit("")))
    joined = pages.join(found, "_row", "left")
    return joined.withColumns(
        {out: py_strip(spliced), "unmatched": F.coalesce("unmatched", F.lit(0).cast("long"))}
    ).drop("_found", "_row")
