"""Top lists and positions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import through_table


def top_k(df: DataFrame, by: str, tie: str, k: int) -> DataFrame:
    """The k largest rows; ties by name, ascending. Each task keeps k rows."""
    return df.orderBy(F.desc(by), F.asc(tie)).limit(k)


def top_k_per(df: DataFrame, part: list[str] | str, by: str, tie: str, k: int) -> DataFrame:
    """The k largest rows of every group.

    Filtering on the rank lets Spark cut each group to k rows before the shuffle,
    so a hot group arrives small.
    """
    part = [part] if isinstance(part, str) else part
    order = Window.partitionBy(*part).orderBy(F.desc(by), F.asc(tie))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def full_ranking(df: DataFrame, by: str, tie: str) -> DataFrame:
    """All rows in descending order, sorted in ranges across tasks."""
    return df.orderBy(F.desc(by), F.asc(tie))


# What monotonically_increasing_id leaves for the rows of a partition.
_WITHIN = 33


def ranked(df: DataFrame, by: str, tie: str, running: str | None = None) -> DataFrame:
    """Every row with its place in the whole descending order: `rank` from 1 `of` all rows; ties by name.

    With `running`, also the sum of that column up to the row (`running`) and over all rows (`whole`).

    Rows are sorted in ranges across tasks and written once, with their range and place in it. Every range
    gives one row with its size, and the sizes before a range, added up, are sent back to it: as many rows as
    there are ranges. No task holds more than a range. Nulls come last; rows equal in both columns have any order.
    """
    order = (F.desc(by), F.asc(tie))
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = through_table(ordered.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    rows = rows.withColumns({"_range": F.shiftright("_at", _WITHIN), "_at": F.col("_at").bitwiseAND((1 << _WITHIN) - 1)})
    added = F.coalesce(F.sum(running), F.lit(0)) if running else F.lit(0)
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_n"), added.cast("long").alias("_sum"))
    ranges = sizes.agg(F.array_sort(F.collect_list(F.struct("_range", "_n", "_sum"))).alias("all"))
    zero = F.lit(0).cast("long")
    kind = "array<struct<_range:bigint,_before:bigint,_sum_before:bigint>>"
    start = F.struct(zero.alias("n"), zero.alias("s"), F.array().cast(kind).alias("out"))

    def step(acc, r):
        before = F.struct(r["_range"].alias("_range"), acc["n"].alias("_before"), acc["s"].alias("_sum_before"))
        return F.struct(
            (acc["n"] + r["_n"]).alias("n"), (acc["s"] + r["_sum"]).alias("s"), F.concat(acc["out"], F.array(before)).alias("out")
        )

    starts = (
        ranges.select(F.aggregate("all", start, step).alias("all"))
        .select(F.explode("all.out").alias("start"), F.col("all.n").alias("of"), F.col("all.s").alias("whole"))
        .select("start.*", "of", "whole")
    )
    out = rows.join(F.broadcast(starts), "_range").withColumn("rank", F.col("_before") + F.col("_at") + 1)
    if not running:
        return out.select(*df.columns, "rank", "of")
    sofar = F.sum(running).over(Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    out = out.withColumn("running", F.col("_sum_before") + F.coalesce(sofar, zero))
    return out.select(*df.columns, "rank", "of", "running", "whole")


def at_places(rows: DataFrame, places: Iterable[int]) -> DataFrame:
    """The rows of `ranked` at some places; negative places count from the end, places beyond it give nothing."""
    places = list(places)
    there = F.col("rank").isin([p for p in places if p > 0])
    return rows.where(there | (F.col("rank") - F.col("of") - 1).isin([p for p in places if p < 0]))


def peek(df: DataFrame, key: str, first_n: int, position: int) -> DataFrame:
    """One row out of the first `first_n` by key; a negative position counts from the end.

    Only `first_n` rows survive the top-n step; the position is found among those.
    """
    at = position if position >= 0 else first_n + position
    return df.orderBy(key).limit(first_n).orderBy(key).offset(at).limit(1)
