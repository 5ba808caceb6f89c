"""Outcomes of a run: routing, retries, summaries, comparison with expected pages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OUT_COLUMNS = ("pageid", "title", "revid", "description", "categories", "markdown")


def to_output(converted: DataFrame) -> DataFrame:
    return converted.select(*OUT_COLUMNS)


def with_status(converted: DataFrame, status: str) -> DataFrame:
    """Pages of one outcome: ok, corrupt or failed."""
    return converted.where(F.col("status") == status)


def retry_input(raw: DataFrame, converted: DataFrame, key: str = "pageid") -> DataFrame:
    """Raw rows to run again: the failed ones. Corrupt pages stay corrupt."""
    failed = with_status(converted, "failed").select(key)
    return raw.join(failed, key, "left_semi")


def run_summary(converted: DataFrame) -> DataFrame:
    status = F.col("status")
    return converted.agg(
        F.count("*").alias("total"),
        F.count_if(status == "ok").alias("ok"),
        F.count_if(status == "corrupt").alias("corrupt"),
        F.count_if(status == "failed").alias("failed"),
    )


def golden_diff(
    actual: DataFrame, expected: DataFrame, key: str, cols: Iterable[str]
) -> DataFrame:
    """One row per differing column: (key, mismatch).

    A page that exists on one side only is reported as `missing` or `unexpected`.
    Texts are compared by digest, so they don't travel.
    """
    cols = list(cols)

    def side(df: DataFrame, name: str) -> DataFrame:
        short = [F.sha2(c, 256).alias(c) if df.schema[c].dataType == T.StringType() else F.col(c) for c in cols]
        return df.select(key, F.struct(*short).alias(name))

    a, e = side(actual, "a"), side(expected, "e")
    checks = [F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"e.{c}")), F.lit(c)) for c in cols]
    found = (
        F.when(F.col("a").isNull(), F.array(F.lit("missing")))
        .when(F.col("e").isNull(), F.array(F.lit("unexpected")))
        .otherwise(F.array_compact(F.array(*checks)))
    )
    return a.join(e, key, "full").select(key, F.explode(found).alias("mismatch"))
