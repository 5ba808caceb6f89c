"""Corpus statistics: characters, words, tokens, sizes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import PY_WS, approx_tokens, nfkc, py_split


# Characters counted at a time; bounds the memory of a task whatever the batch size.
CHUNK = 1 << 22


def char_freq(df: DataFrame, col: str, chunk: int = CHUNK) -> DataFrame:
    """(char, n) over all texts.

    Texts are counted as arrays of code points, so a task hands one row per
    distinct character to the shuffle instead of one per character.
    """

    # All of it is inside, so that it travels to the executors by value.
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}

        def add(texts: list[str]) -> None:
            points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
            counts = np.bincount(points)
            for point in np.flatnonzero(counts).tolist():
                total[point] = total.get(point, 0) + int(counts[point])

        held, size = [], 0
        for text in (t.as_py() for batch in batches for t in batch.column(0) if t.is_valid):
            held.append(text)
            size += len(text)
            if size >= chunk:
                add(held)
                held, size = [], 0
        add(held)
        chars = pa.array([chr(p) for p in total], type=pa.string())
        yield pa.record_batch([chars, pa.array(total.values(), type=pa.int64())], ["char", "n"])

    partial = df.select(col).mapInArrow(count, "char string, n bigint")
    return partial.groupBy("char").agg(F.sum("n").alias("n"))


def word_freq(df: DataFrame, col: str) -> DataFrame:
    """(word, n) over all texts; words are split at whitespace."""
    words = df.select(F.explode(py_split(F.col(col))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def _size_columns(col: str) -> dict:
    c = F.col(col)
    return {
        "chars": F.length(c).cast("long"),
        "words": F.regexp_count(c, F.lit(f"{_NOT_WS}+")).cast("long"),
        "tokens": approx_tokens(c).cast("long"),
    }


_NOT_WS = "[^" + PY_WS[1:]


def corpus_size(df: DataFrame, col: str) -> DataFrame:
    """Rows, characters, words and approximate tokens, in one pass."""
    sizes = df.select(*[e.alias(name) for name, e in _size_columns(col).items()])
    return sizes.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"),
        F.coalesce(F.sum("words"), F.lit(0)).alias("words"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
    )


def total(df: DataFrame, col: str, what: str) -> DataFrame:
    """One of the totals alone: chars, words or tokens."""
    return df.select(_size_columns(col)[what].alias(what)).agg(F.sum(what).alias(what))


def corpus_ratio(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Tokens of corpus a relative to corpus b; b is NFKC-normalised first."""
    left = a.select(F.lit("a").alias("corpus"), approx_tokens(F.col(col)).cast("long").alias("t"))
    normal = b.select(nfkc(F.col(col)).alias(col))
    right = normal.select(F.lit("b").alias("corpus"), approx_tokens(F.col(col)).cast("long").alias("t"))
    sums = left.unionByName(right).agg(
        F.sum(F.when(F.col("corpus") == "a", F.col("t"))).alias("tokens_a"),
        F.sum(F.when(F.col("corpus") == "b", F.col("t"))).alias("tokens_b"),
    )
    return sums.withColumn("ratio", F.col("tokens_a") / F.col("tokens_b"))


def dataset_card(pages: DataFrame, col: str = "markdown") -> DataFrame:
    """Size of the final dataset, description coverage, categories per page."""
    sizes = pages.select(
        *[e.alias(name) for name, e in _size_columns(col).items()],
        F.col("description").isNotNull().cast("long").alias("described"),
        F.size("categories").cast("long").alias("n_categories"),
    )
    return sizes.agg(
        F.count("*").alias("n_rows"),
        F.sum("chars").alias("chars"),
        F.sum("words").alias("words"),
        F.sum("tokens").alias("tokens"),
        F.sum("described").alias("described"),
        F.avg("n_categories").alias("categories_per_page"),
    )


def row_count(spark: SparkSession, path: str) -> DataFrame:
    """(n_rows) of a Parquet table out of the footers of its files; no data is read.

    The counting goes to the Parquet source, which only its second version does; the settings for it
    stay in a session of their own.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.count("*").alias("n_rows"))


def chunk_count(rows: DataFrame, chunk: int) -> DataFrame:
    """Adds the number of chunks of that size to a row count."""
    return rows.withColumn("n_chunks", F.ceil(F.col("n_rows") / chunk).cast("long"))


def run_size(df: DataFrame, chunk: int) -> DataFrame:
    """Row count and the number of chunks of that size."""
    return chunk_count(df.agg(F.count("*").alias("n_rows")), chunk)
