"""Registration of queries and of the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..plans.fixtures import WIKI_DOCS, WIKI_SRC
from ..session import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is already there")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# Tables that texts are or are made of, and what to spread them by when they lie in few files.
_TEXTS = {"documents": "doc_id", "pages": "page_id", "part": "p_partkey"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows, _TEXTS[name]) if name in _TEXTS else rows


def on_src(select: str, *more: str) -> str:
    """SQL over the small page view."""
    return "WITH " + ", ".join([f"wiki_src AS ({WIKI_SRC})", *more]) + f" {select}"


def on_docs(select: str, *more: str) -> str:
    """SQL over the document page view."""
    return "WITH " + ", ".join([f"wiki_docs AS ({WIKI_DOCS})", *more]) + f" {select}"


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def sql_chain(x: str, *steps: tuple[str, str]) -> str:
    """Global regular-expression replacements, one after the other."""
    for pattern, replacement in steps:
        x = f"regexp_replace({x}, '{_quote(pattern)}', '{_quote(replacement)}', 'g')"
    return x


def _quote(text: str) -> str:
    return text.replace("'", "''")
