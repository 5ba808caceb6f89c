"""Reading raw pages, final pages, comparison corpora and stored API responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import py_strip
from ..schemas import OUT_SCHEMA, PROPS_SCHEMA, QUERY_RESPONSE, RAW_SCHEMA
from .folders import read_folders


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OUT_SCHEMA).parquet(path)


def first_rows(pages: DataFrame, n: int = 2, key: str = "pageid") -> DataFrame:
    return pages.orderBy(key).limit(n)


def read_splits(spark: SparkSession, paths: dict[str, str], text: str = "text") -> DataFrame:
    """(split, text) over all splits of a corpus."""
    parts = [
        spark.read.parquet(path).select(F.lit(split).alias("split"), F.col(text).alias("text"))
        for split, path in paths.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def flatten_query_response(responses: DataFrame, col: str = "response") -> DataFrame:
    """Page id, revision id and markup out of a stored query response.

    The first page and its first revision count; other columns stay.
    """
    body = responses.withColumn("_r", F.from_json(col, QUERY_RESPONSE))
    page = F.get(F.map_values("_r.query.pages"), F.lit(0))
    body = body.withColumn("_p", page).drop("_r")
    rev = F.get(F.col("_p.revisions"), F.lit(0))
    return body.select(
        *[c for c in responses.columns if c != col],
        F.col("_p.pageid").alias("pageid"),
        rev["revid"].alias("revid"),
        rev["slots"]["main"]["*"].alias("wikitext"),
    )


def flatten_expand_response(responses: DataFrame, col: str = "response") -> DataFrame:
    """Expanded markup, trimmed, out of a stored expansion response."""
    text = py_strip(F.get_json_object(col, "$.expandtemplates.wikitext"))
    return responses.withColumn("wikitext", text).drop(col)


_PAGE = r"([^/]+)/[^/]+\z"


def _read_props(spark: SparkSession, where: str) -> DataFrame:
    files = read_folders(spark, where, is_json=True)
    if files is None:
        rows = spark.read.schema(PROPS_SCHEMA).json(where, multiLine=True)
        return rows.withColumn("page", F.regexp_extract(F.input_file_name(), _PAGE, 1))
    # Rows as the reader of files makes them: one of an object or of what is no JSON, several of a list, none of a blank text.
    text, rows = F.col("value").cast("string"), T.ArrayType(PROPS_SCHEMA)
    no_json = F.array(F.lit(None).cast(PROPS_SCHEMA))
    listed = F.coalesce(F.from_json(text, rows), no_json)
    single = F.array(F.from_json(text, PROPS_SCHEMA))
    items = F.when(text.rlike(r"\A\s*\z"), F.array().cast(rows)).when(text.rlike(r"\A\s*\["), listed).otherwise(single)
    return files.select("page", F.explode(items).alias("props")).select("props.*", "page")


def _read_texts(spark: SparkSession, where: str, name: str) -> DataFrame:
    files = read_folders(spark, where)
    if files is None:
        written = spark.read.text(where, wholetext=True)
        return written.select(F.regexp_extract(F.input_file_name(), _PAGE, 1).alias("page"), F.col("value").alias(name))
    return files.select("page", F.col("value").cast("string").alias(name))


def read_goldens(
    spark: SparkSession,
    directory: str,
    texts: str = "*/markdown.md",
    props: str = "*/props.json",
    more: dict[str, str] | None = None,
) -> DataFrame:
    """Expected pages: one folder each, with a Markdown text and its properties.

    `texts` and `props` say where both lie below `directory`; the name of the
    folder they are in is the page. `more` names further text columns and where they lie, such as the
    markup as fetched (`*/raw.txt`) or as expanded (`*/wikitext.txt`). A page with some of its files has
    nulls for the others.
    """
    rows = _read_props(spark, f"{directory}/{props}")
    for name, where in {"markdown": texts, **(more or {})}.items():
        rows = rows.join(_read_texts(spark, f"{directory}/{where}", name), "page", "full")
    return rows
