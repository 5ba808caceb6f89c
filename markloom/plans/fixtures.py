"""Wiki markup derived from the given tables, for queries and tests.

Each text is one SQL expression that Spark and other engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread

WIKI_SRC = """
SELECT p_partkey AS pageid, p_name AS title, 'en' AS lang, p_partkey*10+1 AS revid,
 CASE WHEN p_size % 3 = 0 THEN 'f' ELSE 'g' END AS articletype,
 concat(
  '{{Short description|', p_type, '}}', chr(10),
  '{{Infobox part|brand=', p_brand, '|size={{convert|', CAST(p_size AS STRING), '|mm}}}}', chr(10),
  '<!-- note ', CAST(p_partkey AS STRING), ' -->', 'The [[', p_name, '|', p_brand, ']] costs {{val|',
    CAST(p_size AS STRING), '}}.{{cite web|url=x', CAST(p_partkey % 7 AS STRING), '}}<ref>r</ref>', chr(10), chr(10),
  '== Usage ==', chr(10), '__NOTOC__* item one {{Unknown_tpl', CAST(p_partkey % 5 AS STRING), '}}', chr(10),
  '* [[File:a.png|thumb]]', chr(10), chr(10),
  '=== Detail ===', chr(10),
  'Some <b>bold</b> <q>quoted</q> H<sub>2</sub>O [http://e.org link] [http://e.org/x]', chr(10), chr(10),
  '== References ==', chr(10), '{{reflist}}', chr(10), '=== Citations ===', chr(10), 'ref text', chr(10), chr(10),
  '[[Category:', p_brand, ']]', chr(10), '[[Category:', p_type, '|key]]', chr(10)
 ) AS wikitext
FROM part
"""

# Whole document texts inside page markup: lead, body, lists, table, references.
WIKI_DOCS = """
SELECT doc_id AS pageid, concat('Doc ', CAST(doc_id AS STRING)) AS title, 'en' AS lang, doc_id*10+1 AS revid,
 CASE WHEN doc_id % 5 = 0 THEN 'f' ELSE 'g' END AS articletype,
 concat(
  '{{Short description|Text from ', source, '}}', chr(10),
  '{{Infobox text|source=', source, '|length={{convert|', CAST(n_chars AS STRING), '|m}}}}', chr(10),
  'A [[', source, '|text]] in [[', lang, ']].<ref name="r1">{{cite web|url=y}}</ref>', chr(10), chr(10),
  '== Body ==', chr(10), text, chr(10), chr(10),
  '{| class="wikitable"', chr(10), '| cell [[', lang, ']]', chr(10), '|}', chr(10),
  '=== Facts ===', chr(10), '# first {{nowrap|{{val|', CAST(n_chars AS STRING), '}} marks}}', chr(10),
  '# second <small>[[Image:b.png|40px|in [[', lang, ']] text]]small</small>', chr(10),
  '** sub item', chr(10), chr(10),
  '== References ==', chr(10), '{{reflist}}', chr(10), 'gone', chr(10), chr(10),
  '[[Category:', source, ']]', chr(10), '[[category: ', lang, ' texts |x]]', chr(10)
 ) AS wikitext
FROM documents
"""


def _derive(spark: SparkSession, sf_dir: str, table: str, key: str, sql: str) -> DataFrame:
    rows = spread(spark.read.parquet(f"{sf_dir}/{table}.parquet"), key)
    # `SELECT ... FROM table` over a DataFrame, without registering a view.
    columns = sql.strip().removeprefix("SELECT").removesuffix(f"FROM {table}").strip()
    return rows.select(F.expr(f"struct({columns})").alias("row")).select("row.*")


def wiki_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "part", "p_partkey", WIKI_SRC)


def wiki_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, "documents", "doc_id", WIKI_DOCS)
