"""Sources, listings and set logic."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dims import REMOVED_SECTIONS, TemplatePolicy, lower_first
from ..functions.sections import section_table
from ..functions.templates import census_name, policy_names, raw_names, template_name, template_occurrences
from ..functions.text import nfkc
from ..operators import catalog
from ..operators.quality import to_output
from ..operators.ranking import peek
from ..plans.fixtures import wiki_src
from ..session import spread, work_dir
from ..sources.folders import write_folders
from ..sources.readers import (
    first_rows,
    flatten_expand_response,
    flatten_query_response,
    read_goldens,
    read_pages,
    read_raw,
    read_splits,
)
from ..sources.writers import write_pages, write_raw
from .registry import on_src, query, table

DOC_PAGES = """
SELECT doc_id AS pageid, concat('Doc ', CAST(doc_id AS VARCHAR)) AS title, doc_id + 1 AS revid,
 CASE WHEN doc_id % 4 = 0 THEN NULL ELSE source END AS description,
 [lang, source] AS categories, text AS markdown FROM documents
"""


def doc_pages(spark, sf_dir):
    """Documents in the shape of the final dataset."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("pageid"),
        F.concat(F.lit("Doc "), F.col("doc_id")).alias("title"),
        (F.col("doc_id") + 1).alias("revid"),
        F.when(F.col("doc_id") % 4 != 0, F.col("source")).alias("description"),
        F.array("lang", "source").alias("categories"),
        F.col("text").alias("markdown"),
    )


@query("src1_raw_scan", on_src("SELECT * FROM wiki_src"))
def _(spark, sf_dir):
    return read_raw(spark, write_raw(wiki_src(spark, sf_dir), work_dir(spark, "raw")))


@query(
    "src2_category_pages",
    "SELECT concat('Doc ', CAST(doc_id AS VARCHAR)) AS title FROM documents "
    "WHERE source = 'src1' AND lang = 'en'",
)
def _(spark, sf_dir):
    members = table(spark, sf_dir, "documents").select(
        F.col("source").alias("category"),
        F.when(F.col("lang") == "en", 0).otherwise(14).alias("namespace"),
        F.concat(F.lit("Doc "), F.col("doc_id")).alias("title"),
    )
    return catalog.category_pages(members, "src1")


def responses(spark, sf_dir):
    """Stored API responses made from the page view."""
    main = F.struct(F.col("wikitext").alias("*"))
    rev = F.struct("revid", F.struct(main.alias("main")).alias("slots"))
    page = F.struct("pageid", F.array(rev).alias("revisions"))
    body = F.struct(
        F.struct(F.create_map(F.col("pageid").cast("string"), page).alias("pages")).alias("query")
    )
    return wiki_src(spark, sf_dir).select("title", F.to_json(body).alias("response"))


@query("src3_flatten_query_response", on_src("SELECT title, pageid, revid, wikitext FROM wiki_src"))
def _(spark, sf_dir):
    return flatten_query_response(responses(spark, sf_dir))


@query("src4_flatten_expand_response", "SELECT p_partkey AS pageid, p_name AS wikitext FROM part")
def _(spark, sf_dir):
    text = F.concat(F.lit(" \n\t"), F.col("p_name"), F.lit(" \n"))
    body = F.struct(F.struct(text.alias("wikitext")).alias("expandtemplates"))
    stored = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("pageid"), F.to_json(body).alias("response")
    )
    return flatten_expand_response(stored)


@query(
    "src5_read_splits",
    "SELECT 'train' AS split, text FROM documents UNION ALL SELECT 'test', text FROM benchmark "
    "UNION ALL SELECT 'validation', text FROM conversations",
)
def _(spark, sf_dir):
    names = {"train": "documents", "test": "benchmark", "validation": "conversations"}
    return read_splits(spark, {s: f"{sf_dir}/{t}.parquet" for s, t in names.items()})


@query(
    "src6_first_rows",
    "SELECT pageid, title, revid, description, array_to_string(categories, '|') AS categories, markdown "
    f"FROM ({DOC_PAGES}) ORDER BY pageid LIMIT 2",
)
def _(spark, sf_dir):
    path = write_pages(doc_pages(spark, sf_dir), work_dir(spark, "pages"))
    head = first_rows(read_pages(spark, path), 2)
    return head.withColumn("categories", F.array_join("categories", "|"))


@query(
    "src7_read_goldens",
    "SELECT s_suppkey AS pageid, concat('page=', CAST(s_suppkey AS VARCHAR)) AS page, s_name AS title, "
    "concat('# ', s_name, chr(10)) AS markdown FROM supplier",
)
def _(spark, sf_dir):
    base = work_dir(spark, "goldens")
    supplier = spread(table(spark, sf_dir, "supplier"), "s_suppkey")
    pages = supplier.withColumn("page", F.col("s_suppkey"))
    write_folders(pages.select("page", F.concat(F.lit("# "), "s_name").alias("value")), f"{base}/md", "page")
    props = F.to_json(F.struct(F.col("s_suppkey").alias("pageid"), F.col("s_name").alias("title")))
    write_folders(pages.select("page", props.alias("value")), f"{base}/props", "page")
    found = read_goldens(spark, base, "md/*/*.txt", "props/*/*.txt")
    return found.select("pageid", "page", "title", "markdown")


@query(
    "prj1_lookup_title",
    on_src(
        "SELECT * FROM wiki_src WHERE title = (SELECT min(p_name) FROM part) "
        "ORDER BY pageid DESC LIMIT 1"
    ),
)
def _(spark, sf_dir):
    pages = wiki_src(spark, sf_dir)
    smallest = pages.agg(F.min("title")).first()[0]
    return catalog.lookup_title(pages, f"  {smallest} ")


@query(
    "prj2_to_output",
    "SELECT pageid, title, revid, description, array_to_string(categories, '|') AS categories, markdown "
    f"FROM ({DOC_PAGES})",
)
def _(spark, sf_dir):
    wide = doc_pages(spark, sf_dir).withColumns({"lang": F.lit("en"), "raw": F.col("markdown")})
    return to_output(wide).withColumn("categories", F.array_join("categories", "|"))


@query(
    "prj5_peek",
    "SELECT doc_id, text FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS rn FROM documents) "
    "WHERE rn = 64",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return peek(docs, "doc_id", 100, -37)


@query("prj6_assemble_raw", on_src("SELECT * FROM wiki_src"))
def _(spark, sf_dir):
    # Titles repeat in the page view, so the page id makes them unique here.
    named = F.concat_ws("#", "title", "pageid")
    stored = flatten_query_response(responses(spark, sf_dir)).withColumn("title", named)
    listing = wiki_src(spark, sf_dir).select(named.alias("title"), "articletype")
    raw = catalog.assemble_raw(stored, listing)
    return raw.withColumn("title", F.substring_index("title", "#", 1))


@query("prj7_title_nfkc", "SELECT p_partkey, concat(p_name, ' fix 2') AS title FROM part")
def _(spark, sf_dir):
    named = F.concat("p_name", F.lit(" ﬁx ²"))
    part = table(spark, sf_dir, "part").select("p_partkey", named.alias("title"))
    return part.withColumn("title", nfkc(F.col("title")))


def _listings(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    title = F.concat(F.lit("Doc "), F.col("doc_id")).alias("title")
    return labels.where("quality = 1").select(title), labels.where("toxic = 1").select(title)


_LABELLED = (
    "SELECT concat('Doc ', CAST(doc_id AS VARCHAR)) AS title, "
    "CASE WHEN toxic = 1 THEN 'f' ELSE 'g' END AS articletype FROM labels "
    "WHERE quality = 1 OR toxic = 1"
)


@query("jn1_label_articles", _LABELLED)
def _(spark, sf_dir):
    good, featured = _listings(spark, sf_dir)
    return catalog.label_articles([(good, "g", 1), (featured, "f", 2)])


@query(
    "jn2_members_of_sections",
    on_src(
        "SELECT pageid, heading FROM wiki_src, (VALUES ('references'), ('citations')) AS v(heading)"
    ),
)
def _(spark, sf_dir):
    parts = section_table(wiki_src(spark, sf_dir)).select("pageid", "heading")
    names = spark.createDataFrame([(n,) for n in REMOVED_SECTIONS], "heading string")
    return catalog.members_of(parts, names, "heading")


def _uses(spark, sf_dir):
    """Template uses under their census name, with the policy name that decides."""
    raw = template_occurrences(wiki_src(spark, sf_dir), names=raw_names)
    return raw.withColumn("policy", template_name(F.col("name"))).withColumn("name", census_name(F.col("name")))


@query(
    "jn2_members_of_kept_templates",
    on_src(
        "SELECT pageid, name FROM wiki_src, (VALUES ('convert'), ('val')) AS v(name)"
    ),
)
def _(spark, sf_dir):
    rules = TemplatePolicy.default().table(spark)
    return catalog.members_of_policy(_uses(spark, sf_dir), rules, "policy").drop("policy")


@query(
    "jn2_members_of_dropped_templates",
    on_src(
        "SELECT pageid, name FROM wiki_src, (VALUES ('short description'), ('infobox part'), "
        "('cite web'), ('reflist')) AS v(name) UNION ALL "
        "SELECT pageid, concat('unknown_tpl', CAST(pageid % 5 AS VARCHAR)) FROM wiki_src"
    ),
)
def _(spark, sf_dir):
    rules = TemplatePolicy.default().table(spark)
    return catalog.members_of_policy(_uses(spark, sf_dir), rules, "policy", keep=False).drop("policy")


# One use a page, of names that only their own spelling, the prefix or a function keeps.
_USES = ("ndash", "Birth_date", "AGO", "flagIOC", "lang-de", "#if:a", "cite web", "Ago")
_USED = ("ndash", "birth date", "aGO", "flagIOC", "lang-de", "#if:a", "cite web", "ago")


@query(
    "jn2_members_of_policy",
    "SELECT p_partkey AS pageid, "
    f"[{', '.join(repr(n) for n in _USED)}][p_partkey % 8 + 1] AS name, p_partkey % 8 < 6 AS kept FROM part",
)
def _(spark, sf_dir):
    name = F.get(F.array(*[F.lit(n) for n in _USES]), (F.col("p_partkey") % 8).cast("int"))
    text = F.concat("p_name", F.lit(" {{"), name, F.lit("|x}}"))
    pages = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pageid"), text.alias("wikitext"))
    uses = template_occurrences(pages, names=policy_names)
    rules = TemplatePolicy.default().table(spark)
    kept, rest = (catalog.members_of_policy(uses, rules, keep=k).withColumn("kept", F.lit(k)) for k in (True, False))
    return kept.unionByName(rest)


@query(
    "f15_country_templates",
    "SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN 'aGO' WHEN 1 THEN 'dEN' WHEN 2 THEN 'uSSR' "
    "WHEN 3 THEN 'xXX' ELSE 'hKG-CHN' END AS name, c_nationkey % 5 <> 3 AS kept FROM customer",
)
def _(spark, sf_dir):
    codes = [lower_first(code) for code in ("AGO", "DEN", "USSR", "XXX", "HKG-CHN")]
    pick = F.get(F.array(*[F.lit(c) for c in codes]), (F.col("c_nationkey") % 5).cast("int"))
    named = table(spark, sf_dir, "customer").select("c_custkey", pick.alias("name"))
    return named.withColumn("kept", TemplatePolicy.default().keeps(F.col("name")))


@query(
    "jn3_merge_sets",
    "SELECT DISTINCT p_brand AS key, p_type AS element FROM part "
    "UNION SELECT DISTINCT p_brand, p_name FROM part",
)
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    a = part.select(F.col("p_brand").alias("key"), F.col("p_type").alias("element"))
    b = part.select(F.col("p_brand").alias("key"), F.col("p_name").alias("element"))
    return catalog.merge_sets(a, b, "key", "element")


@query(
    "jn6_missing_articles",
    f"SELECT * FROM ({_LABELLED}) WHERE title NOT IN "
    "(SELECT concat('Doc ', CAST(doc_id AS VARCHAR)) FROM documents WHERE lang = 'en')",
)
def _(spark, sf_dir):
    good, featured = _listings(spark, sf_dir)
    articles = catalog.label_articles([(good, "g", 1), (featured, "f", 2)])
    docs = table(spark, sf_dir, "documents").where("lang = 'en'")  # the others were not fetched
    fetched = docs.select(F.concat(F.lit("Doc "), F.col("doc_id")).alias("title"))
    return catalog.missing(articles, fetched)

