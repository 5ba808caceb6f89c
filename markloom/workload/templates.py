"""Template operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import templates as tpl
from ..functions.dims import BIG_PREFIXES, TemplatePolicy
from ..operators.expand import expand_by_dictionary
from ..operators.policy import keep_listed_templates
from ..plans.fixtures import wiki_docs, wiki_src
from .registry import on_docs, on_src, query, sql_chain, sql_strip, table

_PAIR = r"(?:[^{}]|\{\{[^{}]*\}\})*\}\}"
DROPPED_SRC = rf"\{{\{{(?:Short description|Infobox part|cite web|Unknown_tpl|reflist){_PAIR}"
DROPPED_DOCS = rf"\{{\{{(?:Short description|Infobox text|cite web|reflist){_PAIR}"


@query(
    "f10_magic_templates",
    on_src("SELECT pageid, concat(wikitext, ' a | b ', '|}', ' c ', '|}', ' {{Bend}}') AS wikitext FROM wiki_src"),
)
def _(spark, sf_dir):
    magic = F.concat("wikitext", F.lit(" a {{!}} b {{End}} c {{jctbtm}} {{Bend}}"))
    return wiki_src(spark, sf_dir).select("pageid", tpl.magic_templates(magic).alias("wikitext"))


_RAW = on_src(
    "SELECT pageid, raw, {name} AS name FROM raws",
    r"raws AS (SELECT pageid, unnest(regexp_extract_all(concat(wikitext, '{{ Cite_x y|1}}{{ZZ_top }}'), "
    r"'\{\{([^{}|]*)', 1)) AS raw FROM wiki_src)",
)


def _raws(spark, sf_dir):
    text = F.concat("wikitext", F.lit("{{ Cite_x y|1}}{{ZZ_top }}"))
    return wiki_src(spark, sf_dir).select("pageid", F.explode(tpl.raw_names(text)).alias("raw"))


@query(
    "f11_template_name",
    _RAW.replace("{name}", "trim(replace(concat(lower(raw[1]), raw[2:]), '_', ' '))"),
)
def _(spark, sf_dir):
    return _raws(spark, sf_dir).withColumn("name", tpl.template_name(F.col("raw")))


@query("f12_census_name", _RAW.replace("{name}", "lower(trim(raw))"))
def _(spark, sf_dir):
    return _raws(spark, sf_dir).withColumn("name", tpl.census_name(F.col("raw")))


@query(
    "f13_parser_functions",
    "SELECT p_partkey, name, split_part(name, ':', 1) IN ('#if', 'formatnum', '#switch') AS is_function "
    "FROM (SELECT p_partkey, unnest([concat('#if:', p_name), concat('formatnum:', p_size), p_name, "
    "concat('x#if:', p_type), concat('#switch', '')]) AS name FROM part)",
)
def _(spark, sf_dir):
    names = F.array(
        F.concat(F.lit("#if:"), "p_name"),
        F.concat(F.lit("formatnum:"), "p_size"),
        F.col("p_name"),
        F.concat(F.lit("x#if:"), "p_type"),
        F.lit("#switch"),
    )
    part = table(spark, sf_dir, "part").select("p_partkey", F.explode(names).alias("name"))
    return part.withColumn("is_function", tpl.is_parser_function(F.col("name")))


@query(
    "f14_template_policy",
    on_src(f"SELECT pageid, {sql_chain('wikitext', (DROPPED_SRC, ''))} AS wikitext FROM wiki_src"),
)
def _(spark, sf_dir):
    kept = tpl.apply_template_policy(F.col("wikitext"), TemplatePolicy.default())
    return wiki_src(spark, sf_dir).select("pageid", kept.alias("wikitext"))


@query(
    "f14_template_policy_documents",
    on_docs(f"SELECT pageid, {sql_chain('wikitext', (DROPPED_DOCS, ''))} AS wikitext FROM wiki_docs"),
)
def _(spark, sf_dir):
    kept = tpl.apply_template_policy(F.col("wikitext"), TemplatePolicy.default())
    return wiki_docs(spark, sf_dir).select("pageid", kept.alias("wikitext"))


@query(
    "f14_template_policy_deep",
    "SELECT p_partkey, concat(repeat('{{nowrap|', 20 + p_size), p_name, repeat('}}', 20 + p_size)) AS text FROM part",
)
def _(spark, sf_dir):
    """Kept templates as deep as a part is large, with dropped ones innermost and on the way out."""
    depth = F.col("p_size") + 20
    text = F.concat(
        F.repeat(F.lit("{{nowrap|"), depth), "p_name", F.lit("{{cite web|url={{x}}}}"), F.repeat(F.lit("}}{{y|a}}"), depth)
    )
    part = table(spark, sf_dir, "part").select("p_partkey", text.alias("text"))
    return part.withColumn("text", tpl.apply_template_policy(F.col("text"), TemplatePolicy.default()))


@query(
    "f14_template_policy_custom",
    on_src(
        "SELECT pageid, "
        + sql_chain("wikitext", (rf"\{{\{{(?:Short description|val|reflist|convert|Unknown_tpl[1-4]){_PAIR}", ""))
        + " AS wikitext FROM wiki_src"
    ),
)
def _(spark, sf_dir):
    """A policy read from a table: three names stay."""
    names = table(spark, sf_dir, "part").select(
        F.explode(F.array(F.lit("Infobox part"), F.lit("cite web"), F.lit("unknown tpl0"))).alias("name")
    )
    return keep_listed_templates(wiki_src(spark, sf_dir).select("pageid", "wikitext"), names)


@query(
    "f14_template_policy_table",
    "WITH listed AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderstatus = 'F') "
    "SELECT l_orderkey, l_linenumber, CASE WHEN a.k IS NULL THEN '' ELSE concat('{{Order ', l_orderkey, '|x ', "
    "CASE WHEN b.k IS NULL THEN '' ELSE concat('{{order_', l_partkey, '}}') END, '}}') END AS text "
    "FROM lineitem LEFT JOIN listed a ON a.k = l_orderkey LEFT JOIN listed b ON b.k = l_partkey",
)
def _(spark, sf_dir):
    """A policy that grows with the tables: the finished orders. Each line names its own order and another one in it."""
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    names = done.select(F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("name"))
    inner = F.concat(F.lit("{{order_"), F.col("l_partkey").cast("string"), F.lit("}}"))
    text = F.concat(F.lit("{{Order "), F.col("l_orderkey").cast("string"), F.lit("|x "), inner, F.lit("}}"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("text"))
    return keep_listed_templates(lines, names, "text")


@query(
    "f16_short_description",
    "SELECT p_partkey AS pageid, CASE WHEN p_partkey % 3 <> 0 THEN p_type END AS description FROM part",
)
def _(spark, sf_dir):
    none = F.when(F.col("pageid") % 3 == 0, "{{Short description|none}}").otherwise(F.col("wikitext"))
    pages = wiki_src(spark, sf_dir).select("pageid", none.alias("wikitext"))
    return tpl.with_short_description(pages).select("pageid", "description")


@query(
    "f17_template_params",
    on_src(
        "SELECT pageid, 'short description' AS template, '1' AS param, p_type AS value FROM s "
        "UNION ALL SELECT pageid, 'infobox part', 'brand', p_brand FROM s "
        "UNION ALL SELECT pageid, 'infobox part', 'size', concat('{{convert|', p_size, '|mm}}') FROM s "
        "UNION ALL SELECT pageid, 'convert', '1', CAST(p_size AS VARCHAR) FROM s "
        "UNION ALL SELECT pageid, 'convert', '2', 'mm' FROM s "
        "UNION ALL SELECT pageid, 'val', '1', CAST(p_size AS VARCHAR) FROM s "
        "UNION ALL SELECT pageid, 'cite web', 'url', concat('x', pageid % 7) FROM s",
        "s AS (SELECT pageid, p_type, p_brand, p_size FROM wiki_src JOIN part ON p_partkey = pageid)",
    ),
)
def _(spark, sf_dir):
    return tpl.template_params(wiki_src(spark, sf_dir))


@query(
    "f18_template_occurrences",
    on_src(
        r"SELECT pageid, lower(trim(unnest(regexp_extract_all(wikitext, '\{\{\s*([^{}|]*)', 1)))) AS name "
        "FROM wiki_src"
    ),
)
def _(spark, sf_dir):
    return tpl.template_occurrences(wiki_src(spark, sf_dir))


_LEAN_SRC = sql_chain(
    "regexp_replace(wikitext, '(?s)== References ==.*$', '')",
    (r"<ref>r</ref>", ""),
    (rf"\{{\{{Infobox part{_PAIR}", ""),
    (r"(?m)^(==+ )", "\n\n\\1"),
)


@query("f33_streamline", on_src(f"SELECT pageid, {_LEAN_SRC} AS wikitext FROM wiki_src"))
def _(spark, sf_dir):
    lean = tpl.streamline(F.col("wikitext"))
    return wiki_src(spark, sf_dir).select("pageid", lean.alias("wikitext"))


@query(
    "f33_big_prefixes",
    "SELECT p_partkey, concat('a', CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN "
    "concat('{{x ', p_name, '}}') ELSE '' END, 'z') AS text FROM part",
)
def _(spark, sf_dir):
    kinds = F.array(F.lit("{{ Infobox y|a={{x}}}}"), F.concat(F.lit("{{x "), "p_name", F.lit("}}")), F.lit("{{PP-move}}"))
    text = F.concat(F.lit("a"), F.get(kinds, F.col("p_size") % 3), F.lit("z"))
    part = table(spark, sf_dir, "part").select("p_partkey", text.alias("text"))
    return part.withColumn("text", tpl.drop_big_templates(F.col("text"), BIG_PREFIXES))


def dictionary(spark, sf_dir):
    """Stored expansions for most of the measures in the page view."""
    part = table(spark, sf_dir, "part").where("p_size < 45")  # nothing is stored for larger ones
    size = F.col("p_size").cast("string")
    return part.select(
        F.concat(F.lit("{{val|"), size, F.lit("}}")).alias("invocation"),
        F.concat(size, F.lit(" units")).alias("expansion"),
    ).distinct()


EXPANDED = sql_strip(
    sql_chain(
        "wikitext",
        (DROPPED_SRC, ""),
        (r"\{\{val\|(?:4[5-9]|50)\}\}", ""),
        (r"\{\{val\|(\d+)\}\}", r"\1 units"),
    )
)


@query(
    "jn4_expand_by_dictionary",
    on_src(
        f"SELECT pageid, {EXPANDED} AS expanded, "
        r"CAST(5 + len(regexp_extract_all(wikitext, '\{\{val\|(?:4[5-9]|50)\}\}')) AS BIGINT) AS unmatched FROM wiki_src"
    ),
)
def _(spark, sf_dir):
    out = expand_by_dictionary(wiki_src(spark, sf_dir), dictionary(spark, sf_dir))
    return out.select("pageid", "expanded", "unmatched")


@query(
    "jn4_expand_repeated_ids",
    "SELECT p_partkey % 50 AS pageid, concat(p_name, ' ', p_size, ' ', p_partkey % 7 + 1) AS expanded, "
    "CAST(1 AS BIGINT) AS unmatched FROM part",
)
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    use = lambda n: F.concat(F.lit("{{v|"), n, F.lit("}}"))
    text = F.concat_ws(" ", "p_name", use(F.col("p_size")), use(F.col("p_partkey") % 7 + 1), F.lit("{{w}}"))
    pages = part.select((F.col("p_partkey") % 50).alias("pageid"), text.alias("wikitext"))
    size = F.col("p_size")
    table_ = part.select(use(size).alias("invocation"), size.cast("string").alias("expansion")).distinct()
    return expand_by_dictionary(pages, table_).select("pageid", "expanded", "unmatched")


@query(
    "jn4_expand_inline",
    on_src(
        f"SELECT pageid, {EXPANDED} AS expanded, "
        r"CAST(5 + len(regexp_extract_all(wikitext, '\{\{val\|(?:4[5-9]|50)\}\}')) AS BIGINT) AS unmatched FROM wiki_src"
    ),
)
def _(spark, sf_dir):
    out = expand_by_dictionary(wiki_src(spark, sf_dir), dictionary(spark, sf_dir).repartition(3))
    return out.select("pageid", "expanded", "unmatched")

