"""Links, sections and whole-page conversion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import links, sections
from ..operators.quality import to_output, with_status
from ..plans import convert
from ..plans.fixtures import wiki_docs, wiki_src
from ..session import work_dir
from ..sources.writers import write_raw
from ..streaming.convert import convert_stream, read_converted
from .registry import on_docs, on_src, query, sql_chain, sql_strip, table
from .templates import DROPPED_DOCS, DROPPED_SRC, dictionary


def _src(fn):
    return lambda spark, sf_dir: wiki_src(spark, sf_dir).select(
        "pageid", fn(F.col("wikitext")).alias("wikitext")
    )


def _docs(fn):
    return lambda spark, sf_dir: wiki_docs(spark, sf_dir).select(
        "pageid", fn(F.col("wikitext")).alias("wikitext")
    )


def _src_sql(*steps):
    return on_src(f"SELECT pageid, {sql_chain('wikitext', *steps)} AS wikitext FROM wiki_src")


def _docs_sql(*steps):
    return on_docs(f"SELECT pageid, {sql_chain('wikitext', *steps)} AS wikitext FROM wiki_docs")


MEDIA = (r"(?i)\[\[(?:File|Image|Media):(?:[^\[\]]|\[\[[^\[\]]*\]\])*\]\]", "")
LABELLED = (r"\[\[[^\[\]|\n]*\|([^\[\]]+)\]\]", r"\1")
BARE = (r"\[\[([^\[\]|\n]*)\|?\]\]", r"\1")
CAT_BARE = (r"(?i)\[\[(Category:)([^\[\]|]*)\]\]", r"[[\1\2|\2]]")
CAT_GONE = (r"(?i)\[\[Category:[^\[\]|]*\]\]", "")

query("f3_drop_media", _src_sql(MEDIA))(_src(links.drop_media))
query("f3_drop_media_with_links", _docs_sql(MEDIA))(_docs(links.drop_media))
query("f5_category_links", _src_sql(CAT_BARE))(_src(links.clean_categories))
query("f6_category_links_after_expansion", _src_sql(CAT_GONE))(
    _src(lambda c: links.clean_categories(c, after_expansion=True))
)
query("f7_links_to_text", _src_sql(LABELLED, BARE))(_src(links.links_to_text))
query(
    "f7_nested_links_to_text",
    _docs_sql((r"\[\[Image:b.png\|40px\|in \[\[([a-z]*)\]\] text\]\]", r"40px|in \1 text"), LABELLED, BARE),
)(_docs(links.links_to_text))
query(
    "f8_external_links",
    _src_sql((r"\[http://e\.org link\]", "link"), (r"\[http://e\.org/x\]", "")),
)(_src(links.external_to_text))


@query(
    "f8_schemes_without_slashes",
    "SELECT p_partkey, concat('See Mail ', p_name, ' and  or call ') AS text FROM part",
)
def _(spark, sf_dir):
    text = F.concat(
        F.lit("See [mailto:a"), "p_partkey", F.lit("@b.c Mail "), "p_name", F.lit("] and [news:x"), "p_size",
        F.lit("] or [tel:+1 call] "), F.lit("mailto:c@d.e"),
    )
    return table(spark, sf_dir, "part").select("p_partkey", links.external_to_text(text).alias("text"))


query("f9_behaviour_switches", _src_sql((r"__[A-Z]*__", "")))(_src(links.drop_switches))


@query(
    "f4_category_edges",
    on_docs(
        "SELECT pageid, trim(unnest(regexp_extract_all(wikitext, "
        r"'(?i)\[\[category:([^\[\]|]*)', 1))) AS category FROM wiki_docs"
    ),
)
def _(spark, sf_dir):
    return links.category_edges(wiki_docs(spark, sf_dir))


# --- sections ---

_PIECES = (
    "pieces AS (SELECT pageid, unnest(p) AS body, generate_subscripts(p, 1) - 1 AS pos FROM "
    r"(SELECT pageid, string_split(regexp_replace(wikitext, '(?m)^(={2,6}[^=\n].*)$', "
    r"chr(1) || '\1', 'g'), chr(1)) AS p FROM wiki_docs))"
)
_HEADING = r"regexp_extract(body, '^=+([^=\n]+)=+\s*\n', 1)"


@query(
    "f19_section_table",
    on_docs(
        r"SELECT pageid, CAST(pos AS INTEGER) AS pos, length(regexp_extract(body, '^=*')) AS level, "
        f"nullif(lower(trim({_HEADING})), '') AS heading, body FROM pieces",
        _PIECES,
    ),
)
def _(spark, sf_dir):
    return sections.section_table(wiki_docs(spark, sf_dir)).withColumn(
        "level", F.col("level").cast("long")
    )


@query(
    "f20_level2_sections",
    on_src(
        r"SELECT pageid, unnest(string_split(regexp_replace(concat('lead', chr(10), wikitext), '(?m)^(== [^=\n]* ==)$', "
        r"chr(1) || '\1', 'g'), chr(1))) AS part FROM wiki_src"
    ),
)
def _(spark, sf_dir):
    """A lost level-3 part before any level-2 heading, and a lost level-1 part at the end."""
    text = F.concat(F.lit("lead\n"), F.col("wikitext"), F.lit("= One =\nlost\n=== Deep ===\nlost too\n"))
    orphan = F.regexp_replace(text, "\n== Usage ==", "\n=== Orphan ===\nlost\n== Usage ==")
    return wiki_src(spark, sf_dir).select("pageid", F.explode(sections.level2(orphan)).alias("part"))


@query(
    "f21_headings",
    on_docs(
        f"SELECT nullif(lower(trim({_HEADING})), '') AS heading, count(*) AS n FROM pieces GROUP BY 1",
        _PIECES,
    ),
)
def _(spark, sf_dir):
    parts = sections.section_table(wiki_docs(spark, sf_dir))
    return parts.groupBy("heading").agg(F.count("*").alias("n"))


query(
    "f22_drop_sections_nested",
    on_src("SELECT pageid, regexp_replace(wikitext, '(?s)== References ==.*$', '') AS wikitext FROM wiki_src"),
)(_src(sections.drop_sections))

query(
    "f23_drop_sections_flat",
    on_src(
        "SELECT pageid, concat("
        r"regexp_replace(regexp_replace(wikitext, '(?s)== References ==.*$', ''), '(?m)^(==+ )', "
        r"chr(10) || chr(10) || '\1', 'g'), chr(10), chr(10), "
        r"regexp_extract(wikitext, '(?s)=== Citations ===.*$')) AS wikitext FROM wiki_src"
    ),
)(_src(lambda c: sections.drop_sections(c, ["references"], nested=False)))

query(
    "f24_join_and_finish",
    on_src(
        "SELECT pageid, concat("
        + sql_strip(r"regexp_replace(wikitext, '(?m)^(== )', chr(10) || chr(10) || '\1', 'g')")
        + ", chr(10)) AS wikitext FROM wiki_src"
    ),
)(_src(lambda c: sections.finish(sections.join_sections(sections.level2(c)))))

# --- whole pages ---

# Splitting into sections puts a blank line before each of them: twice for level 2.
_PRE = (
    ("(?s)<!--.*?-->", ""),
    MEDIA,
    CAT_BARE,
    (r"(?i)\[\[(category:[^\[\]]*)\]\]", "\x02\\1\x03"),
    LABELLED,
    BARE,
    ("\x02", "[["),
    ("\x03", "]]"),
    ("__[A-Z]*__", ""),
    (r"(?m)^(=)", "\n\n\\1"),
    (r"(?m)^(==[^=])", "\n\n\\1"),
)
PRE_SRC = sql_chain("wikitext", *_PRE, (DROPPED_SRC, ""))
PRE_DOCS = sql_chain("wikitext", *_PRE, (DROPPED_DOCS, ""))


@query(
    "pipe1_preprocess_pages",
    on_src(
        f"SELECT pageid, {PRE_SRC} AS pre_wikitext, CAST(p_type AS VARCHAR) AS pre_description, "
        "concat(p_brand, '|', p_type) AS pre_categories FROM wiki_src JOIN part ON p_partkey = pageid"
    ),
)
def _(spark, sf_dir):
    pre = convert.preprocess(wiki_src(spark, sf_dir))
    cats = F.array_join("pre_categories", "|").alias("pre_categories")
    return pre.select("pageid", "pre_wikitext", "pre_description", cats)


@query("pipe1_preprocess_documents", on_docs(f"SELECT pageid, {PRE_DOCS} AS pre_wikitext FROM wiki_docs"))
def _(spark, sf_dir):
    return convert.preprocess(wiki_docs(spark, sf_dir)).select("pageid", "pre_wikitext")


_POST = (
    ("(?s)== References ==.*$", ""),
    (r"(?m)^(==[^=])", "\n\n\\1"),
    ("(?s)<!--.*?-->", ""),
    (r"(?s)\{\| class=.*?\n\|\}", ""),
    (r"<ref[^<>]*>.*?</ref>", ""),
    ("</?(?:b|small)>", ""),
    ("</?q>", '"'),
    MEDIA,
    LABELLED,
    BARE,
    (r"\[http://e\.org link\]", "link"),
    (r"\[http://e\.org/x\]", ""),
)


@query(
    "pipe2_postprocess_pages",
    on_src(f"SELECT pageid, concat({sql_strip(sql_chain('wikitext', *_POST))}, chr(10)) AS wikitext FROM wiki_src"),
)
def _(spark, sf_dir):
    return convert.postprocess(wiki_src(spark, sf_dir), "wikitext").select(
        "pageid", F.col("final_wikitext").alias("wikitext")
    )


@query(
    "pipe2_postprocess_documents",
    on_docs(f"SELECT pageid, concat({sql_strip(sql_chain('wikitext', *_POST))}, chr(10)) AS wikitext FROM wiki_docs"),
)
def _(spark, sf_dir):
    return convert.postprocess(wiki_docs(spark, sf_dir), "wikitext").select(
        "pageid", F.col("final_wikitext").alias("wikitext")
    )


_VAL = ((r"\{\{val\|(?:4[5-9]|50)\}\}", ""), (r"\{\{val\|(\d+)\}\}", r"\1 units"))


def _markdown_src() -> str:
    final = sql_strip(sql_chain(PRE_SRC, *_VAL, *_POST))
    return sql_strip(
        sql_chain(
            final,
            (r"#", r"\\#"),
            (r"(?m)^\* *$", ""),
            (r"(?m)^\* (.*?) *$", r"- \1"),
            (r"(?m)^=== (.*) ===$", "\n\n### \\1\n\n"),
            (r"(?m)^== (.*) ==$", "\n\n## \\1\n\n"),
            (r" +\n", "\n"),
            (r"\n\s*\n", "\n\n"),
        )
    )


_SRC_PAGE = (
    f"SELECT pageid, title, revid, p_type AS description, "
    "array_to_string(list_sort([p_brand, p_type]), '|') AS categories, "
    f"{_markdown_src()} AS markdown FROM wiki_src JOIN part ON p_partkey = pageid"
)


@query("pipe3_convert_pages", on_src(_SRC_PAGE))
def _(spark, sf_dir):
    done = convert.convert_pages(wiki_src(spark, sf_dir), dictionary(spark, sf_dir))
    out = to_output(with_status(done, "ok"))
    return out.withColumn("categories", F.array_join("categories", "|"))


def _markdown_docs() -> str:
    final = sql_strip(sql_chain(PRE_DOCS, (r"\{\{nowrap[^\n]*\}\}", ""), *_POST))
    return sql_strip(
        sql_chain(
            final,
            (r"(?m)^# (.*?) *$", "\x02 \\1"),
            (r"(?m)^\*\* (.*?) *$", "\x03 \\1"),
            (r"([^\n\x02\x03=])\n([^\n\x02\x03=])", r"\1 \2"),
            (r"([^\n\x02\x03=])\n([^\n\x02\x03=])", r"\1 \2"),
            (r"&amp;", "&"),
            (r" {2,}", " "),
            (r"([\\`*~|<>$#])", r"\\\1"),
            (r"(?m)^=== (.*) ===$", "\n\n### \\1\n\n"),
            (r"(?m)^== (.*) ==$", "\n\n## \\1\n\n"),
            (r"\x02 first", "1. first"),
            (r"\x02 second", "2. second"),
            (r"\x03 ", "  - "),
            (r" +\n", "\n"),
            (r"\n\s*\n", "\n\n"),
        )
    )


@query(
    "pipe3_convert_documents",
    on_docs(
        "SELECT pageid, title, revid, concat('Text from ', source) AS description, "
        "array_to_string(list_sort([source, concat(documents.lang, ' texts')]), '|') AS categories, "
        f"{_markdown_docs()} AS markdown FROM wiki_docs JOIN documents ON doc_id = pageid"
    ),
)
def _(spark, sf_dir):
    out = to_output(with_status(convert.convert_pages(wiki_docs(spark, sf_dir)), "ok"))
    return out.withColumn("categories", F.array_join("categories", "|"))


@query("str1_convert_stream", on_src(_SRC_PAGE))
def _(spark, sf_dir):
    source = write_raw(wiki_src(spark, sf_dir), work_dir(spark, "stream-in"))
    target = work_dir(spark, "stream-out")
    run = convert_stream(
        spark, source, target, work_dir(spark, "stream-state"), dictionary(spark, sf_dir)
    )
    run.awaitTermination()
    return read_converted(spark, target).withColumn("categories", F.array_join("categories", "|"))


@query("str1_convert_with_large_dictionary", on_src(_SRC_PAGE))
def _(spark, sf_dir):
    """As many dictionary entries as a real one has: those in use, and a hundred for every line item's order."""
    source = write_raw(wiki_src(spark, sf_dir), work_dir(spark, "stream-in"))
    target = work_dir(spark, "stream-out")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.explode(F.sequence(F.lit(1), F.lit(100))).alias("k"))
    name = F.concat(F.lit("{{order|"), "o_orderkey", F.lit("|"), "k", F.lit("}}"))
    more = orders.select(name.alias("invocation"), F.lit("never").alias("expansion"))
    entries = dictionary(spark, sf_dir).unionByName(more)
    convert_stream(spark, source, target, work_dir(spark, "stream-state"), entries).awaitTermination()
    return read_converted(spark, target).withColumn("categories", F.array_join("categories", "|"))

