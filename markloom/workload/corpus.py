"""Statistics, censuses and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.links import with_categories
from ..functions.tags import tag_names
from ..functions.templates import census_names, streamline
from ..functions.text import approx_tokens
from ..operators import census, ranking, stats
from ..plans.convert import counter
from ..plans.fixtures import wiki_docs, wiki_src
from ..session import work_dir
from .listings import DOC_PAGES, doc_pages
from .registry import on_docs, on_src, query, table

_NAMES = (
    r"names AS (SELECT pageid, title, lower(trim(unnest(regexp_extract_all({text}, "
    r"'\{{\{{\s*([^{{}}|]*)', 1)))) AS name FROM {view})"
)
_SRC_CUT = "regexp_replace(wikitext, '(?s)== References ==.*$', '')"
# What a census of the page view looks at: no removed sections, references or infoboxes.
_SRC_LEAN = (
    r"regexp_replace(regexp_replace(" + _SRC_CUT + r", '<ref>r</ref>', '', 'g'), "
    r"'\{\{Infobox part(?:[^{}]|\{\{[^{}]*\}\})*\}\}', '', 'g')"
)
_DOCS_LEAN = (
    r"""regexp_replace(regexp_replace(regexp_replace(wikitext, '(?s)== References ==.*$', ''), """
    r"""'<ref name="r1">[^<]*</ref>', '', 'g'), """
    r"""'\{\{Infobox text(?:[^{}]|\{\{[^{}]*\}\})*\}\}', '', 'g')"""
)
_ALL = _NAMES.format(text="wikitext", view="wiki_src")
_LEAN = _NAMES.format(text=_SRC_LEAN, view="wiki_src")
_LEAN_DOCS = _NAMES.format(text=_DOCS_LEAN, view="wiki_docs")
_TAGS = (
    "WITH tags AS (SELECT page_id, lower(unnest(regexp_extract_all(html, "
    r"'<([A-Za-z][A-Za-z0-9]*)[\s/>]', 1))) AS name FROM pages) "
)
KEYS = ("pageid", "title")


@query(
    "agg1_template_census",
    on_src("SELECT name, count(*) AS n FROM names GROUP BY name", _LEAN),
)
def _(spark, sf_dir):
    return census.template_census(wiki_src(spark, sf_dir))


@query(
    "agg1_template_census_documents",
    on_docs("SELECT name, count(*) AS n FROM names GROUP BY name", _LEAN_DOCS),
)
def _(spark, sf_dir):
    return census.template_census(wiki_docs(spark, sf_dir))


@query("agg2_tag_census", _TAGS + "SELECT name, count(*) AS n FROM tags GROUP BY name")
def _(spark, sf_dir):
    html = table(spark, sf_dir, "pages")
    return census.tag_census(html, "html", streamlined=False, markup=False)


@query(
    "agg2_tag_census_markup",
    on_docs(
        "SELECT name, CAST(sum(k) AS BIGINT) AS n FROM "
        "(SELECT unnest(['li', 'small']) AS name, unnest([4, 1]) AS k FROM wiki_docs) GROUP BY name"
    ),
)
def _(spark, sf_dir):
    return census.tag_census(wiki_docs(spark, sf_dir))


@query(
    "agg3_template_census_by_article",
    on_src("SELECT pageid, title, name, count(*) AS n FROM names GROUP BY ALL", _LEAN),
)
def _(spark, sf_dir):
    return census.template_census(wiki_src(spark, sf_dir), by_article=True)


@query(
    "agg3_tag_census_by_article",
    _TAGS + "SELECT page_id, name, count(*) AS n FROM tags GROUP BY ALL",
)
def _(spark, sf_dir):
    html = table(spark, sf_dir, "pages")
    return census.tag_census(
        html, "html", by_article=True, keys=("page_id",), streamlined=False, markup=False
    )


def _by_article(spark, sf_dir):
    return census.template_census(wiki_src(spark, sf_dir), by_article=True)


@query("agg6_row_count", "SELECT count(*) AS n_rows FROM documents")
def _(spark, sf_dir):
    return stats.row_count(spark, f"{sf_dir}/documents.parquet")


@query(
    "agg7_run_size",
    "SELECT count(*) AS n_rows, CAST(ceil(count(*) / 50.0) AS BIGINT) AS n_chunks FROM documents",
)
def _(spark, sf_dir):
    return stats.chunk_count(stats.row_count(spark, f"{sf_dir}/documents.parquet"), 50)


@query(
    "agg9_agg10_agg11_census_summary",
    on_src(
        "SELECT count(DISTINCT pageid) AS articles, count(DISTINCT name) AS names, "
        "count(*) AS uses FROM names",
        _LEAN,
    ),
)
def _(spark, sf_dir):
    return census.census_totals(wiki_src(spark, sf_dir), census_names(streamline(F.col("wikitext"))))


@query(
    "agg9_agg10_agg11_sketches",
    on_src(
        "SELECT count(DISTINCT pageid) AS articles, count(DISTINCT name) AS names, "
        "count(*) AS uses FROM names",
        _LEAN,
    ),
)
def _(spark, sf_dir):
    """Sketches of three runs, kept beside their censuses and united; two runs have pages in common."""
    base, pages = work_dir(spark, "sketches"), wiki_src(spark, sf_dir)
    names = census_names(streamline(F.col("wikitext")))
    for run, part in enumerate(("pageid % 2 = 0", "pageid % 2 = 1", "pageid % 3 = 0")):
        sketch = census.census_sketch(pages.where(part), names)
        # Uses add up, so the third run brings none.
        sketch.withColumn("uses", F.col("uses") * int(run < 2)).write.parquet(f"{base}/run={run}")
    return census.unite_sketches(spark.read.parquet(base))


@query(
    "agg9_article_count",
    on_src("SELECT count(DISTINCT pageid) AS articles FROM names", _LEAN),
)
def _(spark, sf_dir):
    return census.census_totals(wiki_src(spark, sf_dir), census_names(streamline(F.col("wikitext")))).select("articles")


@query("agg10_distinct_names", _TAGS + "SELECT count(DISTINCT name) AS names FROM tags")
def _(spark, sf_dir):
    html = table(spark, sf_dir, "pages")
    found = census.tag_census(html, "html", streamlined=False, markup=False)
    return found.agg(F.count("*").alias("names"))


@query("agg11_total_uses", _TAGS + "SELECT count(*) AS uses FROM tags")
def _(spark, sf_dir):
    html = table(spark, sf_dir, "pages")
    found = census.tag_census(html, "html", streamlined=False, markup=False)
    return found.agg(F.sum("n").alias("uses"))


@query(
    "agg12_document_frequency",
    on_src("SELECT name, count(DISTINCT pageid) AS articles FROM names GROUP BY name", _LEAN),
)
def _(spark, sf_dir):
    return census.document_frequency(wiki_src(spark, sf_dir))


@query(
    "agg13_char_freq",
    "SELECT c AS char, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS c FROM documents) "
    "GROUP BY c",
)
def _(spark, sf_dir):
    return stats.char_freq(table(spark, sf_dir, "documents"), "text")


@query("agg14_total_chars", "SELECT CAST(sum(length(text)) AS BIGINT) AS chars FROM documents")
def _(spark, sf_dir):
    return stats.total(spark.read.parquet(f"{sf_dir}/documents.parquet"), "text", "chars")


_WORDS = (
    r"(SELECT unnest(regexp_extract_all(text, '[^\s\x{85}\x{a0}\p{Z}\x{1c}-\x{1f}\x{b}]+')) AS word "
    "FROM documents)"
)


@query("agg15_word_freq", f"SELECT word, count(*) AS n FROM {_WORDS} GROUP BY word")
def _(spark, sf_dir):
    return stats.word_freq(table(spark, sf_dir, "documents"), "text")


@query("agg16_total_words", f"SELECT count(*) AS words FROM {_WORDS}")
def _(spark, sf_dir):
    return stats.total(spark.read.parquet(f"{sf_dir}/documents.parquet"), "text", "words")


_TOKENS = r"len(regexp_extract_all(text, '\p{L}+|\p{N}+|[^\s\p{L}\p{N}]'))"


@query("agg17_approx_tokens", f"SELECT doc_id, {_TOKENS} AS tokens FROM documents")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", approx_tokens(F.col("text")).cast("long").alias("tokens"))


@query(
    "agg18_corpus_ratio",
    f"SELECT CAST(a AS BIGINT) AS tokens_a, CAST(b AS BIGINT) AS tokens_b, a / b AS ratio FROM "
    f"(SELECT (SELECT sum({_TOKENS}) FROM documents)::DOUBLE AS a, "
    f"(SELECT sum({_TOKENS}) FROM benchmark)::DOUBLE AS b)",
)
def _(spark, sf_dir):
    docs, bench = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return stats.corpus_ratio(docs, bench, "text")


@query(
    "agg19_page_counters",
    on_src(
        "SELECT pageid, string_agg(concat(name, '=', CAST(n AS VARCHAR)), ',' ORDER BY name) AS counts "
        "FROM (SELECT pageid, name, count(*) AS n FROM names GROUP BY ALL) GROUP BY pageid",
        _ALL,
    ),
)
def _(spark, sf_dir):
    counts = wiki_src(spark, sf_dir).withColumn("m", counter(census_names(F.col("wikitext"))))
    cells = F.transform(F.map_entries("m"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return counts.select("pageid", F.array_join(cells, ",").alias("counts"))


@query(
    "agg20_dataset_card",
    "SELECT count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS chars, "
    r"CAST(sum(len(regexp_extract_all(text, '[^\s\x{85}\x{a0}\p{Z}\x{1c}-\x{1f}\x{b}]+'))) AS BIGINT) AS words, "
    f"CAST(sum({_TOKENS}) AS BIGINT) AS tokens, count(description) AS described, "
    "avg(len(categories)) AS categories_per_page "
    f"FROM (SELECT *, markdown AS text FROM ({DOC_PAGES}))",
)
def _(spark, sf_dir):
    return stats.dataset_card(doc_pages(spark, sf_dir))


@query(
    "agg21_keep_list",
    on_src(
        "SELECT name, count(DISTINCT pageid) AS articles FROM names "
        "WHERE name NOT LIKE 'cite%' AND name NOT LIKE 'infobox%' GROUP BY name "
        "HAVING count(DISTINCT pageid) >= 100",
        _ALL,
    ),
)
def _(spark, sf_dir):
    pages = wiki_src(spark, sf_dir)
    return census.derive_keep_list(pages, 100, ("cite", "infobox"), streamlined=False)


@query(
    "agg21_keep_by_coverage",
    on_src(
        "SELECT name, n, running FROM (SELECT name, n, CAST(sum(n) OVER (ORDER BY n DESC, name) AS BIGINT) AS running, "
        "sum(n) OVER () AS whole FROM (SELECT name, count(*) AS n FROM names GROUP BY name)) "
        "WHERE 100 * (running - n) < 75 * whole",
        _ALL,
    ),
)
def _(spark, sf_dir):
    return census.keep_by_coverage(wiki_src(spark, sf_dir), 75, streamlined=False)


@query(
    "top1_most_used_templates",
    on_src("SELECT name, count(*) AS n FROM names GROUP BY name ORDER BY n DESC, name LIMIT 25", _LEAN),
)
def _(spark, sf_dir):
    return ranking.top_k(census.template_census(wiki_src(spark, sf_dir)), "n", "name", 25)


@query(
    "top1_most_used_chars",
    "SELECT c AS char, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS c FROM documents) "
    "GROUP BY c ORDER BY n DESC, c LIMIT 100",
)
def _(spark, sf_dir):
    return ranking.top_k(stats.char_freq(table(spark, sf_dir, "documents"), "text"), "n", "char", 100)


@query(
    "top1_most_used_words",
    f"SELECT word, count(*) AS n FROM {_WORDS} GROUP BY word ORDER BY n DESC, word LIMIT 500",
)
def _(spark, sf_dir):
    return ranking.top_k(stats.word_freq(table(spark, sf_dir, "documents"), "text"), "n", "word", 500)


@query(
    "top2_articles_with_most_templates",
    on_src(
        "SELECT pageid, title, count(DISTINCT name) AS n_distinct FROM names GROUP BY ALL "
        "ORDER BY n_distinct DESC, pageid LIMIT 100",
        _LEAN,
    ),
)
def _(spark, sf_dir):
    pages = wiki_src(spark, sf_dir)
    counted = census.distinct_names(pages, census_names(streamline(F.col("wikitext"))))
    return ranking.top_k(counted.select("pageid", "title", "n_distinct"), "n_distinct", "pageid", 100)


@query(
    "top3_templates_in_most_articles",
    on_src(
        "SELECT name, count(DISTINCT pageid) AS articles FROM names GROUP BY name "
        "ORDER BY articles DESC, name LIMIT 50",
        _LEAN,
    ),
)
def _(spark, sf_dir):
    return ranking.top_k(census.document_frequency(wiki_src(spark, sf_dir)), "articles", "name", 50)


@query(
    "top4_top_tags_per_page",
    _TAGS + "SELECT * FROM (SELECT page_id, name, count(*) AS n, row_number() OVER "
    "(PARTITION BY page_id ORDER BY count(*) DESC, name) AS rank FROM tags GROUP BY page_id, name) "
    "WHERE rank <= 5",
)
def _(spark, sf_dir):
    html = table(spark, sf_dir, "pages")
    return census.top_names_by_page(html, tag_names(F.col("html")), ["page_id"], 5)


@query(
    "top5_sorted_categories",
    on_docs(
        "SELECT pageid, array_to_string(list_sort(list_transform(regexp_extract_all(wikitext, "
        r"'(?i)\[\[category:([^\[\]|]*)', 1), lambda x: trim(x))), '|') AS categories FROM wiki_docs"
    ),
)
def _(spark, sf_dir):
    named = with_categories(wiki_docs(spark, sf_dir))
    return named.select("pageid", F.array_join(F.array_sort("categories"), "|").alias("categories"))


@query(
    "top6_full_ranking",
    f"SELECT word, count(*) AS n FROM {_WORDS} GROUP BY word ORDER BY n DESC, word",
)
def _(spark, sf_dir):
    return ranking.full_ranking(stats.word_freq(table(spark, sf_dir, "documents"), "text"), "n", "word")


_PLACES = f"(SELECT word, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, word) AS rank FROM {_WORDS} GROUP BY word)"


@query("top6_places", f"SELECT word, n, rank FROM {_PLACES}")
def _(spark, sf_dir):
    words = stats.word_freq(table(spark, sf_dir, "documents"), "text")
    return ranking.ranked(words, "n", "word").select("word", "n", "rank")


@query(
    "prj5_peek_anywhere",
    f"SELECT word, n, rank FROM (SELECT *, count(*) OVER () AS size FROM {_PLACES}) "
    "WHERE rank IN (1, 10, 100, size - 9, size)",
)
def _(spark, sf_dir):
    """Places from both ends of a whole table."""
    words = stats.word_freq(table(spark, sf_dir, "documents"), "text")
    return ranking.at_places(ranking.ranked(words, "n", "word"), [1, 10, 100, -10, -1]).select("word", "n", "rank")
