"""Outcomes of a run, and everything a run writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.markdown import is_corrupt
from ..functions.templates import raw_names, unsupported_names
from ..functions.dims import TemplatePolicy
from ..operators import census
from ..operators.catalog import label_articles, lookup_title, missing
from ..operators.quality import golden_diff, retry_input, run_summary, with_status
from ..plans.convert import convert_pages, counter
from ..plans.fixtures import wiki_src
from ..plans.jobs import download, generate
from ..session import work_dir
from ..sources.readers import read_pages, read_raw
from ..sources.writers import (
    export_article,
    finish_run,
    read_finished,
    write_census_csv,
    write_for_lookup,
    write_lines,
    write_pages,
    write_raw,
)
from ..streaming.convert import convert_stream, read_outcomes, retry_failed, write_batch
from .corpus import _LEAN
from .listings import DOC_PAGES, doc_pages
from .registry import on_src, query, table
from .templates import dictionary

# Every tenth page gets an unbalanced tag, every fourteenth a template without a name.
_CORRUPT, _FAILED = 10, 14


def damaged(spark, sf_dir):
    text = F.concat(
        F.when(F.col("pageid") % _CORRUPT == 0, "<sub>").otherwise(""),
        F.when(F.col("pageid") % _FAILED == 0, "{{}}").otherwise(""),
        "wikitext",
    )
    return wiki_src(spark, sf_dir).withColumn("wikitext", text)


_STATUS = (
    f"CASE WHEN pageid % {_FAILED} = 0 THEN 'failed' WHEN pageid % {_CORRUPT} = 0 THEN 'corrupt' "
    "ELSE 'ok' END"
)
_ERROR = f"CASE WHEN pageid % {_FAILED} = 0 THEN 'empty template name' END"


@query(
    "prj3_route_pages",
    on_src(f"SELECT pageid, title, {_STATUS} AS status, {_ERROR} AS error FROM wiki_src"),
)
def _(spark, sf_dir):
    done = convert_pages(damaged(spark, sf_dir))
    return done.select("pageid", "title", "status", "error")


@query(
    "prj3_nameless_template_in_a_lost_section",
    "SELECT p_partkey AS pageid, CASE WHEN p_size % 3 < 2 THEN 'failed' ELSE 'ok' END AS status FROM part",
)
def _(spark, sf_dir):
    use = F.get(F.array(*[F.lit(t) for t in ("{{}}", "{{|x}}", "{{x}}")]), F.col("p_size") % 3)
    raw = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("pageid"),
        F.col("p_name").alias("title"),
        F.lit("en").alias("lang"),
        F.col("p_partkey").alias("revid"),
        F.concat(F.lit("Lead "), "p_name", F.lit("\n\n= Top =\n"), use, F.lit("\n")).alias("wikitext"),
    )
    return convert_pages(raw).select("pageid", "status")


@query(
    "str1_stream_outcomes",
    on_src(f"SELECT pageid, title, {_STATUS} AS status, {_ERROR} AS error FROM wiki_src"),
)
def _(spark, sf_dir):
    source = write_raw(damaged(spark, sf_dir), work_dir(spark, "stream-in"))
    target = work_dir(spark, "stream-out")
    convert_stream(spark, source, target, work_dir(spark, "stream-state"), outcomes=True).awaitTermination()
    return read_outcomes(spark, target).select("pageid", "title", "status", "error")


@query(
    "str1_retry_and_repeat",
    on_src(f"SELECT pageid, title, {_STATUS} AS status, {_ERROR} AS error FROM wiki_src"),
)
def _(spark, sf_dir):
    """Failed pages come by again, and the last batch is written twice, as after a crash: each page counts once."""
    raw = damaged(spark, sf_dir)
    source = write_raw(raw, work_dir(spark, "stream-in"))
    target, state = work_dir(spark, "stream-out"), work_dir(spark, "stream-state")
    convert_stream(spark, source, target, state, outcomes=True).awaitTermination()
    retry_failed(spark, source, target)
    convert_stream(spark, source, target, state, outcomes=True).awaitTermination()
    write_batch(convert_pages(retry_input(raw, read_outcomes(spark, target))), target, 1, True)
    return read_outcomes(spark, target).select("pageid", "title", "status", "error")


@query(
    "snk10_rerun_replaces",
    on_src("SELECT pageid, title, revid, CAST(1700000000 AS BIGINT) AS run_ts FROM wiki_src"),
)
def _(spark, sf_dir):
    """A run that is repeated leaves one copy of its pages, and one that never ended leaves none."""
    base, pages = work_dir(spark, "runs"), wiki_src(spark, sf_dir)
    for _ in range(2):
        write_raw(pages, base, 1_700_000_000)
        finish_run(spark, base, 1_700_000_000)
    write_raw(pages, base, 1_700_000_001)
    return read_finished(spark, base).select("pageid", "title", "revid", "run_ts")


@query(
    "prj1_lookup_written",
    on_src("SELECT * FROM wiki_src WHERE title = (SELECT max(p_name) FROM part) ORDER BY pageid DESC LIMIT 1"),
)
def _(spark, sf_dir):
    """A point lookup in a table that is written in the order of titles, with filters in its files."""
    path = work_dir(spark, "lookup")
    write_for_lookup(wiki_src(spark, sf_dir), path)
    largest = table(spark, sf_dir, "part").agg(F.max("p_name")).first()[0]
    return lookup_title(read_raw(spark, path), largest)


@query(
    "prj4_retry_input",
    on_src(
        "SELECT pageid, title, lang, revid, articletype FROM wiki_src "
        f"WHERE pageid % {_FAILED} = 0"
    ),
)
def _(spark, sf_dir):
    raw = damaged(spark, sf_dir)
    return retry_input(raw, convert_pages(raw)).drop("wikitext")


@query(
    "agg8_run_summary",
    on_src(
        "SELECT count(*) AS total, count(*) FILTER (s = 'ok') AS ok, "
        "count(*) FILTER (s = 'corrupt') AS corrupt, count(*) FILTER (s = 'failed') AS failed "
        f"FROM (SELECT {_STATUS} AS s FROM wiki_src)"
    ),
)
def _(spark, sf_dir):
    return run_summary(convert_pages(damaged(spark, sf_dir)))


@query(
    "f36_corrupt_pages",
    "SELECT p_partkey, p_size % 5 IN (1, 2, 3) AS corrupt FROM part",
)
def _(spark, sf_dir):
    ends = F.array(*[F.lit(t) for t in ("<sub>2</sub>", "<SUP>x", "[[a", "b}}", "<math>[[</math><li>")])
    text = F.concat("p_name", F.get(ends, F.col("p_size") % 5))
    return table(spark, sf_dir, "part").select("p_partkey", is_corrupt(text).alias("corrupt"))


def _perturbed(pages):
    """A damaged copy of all pages: some are gone, some have another title or no revision."""
    return (
        pages.where("pageid % 9 <> 0")
        .withColumn("title", F.when(F.col("pageid") % 7 == 0, F.upper("title")).otherwise(F.col("title")))
        .withColumn("revid", F.when(F.col("pageid") % 8 == 0, None).otherwise(F.col("revid")))
    )


@query(
    "jn5_golden_diff",
    on_src(
        "SELECT pageid, 'missing' AS mismatch FROM wiki_src WHERE pageid % 9 = 0 UNION ALL "
        "SELECT pageid, 'title' FROM wiki_src WHERE pageid % 9 <> 0 AND pageid % 7 = 0 UNION ALL "
        "SELECT pageid, 'revid' FROM wiki_src WHERE pageid % 9 <> 0 AND pageid % 8 = 0 UNION ALL "
        "SELECT pageid + 1000000000, 'unexpected' FROM wiki_src WHERE pageid % 11 = 0"
    ),
)
def _(spark, sf_dir):
    pages = wiki_src(spark, sf_dir)
    extra = pages.where("pageid % 11 = 0").withColumn("pageid", F.col("pageid") + 1_000_000_000)
    actual = _perturbed(pages).unionByName(extra)
    return golden_diff(actual, pages, "pageid", ["title", "revid", "articletype", "wikitext"])


@query(
    "agg5_unsupported_template_totals",
    on_src(
        "SELECT name, count(*) AS n FROM (SELECT unnest(['infobox part', 'cite web', 'reflist', "
        "concat('unknown tpl', CAST(pageid % 5 AS VARCHAR))]) AS name FROM wiki_src) GROUP BY name"
    ),
)
def _(spark, sf_dir):
    dropped = unsupported_names(raw_names(F.col("wikitext")), TemplatePolicy.default())
    counted = wiki_src(spark, sf_dir).select(counter(dropped).alias("unsupported_templates"))
    return census.sum_counters(counted, "unsupported_templates")


# --- sinks: written and read back ---


@query("snk1_write_raw", on_src("SELECT * FROM wiki_src"))
def _(spark, sf_dir):
    return read_raw(spark, write_raw(wiki_src(spark, sf_dir), work_dir(spark, "raw"), mode="overwrite"))


@query(
    "snk2_write_pages",
    "SELECT pageid, title, revid, description, array_to_string(categories, '|') AS categories, markdown "
    f"FROM ({DOC_PAGES})",
)
def _(spark, sf_dir):
    path = write_pages(doc_pages(spark, sf_dir), work_dir(spark, "pages"))
    return read_pages(spark, path).withColumn("categories", F.array_join("categories", "|"))


@query(
    "snk3_tag_census_csv",
    r"SELECT lower(name) AS tag, count(*) AS count FROM (SELECT unnest(regexp_extract_all(html, "
    r"'<([A-Za-z][A-Za-z0-9]*)[\s/>]', 1)) AS name FROM pages) GROUP BY 1",
)
def _(spark, sf_dir):
    path = work_dir(spark, "unsupported_tags")
    html = table(spark, sf_dir, "pages")
    write_census_csv(census.tag_census(html, "html", streamlined=False, markup=False), path, "tag")
    return spark.read.schema("tag string, count bigint").csv(path, header=True)


@query(
    "snk4_template_census_csv",
    on_src("SELECT name AS template, count(*) AS count FROM names GROUP BY name", _LEAN),
)
def _(spark, sf_dir):
    path = work_dir(spark, "unsupported_templates")
    write_census_csv(census.template_census(wiki_src(spark, sf_dir)), path, "template")
    return spark.read.schema("template string, count bigint").csv(path, header=True)


@query(
    "snk5_corrupt_titles",
    on_src(f"SELECT title AS value FROM wiki_src WHERE {_STATUS} = 'corrupt'"),
)
def _(spark, sf_dir):
    path = work_dir(spark, "corrupt")
    write_lines(with_status(convert_pages(damaged(spark, sf_dir)), "corrupt"), path, ["title"], "")
    return spark.read.text(path)


@query(
    "snk6_failures",
    on_src(f"SELECT concat(title, ' | ', {_ERROR}) AS value FROM wiki_src WHERE {_STATUS} = 'failed'"),
)
def _(spark, sf_dir):
    path = work_dir(spark, "failures")
    failed = with_status(convert_pages(damaged(spark, sf_dir)), "failed")
    write_lines(failed, path, ["title", "error"], " | ")
    return spark.read.text(path)


@query(
    "snk7_undownloaded",
    "SELECT concat(CASE WHEN toxic = 1 THEN 'f' ELSE 'g' END, ' Doc ', CAST(doc_id AS VARCHAR)) AS value "
    "FROM labels JOIN documents USING (doc_id) WHERE (quality = 1 OR toxic = 1) AND documents.lang <> 'en'",
)
def _(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    title = F.concat(F.lit("Doc "), F.col("doc_id")).alias("title")
    articles = label_articles(
        [(labels.where("quality = 1").select(title), "g", 1), (labels.where("toxic = 1").select(title), "f", 2)]
    )
    path = work_dir(spark, "missing_articles")
    docs = table(spark, sf_dir, "documents").where("lang = 'en'")  # the others were not fetched
    gone = missing(articles, docs.select(title))
    write_lines(gone, path, ["articletype", "title"], " ")
    return spark.read.text(path)


@query(
    "snk8_template_metrics",
    on_src(
        "SELECT 'df' AS kind, concat(name, ', ', CAST(count(DISTINCT pageid) AS VARCHAR)) AS value FROM names "
        "GROUP BY name UNION ALL SELECT 'uses', concat(name, ' ', CAST(count(*) AS VARCHAR)) FROM names GROUP BY name",
        _LEAN,
    ),
)
def _(spark, sf_dir):
    pages = wiki_src(spark, sf_dir)
    by_articles, by_uses = work_dir(spark, "temps_used"), work_dir(spark, "template_counts")
    popular = census.document_frequency(pages).orderBy(F.desc("articles"), "name")
    write_lines(popular, by_articles, ["name", "articles"], ", ")
    write_lines(census.template_census(pages).orderBy(F.desc("n"), "name"), by_uses, ["name", "n"], " ")
    df = spark.read.text(by_articles).select(F.lit("df").alias("kind"), "value")
    return df.unionByName(spark.read.text(by_uses).select(F.lit("uses").alias("kind"), "value"))


@query(
    "snk9_export_article",
    on_src(
        "SELECT replace(lower(title), ' ', '_') AS slug, concat(wikitext, chr(10)) AS value FROM wiki_src "
        "WHERE title = (SELECT max(p_name) FROM part) ORDER BY pageid DESC LIMIT 1"
    ),
)
def _(spark, sf_dir):
    pages = wiki_src(spark, sf_dir)
    largest = pages.agg(F.max("title")).first()[0]
    path = work_dir(spark, "article")
    export_article(lookup_title(pages, largest), path)
    return spark.read.text(path, wholetext=True).select("slug", "value")


@query(
    "snk10_run_folder",
    on_src("SELECT run_ts, count(*) AS n FROM wiki_src, (VALUES (1700000000), (1700000001)) AS v(run_ts) GROUP BY run_ts"),
)
def _(spark, sf_dir):
    base = work_dir(spark, "runs")
    runs = [write_raw(wiki_src(spark, sf_dir), base, run_ts) for run_ts in (1_700_000_000, 1_700_000_001)]
    counts = [
        read_raw(spark, path).agg(F.count("*").alias("n")).select(
            F.lit(int(path.rsplit("/", 1)[1])).alias("run_ts"), "n"
        )
        for path in runs
    ]
    return counts[0].unionByName(counts[1])


@query(
    "run_generate",
    on_src(
        "SELECT 'summary' AS kind, concat_ws(',', count(*), count(*) FILTER (s = 'ok'), "
        "count(*) FILTER (s = 'corrupt'), count(*) FILTER (s = 'failed')) AS value "
        f"FROM (SELECT {_STATUS} AS s FROM wiki_src) UNION ALL "
        f"SELECT 'corrupt', title FROM wiki_src WHERE {_STATUS} = 'corrupt' UNION ALL "
        f"SELECT 'failures', concat(title, ' | ', {_ERROR}) FROM wiki_src WHERE {_STATUS} = 'failed' "
        "UNION ALL SELECT 'unsupported_templates', concat(name, ',', CAST(count(*) AS VARCHAR)) FROM "
        "(SELECT unnest(['infobox part', 'cite web', 'reflist', "
        "concat('unknown tpl', CAST(pageid % 5 AS VARCHAR))]) AS name FROM wiki_src "
        f"WHERE {_STATUS} = 'ok') GROUP BY name UNION ALL "
        f"SELECT 'pages', CAST(count(*) AS VARCHAR) FROM wiki_src WHERE {_STATUS} = 'ok'"
    ),
)
def _(spark, sf_dir):
    """A whole run: dataset, censuses and logs, as written."""
    data = write_raw(damaged(spark, sf_dir), work_dir(spark, "raw"))
    out, logs = work_dir(spark, "pages"), work_dir(spark, "logs")
    summary = generate(spark, data, out, logs, 1_700_000_000, dictionary(spark, sf_dir), retry=True)
    lines = summary.select(
        F.lit("summary").alias("kind"),
        F.concat_ws(",", "total", "ok", "corrupt", "failed").alias("value"),
    )
    for kind in ("corrupt", "failures"):
        written = spark.read.text(f"{logs}/1700000000/{kind}")
        lines = lines.unionByName(written.select(F.lit(kind).alias("kind"), "value"))
    for kind in ("unsupported_tags", "unsupported_templates"):
        census_csv = spark.read.schema("name string, n bigint").csv(f"{logs}/1700000000/{kind}", header=True)
        lines = lines.unionByName(
            census_csv.select(F.lit(kind).alias("kind"), F.concat_ws(",", "name", "n").alias("value"))
        )
    pages = read_pages(spark, out).agg(F.count("*").cast("string").alias("value"))
    return lines.unionByName(pages.select(F.lit("pages").alias("kind"), "value"))


@query(
    "run_download",
    "WITH listed AS (SELECT CASE WHEN toxic = 1 THEN 'f' ELSE 'g' END AS t, doc_id, "
    "documents.lang = 'en' AS there, text FROM labels JOIN documents USING (doc_id) "
    "WHERE quality = 1 OR toxic = 1) SELECT 'counts' AS kind, concat_ws(',', count(*), "
    "count(*) FILTER (there)) AS value FROM listed UNION ALL "
    "SELECT 'missing', concat(t, ' Doc ', CAST(doc_id AS VARCHAR)) FROM listed WHERE NOT there "
    "UNION ALL SELECT 'raw', concat_ws(' ', doc_id, 'Doc', doc_id, 'en', doc_id * 2, t, length(text)) "
    "FROM listed WHERE there",
)
def _(spark, sf_dir):
    """Stored listings and responses to a raw dataset and the list of what is missing."""
    title = F.concat(F.lit("Doc "), F.col("doc_id")).alias("title")
    labels = table(spark, sf_dir, "labels")
    kinds = (("quality", "Category:Good_articles"), ("toxic", "Category:Featured_articles"))
    listed = [
        labels.where(f"{flag} = 1").select(F.lit(cat).alias("category"), F.lit(0).alias("namespace"), title)
        for flag, cat in kinds
    ]
    members = listed[0].unionByName(listed[1])
    text = F.struct(F.struct(F.struct(F.col("text").alias("*")).alias("main")).alias("slots"))
    rev = F.struct((F.col("doc_id") * 2).alias("revid"), text["slots"].alias("slots"))
    page = F.struct(F.col("doc_id").alias("pageid"), F.array(rev).alias("revisions"))
    body = F.struct(F.struct(F.create_map(F.col("doc_id").cast("string"), page).alias("pages")).alias("query"))
    stored = table(spark, sf_dir, "documents").select(
        title, F.when(F.col("lang") == "en", F.to_json(body)).otherwise("{}").alias("response")
    )
    out, logs = work_dir(spark, "raw"), work_dir(spark, "logs")
    counts = download(spark, members, stored, out, logs, 1_700_000_000)
    rows = counts.select(F.lit("counts").alias("kind"), F.concat_ws(",", "wanted", "fetched").alias("value"))
    gone = spark.read.text(f"{logs}/1700000000/missing_articles")
    raw = read_raw(spark, f"{out}/1700000000").select(
        F.lit("raw").alias("kind"),
        F.concat_ws(" ", "pageid", "title", "lang", "revid", "articletype", F.length("wikitext")).alias("value"),
    )
    return rows.unionByName(gone.select(F.lit("missing").alias("kind"), "value")).unionByName(raw)
