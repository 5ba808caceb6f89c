"""Shapes of the plans: what must stay narrow, and what may shuffle."""

from pyspark.sql import functions as F

from markloom.operators.expand import expand_by_dictionary
from markloom.operators.quality import to_output, with_status
from markloom.plans.convert import convert_pages, preprocess
from markloom.operators import catalog, census, stats
from markloom.workload.templates import dictionary

from .conftest import SF_DIR


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def raw(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").selectExpr(
        "doc_id AS pageid", "source AS title", "lang", "doc_id AS revid", "'g' AS articletype", "text AS wikitext"
    )


def test_conversion_is_one_narrow_stage_with_one_trip_to_python(spark):
    text = plan(convert_pages(raw(spark)))
    assert "Exchange" not in text
    assert text.count("ArrowEvalPython") == 1


def test_preprocessing_has_no_python(spark):
    text = plan(preprocess(raw(spark)))
    assert "Python" not in text and "Exchange" not in text


def test_expansion_join_moves_page_text_once(spark):
    pages = raw(spark).selectExpr("pageid", "wikitext")
    text = plan(expand_by_dictionary(pages, dictionary(spark, SF_DIR)))
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_pages_are_read_once_and_raw_text_does_not_travel(spark):
    done = convert_pages(raw(spark), dictionary(spark, SF_DIR))
    text = plan(to_output(with_status(done, "ok")))
    # Behind the written pages: nothing of the source, and no raw text.
    assert "documents.parquet" not in text
    assert not any("Exchange" not in line and " wikitext#" in line for line in text.splitlines())


def test_counts_come_from_the_footers(spark):
    text = plan(stats.row_count(spark, f"{SF_DIR}/documents.parquet"))
    assert "PushedAggregation: [COUNT(*)]" in text and "hashpartitioning" not in text


def test_censuses_inside_a_page_do_not_shuffle(spark):
    by_page = census.template_census(raw(spark), by_article=True)
    top = census.top_names_by_page(raw(spark), F.split("wikitext", " "), ["pageid"], 3)
    assert "Exchange" not in plan(by_page) and "Exchange" not in plan(top)
    assert "Expand" not in plan(census.census_totals(raw(spark), F.split("wikitext", " ")))


def test_census_combines_before_the_shuffle(spark):
    text = plan(census.document_frequency(raw(spark)))
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_listing_union_combines_before_the_shuffle(spark):
    titles = raw(spark).select("title")
    text = plan(catalog.label_articles([(titles, "g", 1), (titles, "f", 2)]))
    assert text.count("Exchange") == 1 and "partial_max_by" in text
