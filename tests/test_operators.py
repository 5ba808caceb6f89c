import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from markloom.operators import catalog, census, expand, quality, ranking, stats
from markloom.plans.convert import convert_pages, counter


def test_listing_precedence(spark):
    good = spark.createDataFrame([("a",), ("b",), ("a",)], "title string")
    featured = spark.createDataFrame([("b",), ("c",)], "title string")
    got = catalog.label_articles([(good, "g", 1), (featured, "f", 2)])
    assert {tuple(r) for r in got.collect()} == {("a", "g"), ("b", "f"), ("c", "f")}


def test_lookup_takes_the_last_of_equal_titles(spark):
    pages = spark.createDataFrame([(1, "t", "x"), (2, "t", "y"), (3, "u", "z")], "pageid int, title string, wikitext string")
    assert catalog.lookup_title(pages, " t ").first().wikitext == "y"
    assert catalog.lookup_title(pages, "none").count() == 0


def test_merge_sets(spark):
    a = spark.createDataFrame([("k", 1), ("k", 2), ("l", 1)], "key string, e int")
    b = spark.createDataFrame([("k", 2), ("k", 3), ("m", 4)], "key string, e int")
    got = {tuple(r) for r in catalog.merge_sets(a, b, "key", "e").collect()}
    assert got == {("k", 1), ("k", 2), ("k", 3), ("l", 1), ("m", 4)}


def test_golden_diff(spark):
    schema = "pageid int, title string, n int"
    want = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3)], schema)
    got = spark.createDataFrame([(1, "a", 2), (2, "b", None), (4, "d", 4)], schema)
    diff = quality.golden_diff(got, want, "pageid", ["title", "n"])
    assert {tuple(r) for r in diff.collect()} == {(1, "n"), (3, "missing"), (4, "unexpected")}


def brute_counts(texts):
    return Counter(w for t in texts for w in t.split()), Counter(c for t in texts for c in t)


def test_frequencies_against_brute_force(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab  \U0001f600\x1c") for _ in range(50)) for _ in range(40)]
    texts.append("")
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "text string")
    words, chars = brute_counts(texts)
    assert {r.word: r.n for r in stats.word_freq(df, "text").collect()} == words
    assert {r.char: r.n for r in stats.char_freq(df, "text").collect()} == chars
    size = stats.corpus_size(df, "text").first()
    assert (size.n_rows, size.chars, size.words) == (42, sum(chars.values()), sum(words.values()))


def test_top_k_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 3), ("d", 1)], "name string, n int")
    assert [r.name for r in ranking.top_k(df, "n", "name", 3).collect()] == ["c", "a", "b"]
    assert [r.name for r in ranking.full_ranking(df, "n", "name").collect()] == ["c", "a", "b", "d"]


def test_top_k_per_group_cuts_before_the_shuffle(spark):
    df = spark.createDataFrame([("p", f"n{i}", i) for i in range(9)], "page string, name string, n int")
    top = ranking.top_k_per(df, "page", "n", "name", 2)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert {r.name for r in top.collect()} == {"n8", "n7"}


def test_peek(spark):
    df = spark.range(200).withColumn("t", F.col("id") * 2)
    assert ranking.peek(df, "id", 100, -37).first().id == 63
    assert ranking.peek(df, "id", 100, 0).first().id == 0


def test_census_keys_pages_by_id(spark):
    pages = spark.createDataFrame(
        [(1, "t", "{{a}}{{a}}{{b|{{c}}}}"), (2, "t", "{{a}}"), (3, "u", "")],
        "pageid int, title string, wikitext string",
    )
    by_page = census.template_census(pages, by_article=True)
    assert {(r.pageid, r.name, r.n) for r in by_page.collect()} == {
        (1, "a", 2), (1, "b", 1), (1, "c", 1), (2, "a", 1),
    }
    assert census.census_summary(by_page).first().asDict() == {"articles": 2, "names": 3, "uses": 5}
    assert {tuple(r) for r in census.document_frequency(pages).collect()} == {("a", 2), ("b", 1), ("c", 1)}
    rough = census.census_summary(by_page, approximate=True).first()
    assert (rough.articles, rough.names, rough.uses) == (2, 3, 5)


def test_counter_maps(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), ([],)], "ns array<string>")
    maps = [r.m for r in df.select(counter(F.col("ns")).alias("m")).collect()]
    assert maps == [{"a": 1, "b": 2}, {}]
    totals = census.sum_counters(df.select(counter(F.col("ns")).alias("m")), "m").collect()
    assert {tuple(r) for r in totals} == {("a", 1), ("b", 2)}


@pytest.fixture
def uses(spark):
    """One invocation makes up more than a third of all uses."""
    texts = ["{{hot}} x {{v|%d}} {{hot}}{{out|{{in}}}}" % (i % 5) for i in range(60)]
    pages = spark.createDataFrame(list(enumerate([*texts, "", "none", " {{hot}} "])), "pageid long, wikitext string")
    table = [("{{hot}}", "H"), ("{{v|1}}", "one"), ("{{out|{{in}}}}", "[n]"), ("{{hot}}", "H")]
    return pages, spark.createDataFrame(table, "invocation string, expansion string")


def test_expansion_join(uses):
    pages, table = uses
    rows = {r.pageid: (r.expanded, r.unmatched) for r in expand.expand_by_dictionary(pages, table).collect()}
    assert rows[0] == ("H x  H[n]", 1)
    assert rows[1] == ("H x one H[n]", 0)
    assert rows[60] == ("", 0) and rows[61] == ("none", 0) and rows[62] == ("H", 0)
    assert len(rows) == 63


def test_expansion_without_dictionary(uses):
    pages, _ = uses
    first = expand.expand_by_dictionary(pages, None).orderBy("pageid").first()
    assert (first.expanded, first.unmatched) == ("x", 4)


RAW = "pageid long, title string, lang string, revid long, articletype string, wikitext string"


def raw_pages(spark, *texts):
    rows = [(i, f"T{i}", "en", i * 10, "g", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, RAW)


def test_conversion_of_a_page(spark):
    text = (
        "{{Short description|Test page}}\n{{Infobox|a={{val|1}}}}\n'''Page''' of [[a|things]]"
        "<ref>{{cite web}}</ref> {{val|3}}&nbsp;m.<!-- c -->\n\n== Part ==\n* one\n* \n<div>gone</div>"
        "<unk>x</unk>\n; Term\n== References ==\n{{reflist}}\n[[Category:ﬁ]]\n[[Category:B|k]]"
    )
    table = spark.createDataFrame([("{{val|3}}", "3")], "invocation string, expansion string")
    row = convert_pages(raw_pages(spark, text), table).first()
    assert row.markdown == "Page of things 3 m.\n\n## Part\n\n- one\n\nTerm"
    assert row.description == "Test page"
    assert row.categories == ["B", "fi"]
    assert row.unsupported_templates == {"infobox": 1, "cite web": 1, "reflist": 1}
    assert row.unsupported_tags == {"unk": 1}
    assert (row.status, row.lang, row.revid) == ("ok", "en", 0)


def test_styling_is_an_argument(spark):
    pages = raw_pages(spark, "'''a''' <s>b</s>")
    assert convert_pages(pages).first().markdown == "a b"
    assert convert_pages(pages, with_styling=True).first().markdown == "**a** ~~b~~"


def test_outcomes_are_data(spark):
    pages = raw_pages(spark, "fine", "<sub>open", "{{}} x", None, "")
    done = convert_pages(pages)
    assert [r.status for r in done.orderBy("pageid").collect()] == ["ok", "corrupt", "failed", "failed", "ok"]
    assert quality.run_summary(done).first().asDict() == {"total": 5, "ok": 2, "corrupt": 1, "failed": 2}
    again = quality.retry_input(pages, done)
    assert {r.pageid for r in again.collect()} == {2, 3}


def test_markdown_residue_of_deep_nesting_is_flagged(spark):
    deep = "{{nowrap|" * 60 + "x" + "}}" * 59
    assert convert_pages(raw_pages(spark, deep)).first().status == "corrupt"


@pytest.mark.parametrize("depth", [41, 100, 1_000])
def test_markup_of_any_depth(spark, depth):
    links = "[[File:a|" * depth + "x" + "]]" * depth + "[[b|" * depth + "y" + "]]" * depth
    texts = "a {{nowrap|" + "{{nowrap|" * (depth - 1) + "z" + "}}" * depth + " " + links, "{{cite|" * depth + "z" + "}}" * depth
    made = convert_pages(raw_pages(spark, *texts)).orderBy("pageid").collect()
    assert [(r.status, r.markdown) for r in made] == [("ok", "a y"), ("ok", "")]


def test_a_long_dictionary_is_not_shuffled(spark):
    """Only the entries in use go on; the others are read where they lie."""
    pages = spark.createDataFrame([(1, "{{a}} {{b}}"), (2, "{{a}}")], "pageid long, wikitext string")
    long = spark.range(200_000).select(F.concat(F.lit("{{n|"), "id", F.lit("}}")).alias("invocation"), F.lit("x").alias("expansion"))
    out = expand.expand_by_dictionary(pages, long.unionByName(spark.createDataFrame([("{{a}}", "A")], long.schema)))
    assert sorted((r.pageid, r.expanded, r.unmatched) for r in out.collect()) == [(1, "A", 1), (2, "A", 0)]
    lines = out._jdf.queryExecution().sparkPlan().toString().splitlines()
    assert any("BroadcastHashJoin" in line and "LeftSemi" in line for line in lines)


def test_a_listing_is_not_sent_whole_through_the_driver(spark):
    stored = spark.createDataFrame([("a", 1, 2, "x")], "title string, pageid long, revid long, wikitext string")
    listing = spark.createDataFrame([("a", "g")], "title string, articletype string")
    raw = catalog.assemble_raw(stored, listing)
    assert [tuple(r) for r in raw.collect()] == [(1, "a", "en", 2, "g", "x")]
    assert "BroadcastExchange" not in raw._jdf.queryExecution().executedPlan().toString()
