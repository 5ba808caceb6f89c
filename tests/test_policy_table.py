"""Policies out of tables, and places in a whole order."""

import random
from collections import Counter

from pyspark.sql import functions as F

from markloom.functions.dims import TemplatePolicy
from markloom.functions.templates import apply_template_policy
from markloom.operators import census, ranking
from markloom.operators.policy import keep_listed_templates, with_listed_names
from markloom.plans.convert import convert_pages
from markloom.schemas import RAW_SCHEMA

PIECES = ["{{", "}}", "|", "a", "B", "c_d", " ", "{{a", "{{ b|", "{{{p}}}", "{{#if:x|", "{{lang-de|", "=", "\n"]


def random_texts(n):
    pick = random.Random(7)
    return ["".join(pick.choice(PIECES) for _ in range(pick.randrange(1, 30))) for _ in range(n)]


def test_a_table_keeps_what_the_same_names_in_the_code_keep(spark):
    texts = random_texts(600) + ["{{a{{b}}|x}}", "{{a{{c}}|x}}", "{{a{{c|y}}b}}", "{{{{c}}a|x}}", "{{a{{b|{{c}}}}}}", None, ""]
    pages = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "pageid long, wikitext string")
    names = ["A", "B", "ab", "c d", "ba", "a b"]
    table = spark.createDataFrame([(n,) for n in [*names, "a", None]], "name string")
    want = pages.select("pageid", apply_template_policy(F.col("wikitext"), TemplatePolicy.of(names)).alias("wikitext"))
    got = keep_listed_templates(pages, table)
    assert got.columns == pages.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_a_policy_of_many_names(spark):
    names = spark.range(200_000).select(F.concat(F.lit("Name "), F.col("id").cast("string")).alias("name"))
    pages = spark.range(3_000).select(
        (F.col("id") * 100).alias("pageid"),
        F.concat(F.lit("x {{name_"), (F.col("id") * 100).cast("string"), F.lit("|{{hot}}{{Name 5}}}} y")).alias("wikitext"),
    )
    got = {r.pageid: r.wikitext for r in keep_listed_templates(pages, names).collect()}
    assert len(got) == 3_000
    assert all(t == (f"x {{{{name_{i}|{{{{Name 5}}}}}}}} y" if i < 200_000 else "x  y") for i, t in got.items())


def test_listed_names_of_awkward_pages(spark):
    pages = spark.createDataFrame([(1, "{{a}}{{b}}"), (1, "{{a}}{{b}}"), (None, "{{b}}"), (2, None), (3, "")], "pageid long, wikitext string")
    table = spark.createDataFrame([("a",), ("A",), ("z",)], "name string")
    got = Counter((r.pageid, tuple(r.listed)) for r in with_listed_names(pages, table).collect())
    assert got == Counter({(1, ("a",)): 2, (None, ()): 1, (2, ()): 1, (3, ()): 1})
    assert with_listed_names(pages.limit(0), table).count() == 0
    assert {tuple(r.listed) for r in with_listed_names(pages, table.limit(0)).collect()} == {()}


def test_conversion_with_a_table(spark):
    text = "Lead {{keep me|1}} and {{drop me|2}} and {{Keep_me}} end."
    raw = spark.createDataFrame([(1, "One", "en", 1, "g", text), (2, "Two", "en", 1, "g", None)], "pageid long, title string, lang string, revid long, articletype string, wikitext string")
    raw = raw.select(*[F.col(f.name).cast(f.dataType) for f in RAW_SCHEMA.fields])
    entries = spark.createDataFrame([("{{keep me|1}}", "ONE"), ("{{Keep_me}}", "TWO")], "invocation string, expansion string")
    table = spark.createDataFrame([("Keep me",)], "name string")
    columns = ["pageid", "markdown", "unsupported_templates", "status", "error"]
    got = sorted(map(tuple, convert_pages(raw, entries, policy=table).select(*columns).collect()))
    want = sorted(map(tuple, convert_pages(raw, entries, policy=TemplatePolicy.of(["Keep me"])).select(*columns).collect()))
    assert got == want
    assert "ONE" in got[0][1] and "TWO" in got[0][1] and "drop" not in got[0][1]
    assert got[0][2] == {"drop me": 1} and got[1][3] == "failed"


def test_places_in_the_whole_order(spark):
    pick = random.Random(3)
    rows = [(f"w{i:04d}", pick.choice([1, 1, 1, 2, 7, None])) for i in range(2_000)]
    df = spark.createDataFrame(rows, "name string, n long").repartition(7)
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    sums, want = 0, []
    for place, (name, n) in enumerate(order, 1):
        sums += n or 0
        want.append((place, name, n, sums))
    placed = ranking.ranked(df, "n", "name", running="n")
    got = sorted((r["rank"], r.name, r.n, r.running) for r in placed.collect())
    assert got == want
    assert {(r.of, r.whole) for r in placed.collect()} == {(2_000, sums)}
    at = ranking.at_places(ranking.ranked(df, "n", "name"), [1, 500, -1, -3, 5_000, -9_000])
    assert {r.name for r in at.collect()} == {order[i][0] for i in (0, 499, -1, -3)}
    assert ranking.ranked(df.limit(0), "n", "name", running="n").count() == 0


def test_no_window_over_the_whole_table(spark):
    df = spark.range(100).select(F.col("id").alias("n"), F.col("id").cast("string").alias("name"))
    placed = ranking.ranked(df, "n", "name", running="n")
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange SinglePartition" not in plan.split("Window")[1].split("BroadcastExchange")[0]


def test_coverage_takes_the_fewest_templates(spark):
    pages = spark.createDataFrame([(1, "{{a}}" * 6 + "{{b}}" * 3 + "{{c}}")], "pageid long, wikitext string")
    names = lambda p: [r.name for r in census.keep_by_coverage(pages, p, streamlined=False).orderBy("running").collect()]
    assert names(60) == ["a"] and names(61) == ["a", "b"] and names(90) == ["a", "b"] and names(100) == ["a", "b", "c"] and names(0) == []
