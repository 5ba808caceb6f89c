from pyspark.sql import functions as F

from markloom.functions import links as L


def test_links_to_text(apply):
    cases = {
        "[[a]]": "a",
        "[[a|b]]": "b",
        "[[a|]]": "a",
        "[[a|b|c]]": "b|c",
        "[[a\nb]]": "[[a\nb]]",
        "x [1] [[a|[2]]] y": "x [1] [2] y",
        "[[a": "[[a",
        "[[:File:a.png]]": ":File:a.png",
    }
    assert apply(L.links_to_text, *cases) == list(cases.values())


def test_media_goes_with_its_caption(apply):
    cases = {
        "a[[File:x.png|thumb|in [[b|c]] [1] d]]e": "ae",
        "[[image:x.png]]": "",
        "[[MEDIA:x]]": "",
        "[[ File:x]]": " File:x",
        "[[File:x|[[File:y|[[z]]]]]]!": "!",
    }
    assert apply(L.resolve_links, *cases) == list(cases.values())
    assert apply(L.drop_media, "[[a]] [[File:x|[[b]]]] [[c|d]]") == "[[a]]  [[c|d]]"


def test_categories(apply, spark):
    text = "[[Category: B |key]] [[category:ﬁ]] [[Category:A]]"
    pages = spark.createDataFrame([(1, text), (2, "none")], "pageid long, wikitext string")
    got = {r.pageid: r.categories for r in L.with_categories(pages).collect()}
    assert got == {1: ["B", "fi", "A"], 2: []}
    edges = {tuple(r) for r in L.category_edges(pages).collect()}
    assert edges == {(1, "B"), (1, "fi"), (1, "A")}


def test_category_links_before_and_after_expansion(apply):
    cases = ["[[Category:A]]", "[[Category:A|k]]", "[[Category:A|]]", "[[Category:A|Category:k]]"]
    before = ["[[Category:A|A]]", "[[Category:A|k]]", "[[Category:A|A]]", "[[Category:A|k]]"]
    assert apply(L.resolve_links, *cases) == before
    after = apply(lambda c: L.resolve_links(c, after_expansion=True), *cases)
    assert after == ["", *before[1:]]


def test_external_links(apply):
    cases = {
        "[http://e.org a b] c": "a b c",
        "[https://e.org/x]": "",
        "see http://e.org/a?b=1, or": "see , or",
        "[//e.org t]": "t",
        "a // b": "a // b",
        "[1] [x y]": "[1] [x y]",
    }
    assert apply(L.external_to_text, *cases) == list(cases.values())


def test_switches_and_comments(apply):
    assert apply(L.drop_switches, "a__NOTOC__b____c__x__") == "abc__x__"
    cases = {
        "a<!-- x\ny -->b<!-- open": "ab<!-- open",
        "a --> b <!-- c <!-- d --> e --> f": "a --> b  e --> f",
        "a<!-->b-->c": "ac",
        "<!---->x": "x",
        "<!-- " * 100_000: "<!-- " * 100_000,
    }
    assert apply(L.drop_comments, *cases) == list(cases.values())


def test_thousands_of_links_do_not_exhaust_the_stack(apply):
    many = "[[a|b]] [x] " * 20_000
    assert apply(L.resolve_links, many) == "b [x] " * 20_000
    nested = "[[File:x|" + "[[a|b]] [y] " * 20_000 + "]]"
    assert apply(L.resolve_links, nested) == ""


def test_edges_keep_document_order(spark):
    pages = spark.createDataFrame([(1, "[[Category:Z]][[Category:A]]")], "pageid long, wikitext string")
    assert [r.category for r in L.category_edges(pages).collect()] == ["Z", "A"]
    assert pages.select(F.size(L.raw_categories(F.col("wikitext")))).first()[0] == 2
