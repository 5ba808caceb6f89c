import pytest
from pyspark.sql import functions as F

from markloom.functions import templates as T
from markloom.functions.dims import (
    COUNTRY_CODES,
    KEPT_TEMPLATES,
    PARSER_FUNCTIONS,
    TemplatePolicy,
)


@pytest.fixture(scope="module")
def policy():
    return TemplatePolicy.default()


def test_policy_names(apply):
    cases = {"Cite web": "cite web", " Cite": "Cite", "a_b": "a b", "ABC": "aBC", "Éa": "éa", "x ": "x"}
    assert apply(T.template_name, *cases) == list(cases.values())


def test_policy_membership(apply, policy):
    kept = ["val", "lang-fr", "aGO", "uSSR", "hKG-CHN", "#if:x", "formatnum", "cURRENTMONTHNAME",
            "birth date and age", "death year and age", "spaced ndash", "sndash", "typo", "not a typo",
            "' \"", "•", "h-phrases"]
    gone = ["AGO", "xyz", "reflist", "death year", "snd ash", "Val", "#iff", "", "va", "not a", "cURRENTX"]
    assert apply(policy.keeps, *kept) == [True] * len(kept)
    assert apply(policy.keeps, *gone) == [False] * len(gone)


def test_sizes_of_the_fixed_sets():
    assert len(PARSER_FUNCTIONS) == 19
    assert len(COUNTRY_CODES) == 370
    assert len(KEPT_TEMPLATES) == 229


def test_the_policy_table_has_every_kept_name(spark, policy):
    names = {r.name for r in policy.table(spark).collect()}
    assert {"ndash", "birth date", "aGO", "flagIOC", "cURRENTMONTH1", "h-phrases"} <= names


def test_keep_and_drop(apply, policy):
    cases = {
        "a{{x}}b": "ab",
        "{{val|1}}": "{{val|1}}",
        "{{x|{{val|1}}}}": "",
        "{{nowrap|a {{x}} b}}": "{{nowrap|a  b}}",
        "{{nowrap|{{val|1}} {{x|{{y}}}}}}!": "{{nowrap|{{val|1}} }}!",
        "{{math|{a}}} c": "{{math|{a}}} c",
        "{{{p}}} {{{q|{{x}}}}}": "{{{p}}} {{{q|}}}",
        "{{x": "{{x",
        "x}} {{y}}": "x}} ",
        "{{#if:a|b}}": "{{#if:a|b}}",
        "{{Lang-fr|a}}": "{{Lang-fr|a}}",
        "{{ Cite}}": "",
    }
    assert apply(lambda c: T.apply_template_policy(c, policy), *cases) == list(cases.values())


def test_all_dropped_names_are_counted(apply, policy):
    names = apply(
        lambda c: T.unsupported_names(T.raw_names(c), policy),
        "{{x|{{val|1}}{{Y_z}}}}{{short description|q}}{{ Cite}}{{x}}{{open",
    )
    assert sorted(names) == ["Cite", "x", "x", "y z"]


def test_magic(apply):
    cases = {"{{!}}": "|", "{{end}}{{End}}": "|}|}", "{{jctbtm|a=b}}": "|}", "{{ End}}": "{{ End}}",
             "{{ end }}": "|}", "{{bend}}": "{{bend}}"}
    assert apply(T.magic_templates, *cases) == list(cases.values())


def test_descriptions(spark):
    texts = {
        "{{Short description|A shrub}}": "A shrub",
        "{{short description|none}}": None,
        "{{Short_description| x² }}": "x2",
        "{{Short description|}}": None,
        "{{Short description|1=a=b}}": "a=b",
        "{{Short description|a|2=x|1=c}}": "c",
        "{{ Short description|a}}": None,
        "{{ short description|a}}": "a",
        "no": None,
        "{{Short description|a}}{{Short description|b}}": "a",
        "{{Short description|a}}\n== S ==\n{{Short description|c}}": "c",
    }
    pages = spark.createDataFrame(list(enumerate(texts)), "pageid long, wikitext string")
    got = [r.description for r in T.with_short_description(pages).orderBy("pageid").collect()]
    assert got == list(texts.values())


def test_params(spark):
    text = "{{Box | a = 1|b={{in|x=y|z}}|a=2|c=|pos|q=r=s}}"
    pages = spark.createDataFrame([(7, text)], "pageid long, wikitext string")
    got = {tuple(r) for r in T.template_params(pages).collect()}
    assert got == {
        (7, "in", "x", "y"), (7, "in", "1", "z"),
        (7, "box", "b", "{{in|x=y|z}}"), (7, "box", "a", "2"), (7, "box", "1", "pos"), (7, "box", "q", "r=s"),
    }


def test_segments_cut_at_outermost_templates(apply):
    cases = {
        "a{{x|{{y}}}}b{{z}}": ["a", "{{x|{{y}}}}", "b", "{{z}}", ""],
        "": [""],
        "plain": ["plain"],
        "{{x": ["{{x"],
        "{{a}}{{b|{c}}}": ["", "{{a}}", "", "{{b|{c}}", "}"],
    }
    assert apply(T.invocation_segments, *cases) == list(cases.values())


def test_streamline(apply):
    text = (
        "a{{Infobox x|{{val}}}}<ref>{{cite}}</ref>{{val|1}}\n== References ==\nx\n=== Sub ===\ny\n"
        "<table><tr><td><table></table></td></tr></table>\n{|\n|{{z}}\n|}\nend"
    )
    assert apply(T.streamline, text) == "a{{val|1}}\n\n\n=== Sub ===\ny\n\n\nend"


def test_deep_nesting(apply, policy):
    deep = "{{nowrap|" * 30 + "x{{gone}}" + "}}" * 30
    assert apply(lambda c: T.apply_template_policy(c, policy), deep) == deep.replace("{{gone}}", "")


def test_many_templates_on_one_page(apply, policy):
    text = "{{val|1}} {{x|{ {{y}} }}} " * 5_000
    assert apply(lambda c: T.apply_template_policy(c, policy), text) == "{{val|1}} } " * 5_000


def test_census_counts_nested_names(spark):
    pages = spark.createDataFrame([(1, "{{ A |{{b}}}}{{a}}")], "pageid long, wikitext string")
    got = T.template_occurrences(pages).groupBy("name").agg(F.count("*").alias("n")).collect()
    assert {(r.name, r.n) for r in got} == {("a", 2), ("b", 1)}


def test_names_of_a_policy_are_looked_up_in_a_set(spark):
    """Quotes, backslashes and the former separator are ordinary characters of a name."""
    from markloom.functions.dims import is_one_of

    rows = spark.createDataFrame([("it's",), ("a\\b",), ("x",), ("x\x1fy",), ("",), (None,)], "n string")
    found = is_one_of(F.col("n"), ["it's", "a\\b", "x", "y"])
    assert [r.f for r in rows.select(found.alias("f")).collect()] == [True, True, True, False, False, None]
