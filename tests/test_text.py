"""Whitespace, normalisation and the two rewriting combinators."""

import time
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from markloom.functions.text import nfkc
from markloom.functions import text as X

ODD_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2003\u2028\u2029\u202f\u205f\u3000"


def test_strip_and_split_follow_python(apply):
    texts = [f"{ODD_SPACES}a{ODD_SPACES}b{ODD_SPACES}", "", ODD_SPACES, "x", "\u200bx\u200b"]
    assert apply(X.py_strip, *texts) == [t.strip() for t in texts]
    assert apply(X.py_split, *texts) == [t.split() for t in texts]


def test_nfkc(apply):
    texts = ["ﬁx\xa0y²", "ascii", "", "A\u030a", None]
    assert apply(X.nfkc, *texts) == [t and unicodedata.normalize("NFKC", t) for t in texts]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=30), min_size=1, max_size=8))
def test_strip_on_any_text(apply, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert apply(X.py_strip, "pad", *texts)[1:] == [t.strip() for t in texts]


def test_slug(apply):
    assert apply(X.slug, "  Pi  Day \xa0x ") == "pi_day_x"
    assert apply(lambda c: X.slug(c, runs=False), " A  B ") == "a__b"


def test_tokens(apply):
    assert apply(X.approx_tokens, "ab1, c", "", "é²!") == [4, 0, 3]


def test_rewrite_matches(apply):
    up = lambda c: X.rewrite_matches(c, "b+", F.upper)
    assert apply(up, "abba", "bb", "", "xyz", "bab") == ["aBBa", "BB", "", "xyz", "BaB"]


def test_pairs_are_settled_from_the_innermost_outwards(apply):
    step = lambda x: F.concat(F.lit("{"), x, F.lit("}"))
    texts = ["", "a", "<a>", "x<a<b>c>y<d>z", "a>b<c>", "<a", "<<a>", "<>", "a><"]
    want = ["", "a", "{a}", "x{a{b}c}y{d}z", "a>b{c}", "<a", "<{a}", "{}", "a><"]
    assert apply(lambda c: X.settle_nested(c, "<", ">", step), *texts) == want


@pytest.mark.parametrize("depth", [41, 100, 1_000])
def test_any_depth_is_settled(apply, depth):
    step = lambda x: F.concat(F.lit("{"), x, F.lit("}"))
    deep = "a<b" * depth + "z" + ">c" * depth
    got = apply(lambda c: X.settle_nested(c, "<", ">", step), deep, deep + ">", "<" + deep, deep * 2)
    want = deep.replace("<", "{").replace(">", "}")
    assert got == [want, want + ">", "<" + want, want * 2]


def test_many_pairs_beside_and_inside_one(apply):
    step = lambda x: F.concat(F.lit("{"), x, F.lit("}"))
    flat = "".join(f"<{i}<{i}>>t" for i in range(700))
    want = flat.replace("<", "{").replace(">", "}")
    assert apply(lambda c: X.settle_nested(c, "<", ">", step), flat, f"<{flat}>") == [want, "{" + want + "}"]


def test_pairs_of_two_kinds(apply):
    """Round brackets go with what is in them, angle ones leave it; both end with "/"."""
    named = lambda body, kind: F.when(kind == "(", "").otherwise(body)
    texts = ["a(b/c", "<a(b<c/d/e/f/", "((x/", "<x", "/", "a<b(c/d/e"]
    want = ["ac", "aef/", "(", "<x", "/", "abde"]
    assert apply(lambda c: X.fold_nested(c, "(<", "/", named), *texts) == want


def test_time_grows_with_the_depth(apply):
    step = lambda x: F.concat(F.lit("{"), x, F.lit("}"))

    def seconds(depth):
        text = ("<" * depth + "z" + ">" * depth) * 5
        best = []
        for _ in range(3):
            start = time.perf_counter()
            apply(lambda c: F.length(X.settle_nested(c, "<", ">", step)).cast("string"), text)
            best.append(time.perf_counter() - start)
        return min(best)

    seconds(10)
    assert seconds(1_000) <= 12 * seconds(100)


def test_guard_removes_noncharacters(apply):
    assert apply(X.guard, "a\ufdd0b\ufdefc") == "abc"


def test_nfkc_bounds_the_rows_of_a_batch(spark):
    """Long texts must not travel by the ten thousand, whatever the session was started with."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, 10_000)
        rows = spark.range(700).select(F.concat(F.lit("ﬁ"), "id").alias("t")).select("t", nfkc(F.col("t")).alias("n"))
        assert int(spark.conf.get(name)) <= 512
        assert all(r.n == "fi" + r.t[1:] for r in rows.collect())
    finally:
        spark.conf.set(name, before)
