from markloom.functions import tags as G
from markloom.functions.dims import TagPolicy


def both(c, policy=None):
    return G.apply_markup_policy(G.apply_tag_policy(c, policy), policy)


def test_policy_plain(apply):
    cases = {
        "a<b>x</b><br>y": "ax<br>y",
        "<div><div>a</div>b</div>c": "c",
        "<ref name=x />a<ref>b</ref>c": "ac",
        "<foo>x</foo>y": "y",
        "<foo>x": "<foo>x",
        "<foo/>y": "y",
        "a<hr>b<img src=x>c": "abc",
        "<div>open": "<div>open",
        "<td>a<td>b": "ab",
        "<p>a<p>b</p>": "ab",
        "<INS>a</INS>": "<u>a</u>",
        "<samp>a</samp><kbd>b</kbd>": "a<code>b</code>",
        "<poem>a</poem>": "<blockquote>a</blockquote>",
        "<dl><dt>a</dt><dd>b</dd></dl>": "; a: b",
        "<h2 id=x>T</h2>": "== T ==",
        "a < b > c": "a < b > c",
        "<sub>1</sub><sup>2</sup>": "<sub>1</sub><sup>2</sup>",
    }
    assert apply(G.apply_tag_policy, *cases) == list(cases.values())


def test_policy_styled(apply):
    styled = TagPolicy(styled=True)
    cases = {
        "<b>a</b><em>b</em>": "'''a'''''b''",
        "<u>a</u><s>b</s>": "<u>a</u><del>b</del>",
        "'''a''' ''b''": "'''a''' ''b''",
    }
    assert apply(lambda c: both(c, styled), *cases) == list(cases.values())


def test_spans(apply):
    cases = {
        '<span class="flagicon">a</span>': "a",
        "<span flagicon>a</span>b": "b",
        '<span id=x flagicon="1">a<span>b</span></span>c': "c",
        "<span>a<span flagicon=1>b</span>c</span>": "ac",
    }
    assert apply(G.resolve_spans, *cases) == list(cases.values())


def test_markup(apply):
    cases = {
        "'''''a''''' '''b''' ''c'' d'e": "a b c d'e",
        "''a\nb''": "''a\nb''",
        "{|\n| a\n{|\n| b\n|}\n|}\nafter": "\nafter",
        ":{| x\n|}\n": ":\n".replace(":", ": "),
        "----\na": "\na",
        ":: x\n;y\n* z\n#:q": ": :  x\n; y\n* z\n#: q",
        "{| open": "{| open",
        "{{x\n|}}": "{{x\n|}}",
    }
    assert apply(G.apply_markup_policy, *cases) == list(cases.values())


def test_opaque_content_is_left_alone(apply):
    text = "<nowiki>[[a]] <b>'''x'''</nowiki><!-- c --><math>{a<b}</math>"
    hidden = lambda c: G.show_opaque(both(G.hide_opaque(c)))
    assert apply(hidden, text) == text.replace("<!-- c -->", "")


def test_attributes(spark, apply):
    got = apply(G.parse_attributes, """<a class=" x " href="?a=b" hidden id=7>""")
    assert [(a.attribute, a.value) for a in got] == [
        ("class", '" x "'), ("href", None), ("hidden", None), ("id", "7"),
    ]


def test_occurrences_with_markup(spark):
    pages = spark.createDataFrame(
        [(1, "* a\n** b\n;c\n:d\n----\n'''x''' ''y'' '''''z'''''\n{|\n|}\n<SUB>1</SUB><br/>")],
        "pageid long, text string",
    )
    got = G.tag_occurrences(pages, "text", markup=True).groupBy("name").count().collect()
    assert {r.name: r["count"] for r in got} == {
        "li": 3, "dt": 1, "dd": 1, "hr": 1, "b": 2, "i": 2, "table": 1, "sub": 1, "br": 1,
    }


def test_large_content_between_tags(apply):
    assert apply(G.apply_tag_policy, "<table>" + "x y " * 100_000 + "</table>z") == "z"
