import time

import pytest
from pyspark.sql import functions as F

from markloom.functions import markdown as M


def test_cleanup(apply):
    cases = {
        "a <!-- b --> c <!-- d\ne -->": "a  c <!-- d\ne -->",
        "x\\|}y": "xy",
        "a\n \t\xa0\u2028\n\x1c\nb": "a\n\nb",
        "a  \nb\xa0\nc \r\nd": "a\nb\nc \r\nd",
        "1.  a\n-   b\n  -   c\n12.   d\n-  \n- \n-\n- e": "1. a\n- b\n  -   c\n12. d\n- e",
        "\\[1\\] \\$ \\# <sup>\\[update\\]</sup><sup>[update]</sup>": "[1] \\$ \\#",
        'Format price error: cannot parse value "1 "a" 2" z': '1 a" 2" z',
        "\x1c\u3000 a \x85": "a",
        "-\n": "",
        "": "",
        "ﬁ ½ x²": "fi 1\u20442 x2",
    }
    assert apply(M.clean_markdown, *cases) == list(cases.values())


def test_blocks(apply):
    cases = {
        "== A ==\ntext\nmore\n\n* x\n** y\n*z": "## A\n\ntext more\n\n- x\n  - y\n- z",
        "# a\n## b\n## c\n# d\n\n# e": "1.  a\n    1.  b\n    2.  c\n2.  d\n\n1.  e",
        "#a\n#* b\n# c": "1.  a\n    - b\n2.  c",
        "; t\n: d\ntext": "t\n\nd\n\ntext",
        " code  x\n  y $\nz": "`code  x`\n` y $`\n\nz",
        "<blockquote>\n a\n b\n</blockquote>\nz": "> `a`\n> `b`\n\nz",
        "<blockquote>a<blockquote>b</blockquote></blockquote>": "> a\n> \n> > b",
        "<math>a_1 < b</math> $5 #1 a_b _c_ <": "$a_1 < b$ \\$5 \\#1 a_b \\_c\\_ \\<",
        "<math>\n x</math>": "<math>\n x</math>",
        "a<br>b <br/>\nc": "a\nb\nc",
        "&lt;b&gt; &amp;amp; &#65;&#x42; &bogus; &eacute;": "\\<b\\> &amp; AB &bogus; é",
        "<nowiki>'''a''' [[b]]</nowiki>": "'''a''' \\[\\[b\\]\\]",
        "'''a''' ''b'' '''''c'''''": "**a** *b* ***c***",
        "H<sub>2</sub>O": "H<sub>2</sub>O",
        "<pre>\na *b*\n\nc\n</pre>": "```\na *b*\n\nc\n```",
        "&#42; not a list": "\\* not a list",
        "<ol><li>a<ol><li>b</li></ol></li><li>c</li></ol>": "1.  a\n    1.  b\n2.  c",
        "x <ul>\n<li>a<ul>\n<li>b</li>\n<li>c</li></ul></li>\n<li>d</li>\n</ul> y": "x\n\n- a\n  - b\n  - c\n- d\n\ny",
        "<ol><li>a</li><li>b<ul><li>c</li></ul></li><li>d</li></ol>": "1.  a\n2.  b\n    - c\n3.  d",
        "<li>a</li><li>b": "- a\n- b",
        "# a\n#* x\n#* y\n# b\n* z\n# c": "1.  a\n    - x\n    - y\n2.  b\n- z\n1.  c",
        "": "",
    }
    assert apply(M.blocks_to_markdown, *cases) == list(cases.values())


@pytest.mark.parametrize("tag", ["<ol>", "<ol><li>", "<pre>", "<nowiki>", "<code>a</code><pre>", "#"])
def test_time_grows_with_the_length(apply, tag):
    """Tags that are never closed beside one that is."""

    def seconds(size):
        text = tag * (size // len(tag)) + "</pre><math>x</math>"
        start = time.perf_counter()
        apply(lambda c: F.length(M.blocks_to_markdown(c)).cast("string"), text)
        return time.perf_counter() - start

    seconds(100)
    assert seconds(160_000) <= 8 * max(seconds(40_000), 0.5)


def test_long_numbered_list(apply):
    text = "\n".join(f"# i{i}" for i in range(1, 3001))
    got = apply(M.blocks_to_markdown, text).split("\n")
    assert got[0] == "1.  i1" and got[9] == "10. i10" and got[2999] == "3000. i3000"


def test_corrupt(apply):
    cases = {
        "<sub>a</sub>": False, "<sub>a": True, "a</sub>": True, "<SUB>a</sub >": False, "<br>": False,
        "[[a": True, "[[a]]": False, "{{a": True, "<math>[[</math>": False, "<sub/>": False,
        "<li>a": False, "<sub><sup></sub></sup>": False,
        "}}a{{": True, "]]a[[b": True, "]][[": True, "[[a]] {{b}}": False, "{{" * 60 + "}}" * 60: False,
    }
    assert apply(M.is_corrupt, *cases) == list(cases.values())


def test_character_references_with_leading_zeros(apply):
    assert apply(M.decode_entities, "a &#0000000065; &#x0000041; &#00; b") == "a A A &#00; b"
