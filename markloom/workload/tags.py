"""Tag operators on raw web pages and on page markup."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tags as tg
from ..functions.dims import TagPolicy
from ..functions.links import drop_comments
from ..operators.census import sum_counters
from ..plans.convert import counter
from .registry import query, sql_chain, table

_NAME = "[A-Za-z][A-Za-z0-9]*"
# Tags of a web page that page markup does not know.
_FRAME = ("html", "head", "meta", "title", "script", "body", "nav", "article", "footer")
_FRAMES = rf"(?i)</?(?:{'|'.join(_FRAME)})(?:\s[^<>]*)?/?>"


def web_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "html")


def _html_sql(*steps: tuple[str, str]) -> str:
    return f"SELECT page_id, {sql_chain('html', *steps)} AS html FROM pages"


def _pair(name: str) -> tuple[str, str]:
    return rf"(?is)<{name}(?:\s[^<>]*)?>.*?</{name}\s*>", ""


@query("f2_drop_comments", f"SELECT page_id, {sql_chain('html', ('(?s)<!--.*?-->', ''))} AS html FROM pages")
def _(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", drop_comments(F.col("html")).alias("html"))


@query(
    "f25_kept_tags",
    _html_sql(
        (_FRAMES, ""), _pair("style"), _pair("div"), (r"(?i)</?(?:p|b|a)(?:\s[^<>]*)?/?>", ""),
        (r"(?i)<h1(?:\s[^<>]*)?/?>", "= "), (r"(?i)</h1\s*>", " ="),
    ),
)
def _(spark, sf_dir):
    """All tag rules over the whole page: lists and line breaks are what stays."""
    inner = tg.unwrap_tags(F.col("html"), _FRAME)
    return web_pages(spark, sf_dir).select("page_id", tg.apply_tag_policy(inner, TagPolicy()).alias("html"))


@query("f26_unwrap_tags", _html_sql((r"(?i)</?(?:p|b|a)(?:\s[^<>]*)?/?>", "")))
def _(spark, sf_dir):
    return web_pages(spark, sf_dir).select("page_id", tg.unwrap_tags(F.col("html"), ["p", "b", "a"]).alias("html"))


@query(
    "f27_delete_tags",
    "SELECT page_id, "
    + sql_chain(
        "html",
        (r"(?is)<style(?:\s[^<>]*)?>.*?</style\s*>", ""),
        (r"(?is)<div(?:\s[^<>]*)?>.*?</div\s*>", ""),
        (r"(?is)<ul(?:\s[^<>]*)?>.*?</ul\s*>", ""),
    )
    + " AS html FROM pages",
)
def _(spark, sf_dir):
    gone = tg.delete_tags(F.col("html"), ["style", "div", "ul"])
    return table(spark, sf_dir, "pages").select("page_id", gone.alias("html"))


@query(
    "f27_delete_nested_tags",
    "SELECT p_partkey, concat('a', p_type, 'd') AS text FROM part",
)
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    name = F.col("p_name")
    text = F.concat(
        F.lit("a<div>"), name, F.lit("<div><ref>x</ref>"), name, F.lit("</div>y</div>"), "p_type",
        F.lit('<ref name="q"/><hr>d'),
    )
    return part.select("p_partkey", tg.delete_tags(text, TagPolicy().having("delete")).alias("text"))


@query("f28_spans", "SELECT p_partkey, concat(p_name, ' ', p_type) AS text FROM part")
def _(spark, sf_dir):
    text = F.concat(
        F.lit('<span class="flagicon">'), "p_name", F.lit('</span><span flagicon="1">'), "p_brand",
        F.lit("</span> <span>"), "p_type", F.lit("</span>"),
    )
    return table(spark, sf_dir, "part").select("p_partkey", tg.resolve_spans(text).alias("text"))


@query(
    "f29_tag_attributes",
    "SELECT page_id, tag, attribute, CASE WHEN len(regexp_extract_all(raw, '=')) = 1 "
    "THEN split_part(raw, '=', 2) END AS value FROM (SELECT page_id, tag, raw, "
    "split_part(raw, '=', 1) AS attribute FROM (SELECT page_id, tag, "
    "unnest(regexp_extract_all(opening, '\\s([a-z]+=\"[^\"]*\")', 1)) AS raw FROM (SELECT page_id, opening, "
    f"lower(regexp_extract(opening, '<({_NAME})', 1)) AS tag FROM (SELECT page_id, "
    f"unnest(regexp_extract_all(html, '<{_NAME}\\s[^<>]*>')) AS opening FROM pages))))",
)
def _(spark, sf_dir):
    return tg.tag_attributes(table(spark, sf_dir, "pages"), "html", "page_id")


@query(
    "f30_headings_from_tags",
    "SELECT p_partkey, concat('= ', p_name, ' =', chr(10), '== ', p_type, ' ==', chr(10), '=== a ===', "
    "chr(10), '==== b ====', chr(10), '===== c =====', chr(10), '====== d ======') AS text FROM part",
)
def _(spark, sf_dir):
    text = F.concat(
        F.lit("<h1>"), "p_name", F.lit('</h1>\n<h2 id="x">'), "p_type",
        F.lit("</h2>\n<H3>a</H3>\n<h4>b</h4>\n<h5>c</h5>\n<h6>d</h6>"),
    )
    done = tg.rewrite_tags(text, TagPolicy())
    return table(spark, sf_dir, "part").select("p_partkey", done.alias("text"))


@query("f30_headings_of_articles", _html_sql((r"(?i)<h1(?:\s[^<>]*)?/?>", "= "), (r"(?i)</h1\s*>", " =")))
def _(spark, sf_dir):
    return web_pages(spark, sf_dir).select("page_id", tg.rewrite_tags(F.col("html"), TagPolicy()).alias("html"))


_REWRITES = (
    "<b>{}</b><strong>s</strong><i>i</i><em>e</em><ins>n</ins><q>q</q><s>t</s><strike>u</strike>"
    "<kbd>k</kbd><tt>m</tt><dl>\n<dt>x</dt>\n<dd>y</dd></dl><poem>z</poem><samp>w</samp>"
)


@query(
    "f31_rewritten_tags_styled",
    "SELECT p_partkey, concat('''''''', p_name, '''''''''''''s''''''''''i''''''''e''''<u>n</u>\"q\"<del>t</del><del>u</del>"
    "<code>k</code><code>m</code>', chr(10), '; x', chr(10), ': y<blockquote>z</blockquote>w') AS text FROM part",
)
def _(spark, sf_dir):
    before, after = _REWRITES.split("{}")
    done = tg.apply_tag_policy(F.concat(F.lit(before), "p_name", F.lit(after)), TagPolicy(styled=True))
    return table(spark, sf_dir, "part").select("p_partkey", done.alias("text"))


@query(
    "f31_rewritten_tags_plain",
    "SELECT p_partkey, concat(p_name, 'sie<u>n</u>\"q\"tu<code>k</code><code>m</code>', chr(10), '; x', "
    "chr(10), ': y<blockquote>z</blockquote>w') AS text FROM part",
)
def _(spark, sf_dir):
    before, after = _REWRITES.split("{}")
    done = tg.apply_tag_policy(F.concat(F.lit(before), "p_name", F.lit(after)), TagPolicy())
    return table(spark, sf_dir, "part").select("p_partkey", done.alias("text"))


_UNKNOWN = (
    f"(SELECT page_id, lower(unnest(regexp_extract_all(html, '<({_NAME})[\\s/>]', 1))) AS name FROM pages) "
    "WHERE name NOT IN ('br','ul','li','style','div','a','p','b','h1','h2')"
)


@query("f32_unsupported_tags", f"SELECT page_id, name FROM {_UNKNOWN}")
def _(spark, sf_dir):
    names = tg.unsupported_tag_names(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.explode(names).alias("name"))


_OPEN = r"</(?:html|body|article)>"


@query("f32_delete_unknown_tags", _html_sql((_OPEN, ""), *map(_pair, ("head", "nav", "footer"))))
def _(spark, sf_dir):
    """A tag without a policy goes with its content, unless it is not closed."""
    known = list(TagPolicy().actions())
    text = F.regexp_replace("html", _OPEN, "")
    return web_pages(spark, sf_dir).select("page_id", tg.delete_unknown(text, known).alias("html"))


@query("agg4_unsupported_tag_totals", f"SELECT name, count(*) AS n FROM {_UNKNOWN} GROUP BY name")
def _(spark, sf_dir):
    counted = table(spark, sf_dir, "pages").select(
        counter(tg.unsupported_tag_names(F.col("html"))).alias("unsupported_tags")
    )
    return sum_counters(counted, "unsupported_tags")
