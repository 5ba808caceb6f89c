"""Markdown blocks and the Markdown clean-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import markdown as md
from ..functions.text import nfkc, slug
from .registry import query, sql_chain, sql_strip, table

# Document texts with the noise that the clean-up rules look for.
_HEAD = "<!-- one --><!-- two\nlines -->head \\[x\\] \\|}  \n \t \n\n1.   first\n-    second\n   -    third\n- \n-   \n"
_TAIL = '\nFormat price error: cannot parse value "12 a" and <sup>\\[update\\]</sup><sup>[update]</sup> \\$ \\#  \n\n\n'


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def noisy(spark, sf_dir):
    text = F.concat(F.lit(_HEAD), "text", F.lit(_TAIL))
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))


_NOISY = f"(SELECT doc_id, concat({_sql_text(_HEAD)}, text, {_sql_text(_TAIL)}) AS text FROM documents)"

# --- fixed values: what the clean-up removes or rewrites, in its order ---
COMMENTS = (r"<!--.*?-->", "")
RESIDUE = (r"\\\|\}", "")
BLANKS = (r"\n\s*\n", "\n\n")
ENDS = (r" *\n", "\n")
MARKERS = (r"(?m)^([0-9]+\.|-)(  +)", r"\1 ")
BULLETS = (r"(?m)^-( *)$\n", "")
BRACKETS = (r"\\(\[|\])", r"\1")
PRICES = (r'Format price error: cannot parse value "(.*?)"', r"\1")
UPDATES = (r"<sup>\[update\]</sup>", "")


def _cleanup(name: str, fn, *steps):
    sql = f"SELECT doc_id, {sql_chain('text', *steps)} AS text FROM {_NOISY}"

    @query(name, sql)
    def _(spark, sf_dir):
        return noisy(spark, sf_dir).select("doc_id", fn(F.col("text")).alias("text"))


_cleanup("f37_drop_markdown_comments", md.drop_markdown_comments, COMMENTS)
_cleanup("f38_drop_table_residue", md.drop_table_residue, RESIDUE)
_cleanup("f39_collapse_blank_lines", md.collapse_blank_lines, BLANKS)
_cleanup("f40_strip_line_ends", md.strip_line_ends, ENDS)
_cleanup("f41_single_space_markers", md.single_space_markers, MARKERS)
_cleanup("f42_drop_empty_bullets", md.drop_empty_bullets, BULLETS)
_cleanup("f43_unescape_brackets", md.unescape_brackets, BRACKETS)
_cleanup("f44_fix_price_errors", md.fix_price_errors, PRICES)
_cleanup("f45_drop_update_notes", md.drop_update_notes, UPDATES)


@query("f46_final_trim", f"SELECT doc_id, {sql_strip('text')} AS text FROM {_NOISY}")
def _(spark, sf_dir):
    return noisy(spark, sf_dir).select("doc_id", md.py_strip(F.col("text")).alias("text"))


_ALL = (COMMENTS, RESIDUE, BLANKS, ENDS, MARKERS, BULLETS, BRACKETS, PRICES, UPDATES)


@query("f47_clean_markdown", f"SELECT doc_id, {sql_strip(sql_chain('text', *_ALL))} AS text FROM {_NOISY}")
def _(spark, sf_dir):
    return noisy(spark, sf_dir).select("doc_id", md.clean_markdown(F.col("text")).alias("text"))


@query("f1_nfkc", "SELECT doc_id, concat(text, ' fix 2 Å') AS text FROM documents")
def _(spark, sf_dir):
    text = F.concat("text", F.lit(" ﬁx\u00a0² A\u030a"))
    docs = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    return docs.withColumn("text", nfkc(F.col("text")))


@query(
    "f34_slug",
    "SELECT p_partkey, replace(lower(p_name), ' ', '_') AS runs, "
    "concat(replace(lower(p_name), ' ', '__'), '_x') AS single FROM part",
)
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    wide = F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("  ")), F.lit(" X "))
    return part.select(
        "p_partkey",
        slug(F.concat(F.lit("\t"), F.replace("p_name", F.lit(" "), F.lit(" \n ")))).alias("runs"),
        slug(wide, runs=False).alias("single"),
    )


# --- one block rule each, over whole part or document texts ---


def _block(name: str, sql: str, *cells: str):
    """`{col}` in a cell stands for a column of part."""

    @query(name, f"SELECT p_partkey, {sql} AS markdown FROM part")
    def _(spark, sf_dir):
        parts = [F.col(c[1:-1]).cast("string") if c[:1] == "{" and c[-1:] == "}" else F.lit(c) for c in cells]
        text = md.blocks_to_markdown(F.concat(*parts))
        return table(spark, sf_dir, "part").select("p_partkey", text.alias("markdown"))


_BRAND = "replace(p_brand, '#', '\\#')"
NL = "\n"
_block("f35_headings", f"concat('## ', p_name, '{NL}{NL}### ', {_BRAND})", "==", "{p_name}", "==\n=== ", "{p_brand}", " ===")
_block("f35_bullets", f"concat('- ', p_name, '{NL}- ', {_BRAND}, '{NL}  - ', p_type)", "* ", "{p_name}", "\n*", "{p_brand}", "\n** ", "{p_type}")
_block(
    "f35_numbers",
    f"concat('1.  ', p_name, '{NL}2.  b{NL}    1.  ', p_type, '{NL}    2.  d{NL}3.  e{NL}{NL}text{NL}{NL}1.  ', p_size)",
    "# ", "{p_name}", "\n# b\n## ", "{p_type}", "\n## d\n# e\ntext\n# ", "{p_size}",
)
_block("f35_terms", f"concat(p_name, '{NL}{NL}', p_type, '{NL}{NL}', ': ', {_BRAND})", "; ", "{p_name}", "\n: ", "{p_type}", "\n: : ", "{p_brand}")
_block("f35_quotes", f"concat('> ', p_name, '{NL}> {NL}> ', p_type, '{NL}{NL}after')", "<blockquote>", "{p_name}", "\n\n", "{p_type}", "</blockquote>\nafter")
_block("f35_leading_spaces", f"concat('`', p_name, '  *`{NL}` ', p_brand, '`{NL}{NL}', p_type)", " ", "{p_name}", "  *\n  ", "{p_brand}", "\n", "{p_type}")
_block("f35_formulas", f"concat('$', p_name, '_1$ <math>{NL} ', p_type, '</math>')", "<math> ", "{p_name}", "_1</math> <math>\n ", "{p_type}", "</math>")
_block("f35_sub_sup", f"concat('H<sub>', p_size, '</sub><sup>', p_type, '</sup>')", "H<sub>", "{p_size}", "</sub><sup>", "{p_type}", "</sup>")  # noqa: F541
_block("f35_escapes", f"concat(p_size, '\\$ ', {_BRAND}, ' a\\*b \\<')", "{p_size}", "$ ", "{p_brand}", " a*b <")
_block("f35_entities", f"concat(p_name, chr(160), '–', p_type, ' \\< & é €')", "{p_name}", "&nbsp;&ndash;", "{p_type}", " &lt; &amp; &eacute; &#8364;")  # noqa: F541
_block("f35_paragraphs", f"concat(p_name, ' ', p_type, '{NL}{NL}', {_BRAND})", "{p_name}", "\n", "{p_type}", "\n\n", "{p_brand}")
_block("f35_code", f"concat('`', p_name, '*` x{NL}{NL}```py{NL}a = \"', p_type, '\"{NL}{NL}b*c{NL}```{NL}{NL}y')", "<code>", "{p_name}", '*</code> x\n<syntaxhighlight lang="py">\na = "', "{p_type}", '"\n\nb*c\n</syntaxhighlight>\ny')
_block("f35_html_lists", f"concat('- ', p_name, '{NL}- ', p_type)", "<ul><li>", "{p_name}", "</li><li>", "{p_type}", "</li></ul>")
_block(
    "f35_nested_html_lists",
    f"concat('1.  ', p_name, '{NL}    - ', p_type, '{NL}    - b{NL}      1.  ', p_size, '{NL}2.  e{NL}{NL}- after')",
    "<ol>\n<li>", "{p_name}", "<ul><li>", "{p_type}", "</li>\n<li>b<ol><li>", "{p_size}",
    "</li></ol></li></ul></li>\n<li>e</li></ol>\n<ul><li>after</li></ul>",
)
_block("f35_emphasis", f"concat('**', p_name, '** *', p_type, '* ~~x~~')", "'''", "{p_name}", "''' ''", "{p_type}", "'' <del>x</del>")  # noqa: F541
