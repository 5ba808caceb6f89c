"""Wiki links, external links, comments and behaviour switches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import let, nfkc, py_strip, settle_nested, where_contains

L1, L2 = "\ufdd2", "\ufdd3"  # a link that stays in the text
O, C = "\ufdd4", "\ufdd5"  # [[ and ]], so that a single bracket is an ordinary character

_SCHEME = r"(?:https?|s?ftps?|git|gopher|ircs?|mms|nntp|redis|ssh|svn|telnet|worldwind):"
# --- fixed values: schemes whose addresses have no // ---
_BARE_SCHEME = r"(?:bitcoin|geo|magnet|mailto|news|sips?|sms|tel|urn|xmpp):"


def drop_comments(c: Column) -> Column:
    """Comments, also over several lines; one that is not closed is text.

    Cut at the ends of comments, a comment is what follows the first beginning in
    a piece. That takes linear time, however many beginnings there are.
    """

    def cut(ps: Column) -> Column:
        return F.transform(
            ps,
            lambda p, i: F.when(i == F.size(ps) - 1, p)
            .when(p.contains("<!--"), F.substring_index(p, "<!--", 1))
            .otherwise(F.concat(p, F.lit("-->"))),
        )

    def drop(t: Column) -> Column:
        # `<!-->` opens a comment and does not close it: left to the pattern.
        return F.when(
            t.rlike("<!--?>|<!--->"), F.regexp_replace(t, "(?s)<!--.*?-->", "")
        ).otherwise(F.array_join(let(F.split(t, "-->"), cut), ""))

    return where_contains(c, "-->", drop)


def drop_switches(c: Column) -> Column:
    """Behaviour switches such as __NOTOC__; a bare ____ goes too."""
    return where_contains(c, "__", lambda t: F.regexp_replace(t, "__[A-Z]*__", ""))


def _each_link(c: Column, fn: Callable[[Column], Column]) -> Column:
    """Replace every link by `fn(content)`, from the innermost outwards."""

    def links(t: Column) -> Column:
        t = F.replace(F.replace(t, F.lit("[["), F.lit(O)), F.lit("]]"), F.lit(C))
        t = settle_nested(t, O, C, fn)
        for marker, text in ((O, "[["), (C, "]]"), (L1, "[["), (L2, "]]")):
            t = F.replace(t, F.lit(marker), F.lit(text))
        return t

    return where_contains(c, "[[", links)


def _kept(content: Column) -> Column:
    return F.concat(F.lit(L1), content, F.lit(L2))


def _has_prefix(content: Column, *names: str) -> Column:
    return F.lower(F.substring_index(content, ":", 1)).isin(*names) & content.contains(":")


def _title(content: Column) -> Column:
    return F.substring_index(content, "|", 1)


def _text(content: Column) -> Column:
    """Label of a link, empty if there is none."""
    return content.substr(F.length(_title(content)) + 2, F.length(content))


def _is_media(content: Column) -> Column:
    return _has_prefix(content, "file", "image", "media")


def _is_category(content: Column) -> Column:
    return _has_prefix(_title(content), "category")


def _plain(content: Column) -> Column:
    """Label, or the target where the label is missing or empty; no link without a target line."""
    return (
        F.when(_title(content).contains("\n"), _kept(content))
        .when(_text(content) != "", _text(content))
        .otherwise(_title(content))
    )


def _category(content: Column, after_expansion: bool) -> Column:
    def without_prefix(text: Column) -> Column:
        return F.regexp_replace(text, "(?i)^Category:", "")

    text = F.when(_text(content) != "", _text(content)).otherwise(_title(content))
    in_place = _kept(F.concat(_title(content), F.lit("|"), without_prefix(text)))
    if not after_expansion:
        return in_place
    return F.when(content.contains("|"), in_place).otherwise(F.lit(""))


def drop_media(c: Column) -> Column:
    """File, image and media links, together with the links inside their captions."""
    return _each_link(c, lambda x: F.when(_is_media(x), F.lit("")).otherwise(_kept(x)))


def links_to_text(c: Column) -> Column:
    """Links become their label, or their target where the label is missing or empty."""
    return _each_link(c, _plain)


def clean_categories(c: Column, after_expansion: bool = False) -> Column:
    """Category links stay, with the prefix gone from their text.

    After template expansion a category link without text is dropped instead.
    """
    return _each_link(
        c, lambda x: F.when(_is_category(x), _category(x, after_expansion)).otherwise(_kept(x))
    )


def resolve_links(c: Column, after_expansion: bool = False) -> Column:
    """All wiki-link rules in one go: media dropped, categories cleaned, the rest as text."""
    return _each_link(
        c,
        lambda x: F.when(_is_media(x), F.lit(""))
        .when(_is_category(x), _category(x, after_expansion))
        .otherwise(_plain(x)),
    )


def external_to_text(c: Column) -> Column:
    """External links become their title; links without a title disappear."""

    def links(t: Column) -> Column:
        url = rf"(?:(?:{_SCHEME})?//|{_BARE_SCHEME})[^\s\[\]]+"
        t = F.regexp_replace(t, rf"(?i)\[{url}[^\S\n]+([^\[\]\n]+)\]", "$1")
        t = F.regexp_replace(t, rf"(?i)\[{url}[^\S\n]*\]", "")
        bare = rf'(?i)\b(?:{_SCHEME}//|{_BARE_SCHEME})[^\s\[\]<>{{}}|"]*[^\s\[\]<>{{}}|",;.:!?)]'
        return F.regexp_replace(t, bare, "")

    gate = rf"(?i)//|\b{_BARE_SCHEME}"
    return let(c, lambda t: F.when(t.rlike(gate), links(t)).otherwise(t))


def raw_categories(c: Column) -> Column:
    """Category names in document order, sort keys ignored, not yet NFKC."""
    found = F.regexp_extract_all(c, F.lit(r"(?i)\[\[Category:([^\[\]|]*)"), 1)
    return F.transform(found, py_strip)


_GLUE = "\ufddf"


def nfkc_list(names: Column) -> Column:
    """NFKC of every element, sent to Python as one string per row."""
    return F.when(F.size(names) == 0, names).otherwise(
        F.split(nfkc(F.array_join(names, _GLUE)), _GLUE)
    )


def with_categories(pages: DataFrame, text: str = "wikitext", out: str = "categories") -> DataFrame:
    """Adds the NFKC category names of each page, in document order."""
    named = pages.withColumn(out, raw_categories(F.col(text)))
    return named.withColumn(out, nfkc_list(F.col(out)))


def category_edges(pages: DataFrame, text: str = "wikitext", key: str = "pageid") -> DataFrame:
    """Edge table (page, category)."""
    edges = pages.select(key, F.explode(raw_categories(F.col(text))).alias("category"))
    return edges.withColumn("category", nfkc(F.col("category")))
