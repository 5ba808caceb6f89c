"""Wiki markup to GitHub-flavoured Markdown, and the clean-up of the Markdown."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from functools import partial
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .tags import has_any, hide_opaque, mentioned, rewrite_paired
from .text import (
    CUT,
    PY_WS,
    each_line,
    fold_text,
    let,
    may_have_markers,
    nfkc,
    py_strip,
    rewrite_matches,
    settle_nested,
    where_contains,
)

# Classes of a line while blocks are put together.
PARA, LIST, CODE, BLOCK = "\ufdd1", "\ufdd2", "\ufdd3", "\ufdd4"
NUM = "\ufdd5"  # number of an ordered-list item
Q1, Q2 = "\ufdd6", "\ufdd7"  # a block quote
BREAK = "\ufdd9"  # a line break inside a paragraph

# Characters that stand for themselves: inside formulas and code, and as Markdown syntax.
_SHOWN = "<>\n*#_~|\\`$&'[] "
_COVER = "".join(chr(0xFDE0 + i) for i in range(len(_SHOWN)))
LT, GT, STAR, TICK, DOLLAR, TILDE = (_COVER[_SHOWN.index(ch)] for ch in "<>*`$~")

OPAQUE = ("math", "nowiki", "pre", "syntaxhighlight", "source", "code")
PAIRED = "sub|sup|blockquote|math|syntaxhighlight|code|pre|ul|ol|nowiki|u|del"


# --- clean-up ---------------------------------------------------------------------------------


def drop_markdown_comments(c: Column) -> Column:
    """Comments on one line."""
    return where_contains(c, "-->", lambda t: F.regexp_replace(t, "(?d)<!--.*?-->", ""))


def drop_table_residue(c: Column) -> Column:
    return F.replace(c, F.lit("\\|}"), F.lit(""))


def collapse_blank_lines(c: Column) -> Column:
    return F.regexp_replace(c, rf"\n{PY_WS}*\n", "\n\n")


def strip_line_ends(c: Column) -> Column:
    return where_contains(c, " \n", lambda t: F.regexp_replace(t, r"(?<! ) ++\n", "\n"))


def single_space_markers(c: Column) -> Column:
    """One space behind a list marker at the start of a line."""
    return where_contains(
        c, "  ", lambda t: F.regexp_replace(t, r"(?md)^([0-9]+\.|-)  +", "$1 ")
    )


def drop_empty_bullets(c: Column) -> Column:
    return where_contains(c, "-", lambda t: F.regexp_replace(t, r"(?md)^- *$\n", ""))


def unescape_brackets(c: Column) -> Column:
    for bracket in "[]":
        c = F.replace(c, F.lit("\\" + bracket), F.lit(bracket))
    return c


def fix_price_errors(c: Column) -> Column:
    pattern = r'(?d)Format price error: cannot parse value "(.*?)"'
    return where_contains(c, "Format price error", lambda t: F.regexp_replace(t, pattern, "$1"))


def drop_update_notes(c: Column) -> Column:
    return F.replace(c, F.lit("<sup>[update]</sup>"), F.lit(""))


# The order matters: brackets are unescaped before update notes are looked for,
# and comments go before blank lines are collapsed.
CLEANUPS = (
    drop_markdown_comments,
    drop_table_residue,
    collapse_blank_lines,
    strip_line_ends,
    single_space_markers,
    drop_empty_bullets,
    unescape_brackets,
    fix_price_errors,
    drop_update_notes,
    py_strip,
)


def clean_markdown(c: Column) -> Column:
    c = nfkc(c)
    for cleanup in CLEANUPS:
        c = cleanup(c)
    return c


# --- corrupt pages ----------------------------------------------------------------------------


def is_corrupt(c: Column) -> Column:
    """True where paired tags do not balance, or a link or template bracket has no partner."""

    def names(t: Column, pattern: str) -> Column:
        found = F.regexp_extract_all(t, F.lit(rf"(?i){pattern}"), 1)
        return F.array_sort(F.transform(found, F.lower))

    def tags_differ(t: Column) -> Column:
        opened = names(t, rf"<({PAIRED})(?:\s[^<>]*)?(?<!/)>")
        return opened != names(t, rf"</({PAIRED})\s*>")

    def unmatched(t: Column, opener: str, closer: str) -> Column:
        marked = F.replace(F.replace(t, F.lit(opener), F.lit(Q1)), F.lit(closer), F.lit(Q2))
        left = settle_nested(marked, Q1, Q2, lambda _: F.lit(""))
        some = t.contains(opener) | t.contains(closer)
        return some & let(left, lambda x: x.contains(Q1) | x.contains(Q2))

    def brackets_differ(t: Column) -> Column:
        return unmatched(t, "[[", "]]") | unmatched(t, "{{", "}}")

    return let(
        c,
        lambda t: (t.contains("<") & tags_differ(t)) | let(hide_opaque(t), brackets_differ),
    )


# --- blocks -----------------------------------------------------------------------------------


def decode_entities(c: Column) -> Column:
    """Named and numeric character references become characters."""
    named = {k[:-1]: v for k, v in html5.items() if k.endswith(";")}
    # Frequent names come first: a map literal is searched in order.
    first = ("nbsp", "ndash", "mdash", "amp", "minus", "times", "thinsp", "lt", "gt", "quot", "deg")
    order = [*first, *sorted(set(named) - set(first))]
    table = F.from_json(F.lit(json.dumps({k: named[k] for k in order})), "map<string,string>")

    def decoded(e: Column) -> Column:
        name = e.substr(F.lit(2), F.length(e) - 2)
        digits = F.regexp_extract(e, "[0-9A-Fa-f]+(?=;)", 0)
        code = F.when(e.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits)
        point = code.cast("long")
        valid = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
        return F.when(e.startswith("&#"), F.when(valid, char).otherwise(e)).otherwise(
            F.coalesce(F.try_element_at(table, name), e)
        )

    entity = r"&(?:#0*+[0-9]{1,7}|#[xX]0*+[0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
    return where_contains(c, "&", lambda t: rewrite_matches(t, entity, decoded))


def _opaque_to_markdown(c: Column) -> Column:
    """Formulas, code and unparsed text, which the line rules must not touch."""

    def content(m: Column) -> Column:
        return F.regexp_replace(m, r"(?s)\A<[^<>]*>|</[A-Za-z]+\s*>\z", "")

    def settle(m: Column) -> Column:
        body = content(m)
        tag = F.lower(F.regexp_extract(m, r"\A<([A-Za-z]+)", 1))
        lang = F.regexp_extract(m, r"""\A<[^<>]*\slang\s*=\s*["']?([^\s"'<>]+)""", 1)
        block = F.concat(
            F.lit(f"\n\n{BLOCK}```"), lang, F.lit("\n"),
            F.regexp_replace(body, r"\A\n|\n\z", ""), F.lit(f"\n```{BLOCK}\n\n"),
        )
        return (
            F.when(
                tag == "math",
                F.when(body.rlike(r"\A[ \t]*\n"), m).otherwise(
                    F.concat(F.lit(DOLLAR), py_strip(body), F.lit(DOLLAR))
                ),
            )
            .when(tag == "nowiki", _escape(body))
            .when(tag == "code", F.concat(F.lit(TICK), body, F.lit(TICK)))
            .otherwise(block)
        )

    # Blocks keep their newlines out of sight until all lines are settled.
    def hidden(m: Column) -> Column:
        out = settle(m)
        return F.when(
            out.startswith("\n\n" + BLOCK),
            F.concat(F.lit("\n\n"), F.translate(_trim_ends(out), _SHOWN, _COVER), F.lit("\n\n")),
        ).otherwise(F.translate(out, _SHOWN, _COVER))

    closed = rf"(?i)</(?:{'|'.join(OPAQUE)})\s*>"
    return let(c, lambda t: F.when(t.rlike(closed), rewrite_paired(t, OPAQUE, hidden)).otherwise(t))


def _trim_ends(c: Column) -> Column:
    return c.substr(F.lit(3), F.length(c) - 4)


# List tags while lists are read: the start of an ordered one, a bullet one, an item, and the ends.
_LIST_TAGS = (
    ("o", r"<ol(?:\s[^<>]*)?>[ \t]*"),
    ("u", r"<ul(?:\s[^<>]*)?>[ \t]*"),
    ("i", r"<li(?:\s[^<>]*)?>\s*"),
    ("e", r"</[uo]l\s*>[ \t]*"),
)


def _lists_from_tags(c: Column) -> Column:
    """HTML lists as wiki lists, nested as their tags are.

    The state is the marker of the list that a piece of text is in, one character a level. An item
    outside of any list is a bullet, as are all items if not all lists are closed (the page is corrupt then).
    """
    count = lambda t, tag: F.regexp_count(t, F.lit(rf"(?i){tag}"))
    opened, closed = r"<[uo]l(?:\s[^<>]*)?>", r"</[uo]l\s*>"
    return let(c, lambda t: F.when(count(t, opened) == count(t, closed), _nested_lists(t)).otherwise(_flat_lists(t)))


def _flat_lists(c: Column) -> Column:
    c = F.regexp_replace(c, r"(?i)(?<!\s)\s*+<li(?:\s[^<>]*)?>\s*", "\n* ")
    c = F.regexp_replace(c, r"(?i)</li\s*>", "")
    return F.regexp_replace(c, r"(?i)(?<!\s)\s*+</?[uo]l(?:\s[^<>]*)?>[ \t]*", "\n")


def _nested_lists(c: Column) -> Column:
    for kind, tag in _LIST_TAGS:
        c = F.regexp_replace(c, rf"(?i)(?<!\s)\s*+{tag}", f"{CUT}{kind}")
    c = F.regexp_replace(c, r"(?i)</li\s*>", f"{CUT}x")

    def step(marker: Column, piece: Column) -> Column:
        kind, text = F.substring(piece, 1, 1), piece.substr(F.lit(2), F.length(piece))
        below = F.when(marker == "", "").otherwise(marker.substr(F.lit(1), F.length(marker) - 1))

        def result(out: Column, state: Column) -> Column:
            return F.struct(out.alias("out"), state.alias("state"))

        def deeper(char: str) -> Column:
            return result(line(marker == ""), F.concat(marker, F.lit(char)))

        def line(outside: Column) -> Column:
            # No empty lines inside a list: they would end it.
            return F.when(outside | (py_strip(text) != ""), F.concat(F.lit("\n"), text)).otherwise("")

        item = F.when(marker == "", "*").otherwise(marker)
        return (
            F.when(kind == "o", deeper("#"))
            .when(kind == "u", deeper("*"))
            .when(kind == "i", result(F.concat(F.lit("\n"), item, F.lit(" "), text), marker))
            .when(kind == "e", result(line(F.length(marker) < 2), below))
            .otherwise(result(F.when((marker != "") & (py_strip(text) == ""), "").otherwise(text), marker))
        )

    def read(pieces: Column) -> Column:
        rest = F.slice(pieces, F.lit(2), F.size(pieces))
        return F.concat(F.get(pieces, F.lit(0)), fold_text(rest, F.lit(""), step))

    return let(F.split(c, CUT), read)


def _number_items(c: Column) -> Column:
    """Write the running number behind the marker of every ordered-list item.

    One pass over the lines. The state has a counter for each level of the last line's marker, -1 where
    that level is not an ordered list: lines in between that belong to deeper levels don't end a count.
    """

    def step(counts: Column, line: Column) -> Column:
        def numbered(marker: Column, now: Column) -> Column:
            number = F.concat(marker, F.lit(NUM), F.element_at(now, -1).cast("string"), F.lit(NUM))
            text = line.substr(F.length(marker) + 1, F.length(line))
            out = F.when(marker.endswith("#"), F.concat(number, text)).otherwise(line)
            return F.struct(out.alias("out"), now.alias("state"))

        def count(marker: Column) -> Column:
            so_far = lambda i: F.greatest(F.coalesce(F.get(counts, i), F.lit(0)), F.lit(0))
            own = lambda i: F.when(i == F.length(marker) - 1, 1).otherwise(0)
            return F.transform(
                F.filter(F.split(marker, ""), lambda m: m != ""),
                lambda m, i: F.when(m == "#", so_far(i) + own(i)).otherwise(-1),
            )

        marker = F.regexp_extract(line, r"\A[*#:;]+", 0)
        return let(marker, lambda m: let(count(m), lambda now: numbered(m, now)))

    def numbered(t: Column) -> Column:
        # Lines keep their ends, so that the pieces make up the text.
        lines = F.split(F.replace(t, F.lit("\n"), F.lit(f"\n{CUT}")), CUT)
        return fold_text(lines, F.array().cast("array<int>"), step)

    return let(c, lambda t: F.when(t.rlike(r"(?dm)^[*:;]*#"), numbered(t)).otherwise(t))


def _escape(c: Column) -> Column:
    """Backslashes before characters that Markdown would read as syntax."""
    c = F.regexp_replace(c, r"[\\`*~|<>#$\[\]]", r"\\$0")
    outer = r"(?<![\p{L}\p{N}])_|_(?![\p{L}\p{N}])"
    return where_contains(c, "_", lambda t: F.regexp_replace(t, outer, r"\\_"))


def _cover(text: Column) -> Column:
    return F.translate(text, _SHOWN, _COVER)


def _wrap(kind: str, *text: Column) -> Column:
    return F.concat(F.lit(kind), *text, F.lit(kind))


def _bullet_line(line: Column) -> Column:
    shape = f"(?s)\\A([*#:;]+)(?:{NUM}([0-9]+){NUM})?(.*)\\z"
    item = F.regexp_extract(F.regexp_extract(line, shape, 1), r"[*#]+\z", 0)
    number = F.regexp_extract(line, shape, 2)
    content = py_strip(F.regexp_extract(line, shape, 3))
    outer = item.substr(F.lit(1), F.length(item) - 1)
    indent = F.replace(F.replace(outer, F.lit("*"), F.lit("  ")), F.lit("#"), F.lit("    "))
    # Markers are four wide; longer numbers take the room they need.
    pad = F.repeat(F.lit(" "), F.greatest(F.lit(3) - F.length(number), F.lit(1)))
    ordered = F.concat(number, F.lit("."), pad)
    bullet = F.when(item.endswith("#"), ordered).otherwise(F.lit("- "))
    return F.when(
        item != "", _wrap(LIST, _cover(F.concat(indent, bullet)), content)
    ).otherwise(_wrap(BLOCK, content))


def _heading_line(line: Column) -> Column:
    shape = r"\A(={1,6})(=*+[^=\n][^\n]*)\1[ \t]*\z"
    hashes = F.repeat(F.lit("#"), F.length(F.regexp_extract(line, shape, 1)))
    title = py_strip(F.regexp_extract(line, shape, 2))
    return F.when(line.rlike(shape), _wrap(BLOCK, _cover(hashes), F.lit(" "), title)).otherwise(
        _wrap(PARA, line)
    )


def _code_line(line: Column) -> Column:
    return _wrap(CODE, F.lit(TICK), _cover(decode_entities(line.substr(F.lit(2), F.length(line)))), F.lit(TICK))


def _line(line: Column) -> Column:
    """One line with its kind on both sides. The first character decides."""
    first = F.substring(line, 1, 1)
    return (
        F.when(py_strip(line) == "", F.lit(BLOCK * 2))
        .when(first.isin("*", "#", ":", ";"), _bullet_line(line))
        .when(first == "=", _heading_line(line))
        .when(first == " ", _code_line(line))
        .when(first.isin(Q1, Q2), _wrap(BLOCK, line))
        .when(first == BLOCK, line)
        .otherwise(_wrap(PARA, line))
    )


def blocks_to_markdown(c: Column) -> Column:
    """Markdown of converted wiki text. Line rules only; no state crosses pages."""
    kinds = PARA + LIST + CODE + BLOCK

    c = where_contains(c, "<", _tags_to_markdown)
    c = where_contains(c, "''", _emphasis)  # becomes Markdown syntax before anything is escaped
    c = _number_items(c)

    # Line kinds are settled before entities are decoded: a decoded star is no list marker.
    c = each_line(c, _line)
    # Runs of spaces collapse before entities are decoded: a written &#32; stays a space.
    c = where_contains(c, "  ", lambda t: F.regexp_replace(t, "[ \t]{2,}", " "))
    c = _escape(decode_entities(c))

    c = F.replace(c, F.lit(f"{PARA}\n{PARA}"), F.lit(" "))
    for kind in (LIST, CODE):
        c = F.replace(c, F.lit(f"{kind}\n{kind}"), F.lit("\n"))
    c = F.regexp_replace(c, f"[{kinds}]\n[{kinds}]", "\n\n")
    c = F.regexp_replace(c, f"[{kinds}]", "")
    c = F.btrim(F.regexp_replace(c, "\n{3,}", "\n\n"), F.lit("\n"))
    c = where_contains(c, Q1, _quote_blocks)
    c = F.replace(c, F.lit(BREAK), F.lit("\n"))
    shown = lambda t: F.translate(t, _COVER, _SHOWN)
    return each_line(c, lambda t: F.when(may_have_markers(t), shown(t)).otherwise(t))


def _tags_to_markdown(c: Column) -> Column:
    """Tags that stand for Markdown; what is left of tags is kept as it is."""

    def quotes(t: Column) -> Column:
        t = F.regexp_replace(t, r"(?i)(?<!\s)\s*+<blockquote(?:\s[^<>]*)?>[ \t]*\n?", f"\n{Q1}\n")
        return F.regexp_replace(t, r"(?i)(?<!\s)\s*+</blockquote\s*>[ \t]*\n?", f"\n{Q2}\n")

    def breaks(t: Column) -> Column:
        pattern = r"(?i)(?<![ \t])[ \t]*+<br(?:\s[^<>]*)?/?>[ \t]*(?:\n(?!\n))?"
        return F.regexp_replace(t, pattern, BREAK)

    def strikes(t: Column) -> Column:
        return F.regexp_replace(t, r"(?i)</?del(?:\s[^<>]*)?>", TILDE * 2)

    # A rule runs only on pages that mention its tags.
    rules = (
        (OPAQUE, _opaque_to_markdown),
        (("del",), strikes),
        (("ul", "ol", "li"), _lists_from_tags),
        (("blockquote",), quotes),
        (("br",), breaks),
    )

    def all_rules(t: Column, present: Column) -> Column:
        for names, rule in rules:
            t = let(t, partial(_only_with, present, names, rule))
        return F.regexp_replace(t, r"(?i)<(/?[a-z][a-z0-9]*(?:\s[^<>]*)?/?)>", f"{LT}$1{GT}")

    return let(mentioned(c), lambda names: all_rules(c, names))


def _only_with(present: Column, names: Iterable[str], rule: Callable, t: Column) -> Column:
    return F.when(has_any(present, names), rule(t)).otherwise(t)


def _emphasis(c: Column) -> Column:
    for marks, stars in (("'''''", STAR * 3), ("'''", STAR * 2), ("''", STAR)):
        c = F.regexp_replace(c, rf"{marks}([^\n]+?){marks}", f"{stars}$1{stars}")
    return c


def _quote_blocks(c: Column) -> Column:
    def quote(content: Column) -> Column:
        return F.regexp_replace(F.btrim(content, F.lit("\n")), "(?dm)^", "> ")

    c = settle_nested(c, Q1, Q2, quote)
    return F.replace(F.replace(c, F.lit(Q1), F.lit("")), F.lit(Q2), F.lit(""))
