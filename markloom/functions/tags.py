"""HTML tags and their wiki-markup counterparts."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dims import TAGS_OPAQUE, TagPolicy, is_one_of
from .links import drop_comments
from .text import CUT, each_line, fold_nested, fold_text, let, py_strip, rewrite_matches, settle_nested, where_contains

D1, D2 = "\ufdd2", "\ufdd3"  # around a tag pair that is about to go
S1, S2 = "\ufdd4", "\ufdd5"  # around any other span

# Characters with a meaning in markup, hidden inside opaque tags.
_PLAIN = "<>[]{}'\n|="
_HIDDEN = "".join(chr(0xFDE0 + i) for i in range(len(_PLAIN)))

VOID = ("br", "hr", "wbr", "img", "meta", "link", "li", "dt", "dd", "th", "td", "tr")
_ATTRS = r"(?:\s[^<>]*)?"
NAME = r"[A-Za-z][A-Za-z0-9]*"


def hide_opaque(c: Column, comments: bool = True) -> Column:
    """Hide the content of tags that the wiki parser does not look into; drop comments.

    """
    closed = rf"(?i)</(?:{_any(TAGS_OPAQUE)})\s*>"
    hidden = lambda match: F.translate(match, _PLAIN, _HIDDEN)
    comment = lambda match: F.lit("") if comments else match

    def hide(t: Column) -> Column:
        return (
            F.when(t.rlike(closed), rewrite_paired(t, TAGS_OPAQUE, hidden, comment))
            .when(t.contains("-->"), drop_comments(t) if comments else t)
            .otherwise(t)
        )

    return where_contains(c, "<", hide)


def rewrite_paired(
    c: Column,
    tags: Iterable[str],
    fn: Callable[[Column], Column],
    comment: Callable[[Column], Column] | None = None,
) -> Column:
    """Replace each stretch from an opening tag to the next closing one of its name by `fn(stretch)`.

    What lies inside is not looked into; what is never closed is text. One pass over the pieces
    between tags, with the open tag as the state; where the last closing tag of each name stands is known
    beforehand. `comment` rewrites comments in the same pass; without it they are ordinary text.
    """
    tags = list(tags)
    marks = ["<!--", "-->"] if comment else []
    token = _any([*marks, rf"<(?:{_any(tags)}){_ATTRS}(?<!/)>", rf"</(?:{_any(tags)})\s*>"])

    def kind(piece: Column, i: Column) -> Column:
        name = F.lower(F.regexp_extract(piece, r"\A<(/?[A-Za-z][A-Za-z0-9]*)", 1))
        return F.when(i == 0, "").when(piece.startswith("<!--"), "!").when(piece.startswith("-->"), "/!").otherwise(name)

    def last(kinds: Column, name: str) -> Column:
        return F.coalesce(F.array_max(F.transform(kinds, lambda k, i: F.when(k == f"/{name}", i))), F.lit(-1))

    def settled(open_: Column, held: Column) -> Column:
        return F.when(open_ == "!", comment(held)).otherwise(fn(held)) if comment else fn(held)

    def step(state: Column, x: Column) -> Column:
        def result(out: Column, open_: Column, held: Column) -> Column:
            return F.struct(out.alias("out"), F.struct(open_.alias("open"), held.alias("held")).alias("state"))

        piece, nothing = x["piece"], F.lit("")
        end = F.when(x["kind"] == "/!", "-->").otherwise(F.regexp_extract(piece, r"\A</[^<>]*>", 0))
        ended = lambda e: F.concat(
            settled(state["open"], F.concat(state["held"], e)), piece.substr(F.length(e) + 1, F.length(piece))
        )
        return (
            F.when((state["open"] == "") & x["opens"], result(nothing, x["kind"], piece))
            .when(state["open"] == "", result(piece, nothing, nothing))
            .when(x["kind"] == F.concat(F.lit("/"), state["open"]), result(let(end, ended), nothing, nothing))
            .otherwise(result(nothing, state["open"], F.concat(state["held"], piece)))
        )

    def run(pieces: Column, kinds: Column) -> Column:
        names = [*tags, "!"] if comment else tags
        ends = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*(last(kinds, n) for n in names)))
        known = lambda m: F.transform(
            pieces,
            lambda p, i: F.struct(
                p.alias("piece"), F.get(kinds, i).alias("kind"),
                F.coalesce(F.try_element_at(m, F.get(kinds, i)) > i, F.lit(False)).alias("opens"),
            ),
        )
        start = F.struct(F.lit("").alias("open"), F.lit("").alias("held"))
        return fold_text(let(ends, known), start, step)

    pieces = F.split(F.regexp_replace(c, rf"(?is){token}", f"{CUT}$0"), CUT)
    return let(pieces, lambda ps: let(F.transform(ps, kind), lambda ks: run(ps, ks)))


def show_opaque(c: Column) -> Column:
    # Any hidden stretch starts with a hidden bracket.
    return where_contains(c, _HIDDEN[0], lambda t: F.translate(t, _HIDDEN, _PLAIN))


def _any(names: Iterable[str]) -> str:
    return "|".join(names)


def _delete_one(t: Column, name: Column) -> Column:
    """Remove all pairs of one tag with their content, nested ones included."""
    t = F.regexp_replace(t, F.concat(F.lit("(?i)<"), name, F.lit(rf"{_ATTRS}/>")), F.lit(""))
    opening = F.concat(F.lit("(?i)<"), name, F.lit(rf"{_ATTRS}>"))
    closing = F.concat(F.lit("(?i)</"), name, F.lit(r"\s*>"))
    t = F.regexp_replace(t, opening, F.lit(f"{D1}$0"))
    t = F.regexp_replace(t, closing, F.lit(f"$0{D2}"))
    t = settle_nested(t, D1, D2, lambda _: F.lit(""))
    return F.replace(F.replace(t, F.lit(D1), F.lit("")), F.lit(D2), F.lit(""))


def _delete_each(c: Column, names: Column) -> Column:
    return F.aggregate(names, c, _delete_one)


def _found(t: Column, pattern: str) -> Column:
    names = F.regexp_extract_all(t, F.lit(pattern), 1)
    return F.array_distinct(F.transform(names, F.lower))


def delete_tags(c: Column, names: Iterable[str]) -> Column:
    """Remove the named tags with their content. Names absent from a page cost nothing."""
    names = list(names)
    return let(c, lambda t: _delete_named(t, tag_names(t), names))


def _delete_named(t: Column, present: Column, names: list[str]) -> Column:
    doomed = F.filter(F.array_distinct(present), lambda n: is_one_of(n, names))
    voids = [n for n in names if n in VOID]

    def drop_voids(x: Column) -> Column:
        return F.regexp_replace(x, rf"(?i)<(?:{_any(voids)}){_ATTRS}>", "")

    t = _delete_each(t, doomed)
    return F.when(has_any(present, voids), drop_voids(t)).otherwise(t) if voids else t


def has_any(present: Column, names: Iterable[str]) -> Column:
    return F.arrays_overlap(present, F.split(F.lit(_any(names)), r"\|"))


def delete_unknown(c: Column, known: Iterable[str]) -> Column:
    """Remove tags no policy names, if they are closed; an unclosed one is just text."""
    known = list(known)
    return let(c, lambda t: _delete_closed(t, tag_names(t), known))


def _delete_closed(t: Column, present: Column, known: list[str]) -> Column:
    def closed(x: Column) -> Column:
        ends = F.concat(_found(x, rf"</({NAME})\s*>"), _found(x, rf"<({NAME}){_ATTRS}/>"))
        return F.filter(F.array_distinct(ends), lambda n: ~is_one_of(n, known))

    unknown = F.exists(present, lambda n: ~is_one_of(n, known))
    return let(t, lambda x: F.when(unknown, _delete_each(x, closed(x))).otherwise(x))


def unwrap_tags(c: Column, names: Iterable[str]) -> Column:
    """Remove the tags and leave their content."""
    return F.regexp_replace(c, rf"(?i)</?(?:{_any(names)}){_ATTRS}/?>", "")


def resolve_spans(c: Column) -> Column:
    """Spans are unwrapped; one with an attribute *named* flagicon goes with its content."""
    flag = r"(?i)<span\s(?:[^<>]*\s)?flagicon(?=[=>/]|\s+[^=\s])[^<>]*>"

    def with_flags(t: Column) -> Column:
        t = F.regexp_replace(t, flag, D1)
        t = F.regexp_replace(t, rf"(?i)<span{_ATTRS}(?<!/)>", S1)
        t = F.regexp_replace(t, r"(?i)</span\s*>", D2)
        t = F.translate(t, S2, "")

        t = fold_nested(t, D1 + S1, D2, lambda body, kind: F.when(kind == D1, "").otherwise(body))
        return F.translate(t, D1 + D2 + S1, "")

    c = where_contains(c, "flagicon", lambda t: F.when(t.rlike(flag), with_flags(t)).otherwise(t))
    return unwrap_tags(c, ("span",))


def rewrite_tags(c: Column, policy: TagPolicy) -> Column:
    """Tags that become other markup, by their opening and closing text."""
    names = policy.having("rewrite")
    if not names:
        return c


    for name in names:
        opening, closing = policy.rewrite[name]
        c = F.regexp_replace(c, rf"(?i)<{name}{_ATTRS}/?>", opening)
        c = F.regexp_replace(c, rf"(?i)</{name}\s*>", closing)
    return c


def plain_quotes(c: Column) -> Column:
    """Bold and italic quote marks, in pairs on one line, leave their content."""

    def quotes(t: Column) -> Column:
        for marks in ("'''''", "'''", "''"):
            t = F.regexp_replace(t, rf"(?<!'){marks}(?!')([^\n]*?)(?<!'){marks}(?!')", "$1")
        for marks in ("'''", "''"):
            t = F.regexp_replace(t, rf"{marks}([^\n]*?){marks}", "$1")
        return t

    return where_contains(c, "''", quotes)


def space_definitions(c: Column) -> Column:
    """List markers for terms and definitions get a space behind them."""
    return rewrite_matches(
        c,
        r"(?dm)^[*#]*[:;][*#:;]*",
        lambda p: F.regexp_replace(p, "([:;])", "$1 "),
    )


def drop_wiki_tables(c: Column) -> Column:
    """Tables in wiki markup, nested ones included."""
    return where_contains(c, "{|", _drop_tables)


def _drop_tables(c: Column) -> Column:
    def mark(line: Column) -> Column:
        return F.when(
            line.contains("{|"), F.regexp_replace(line, r"\A([ \t:]*)\{\|", f"$1{D1}")
        ).when(
            line.contains("|}"), F.regexp_replace(line, r"\A([ \t]*)\|\}(?!\})", f"$1{D2}")
        ).otherwise(line)

    c = settle_nested(each_line(c, mark), D1, D2, lambda _: F.lit(""))
    return F.replace(F.replace(c, F.lit(D1), F.lit("{|")), F.lit(D2), F.lit("|}"))


def apply_tag_policy(c: Column, policy: TagPolicy | None = None) -> Column:
    """All tag rules: keep, unwrap, delete with content, rewrite; unknown tags go.

    The names on a page are collected once and decide which rules run at all.
    """
    policy = policy or TagPolicy()
    actions = policy.actions()

    def all_rules(t: Column, present: Column) -> Column:
        def only_with(names: list[str], rule: Callable[[Column], Column], x: Column) -> Column:
            return let(x, lambda y: F.when(has_any(present, names), rule(y)).otherwise(y))

        t = _delete_named(t, present, policy.having("delete"))
        t = _delete_closed(t, present, list(actions))
        t = only_with(["span"], resolve_spans, t)
        t = only_with(policy.having("unwrap"), lambda x: unwrap_tags(x, policy.having("unwrap")), t)
        return only_with(policy.having("rewrite"), lambda x: rewrite_tags(x, policy), t)

    return where_contains(c, "<", lambda t: let(mentioned(t), lambda names: all_rules(t, names)))


def mentioned(t: Column) -> Column:
    """Distinct lower-cased names of opening and closing tags."""
    return _found(t, rf"</?({NAME})(?=[\s/>])")


def apply_markup_policy(c: Column, policy: TagPolicy | None = None) -> Column:
    """The same policy for wiki markup that stands for tags: tables, rules, lists, quotes."""
    policy = policy or TagPolicy()
    c = drop_wiki_tables(c)
    c = where_contains(c, "----", lambda t: F.regexp_replace(t, "(?dm)^-{4,}", ""))
    c = space_definitions(c)
    return c if policy.styled else plain_quotes(c)


# --- tables of tags -------------------------------------------------------------------------


def tag_names(c: Column) -> Column:
    """Lower-cased names of all opening and self-closing tags, in document order."""
    names = F.regexp_extract_all(c, F.lit(rf"<({NAME})(?=[\s/>])"), 1)
    return F.transform(names, F.lower)


def markup_tag_names(c: Column) -> Column:
    """Tag names that wiki markup stands for: list items, rules, tables, bold and italics."""
    markers = F.split(
        F.array_join(F.regexp_extract_all(c, F.lit(r"(?dm)^([*#:;]+)"), 1), ""), ""
    )
    items = F.transform(
        F.filter(markers, lambda m: m != ""),
        lambda m: F.when(m == ":", "dd").when(m == ";", "dt").otherwise("li"),
    )

    def named(name: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(c, F.lit(pattern), 1), lambda _: F.lit(name))

    others = (
        named("hr", r"(?dm)^(-{4,})"),
        named("table", r"(?dm)^[ \t:]*(\{\|)"),
        named("b", r"(?<!')('''(?:'')?)(?!')[^\n]*?(?<!')\1(?!')"),
        named("i", r"(?<!')(''(?:''')?)(?!')[^\n]*?(?<!')\1(?!')"),
    )
    return F.concat(items, *others)


def tag_occurrences(
    pages: DataFrame, text: str, key: str = "pageid", markup: bool = False
) -> DataFrame:
    """Occurrence table (page, tag), one row per opening tag.

    `markup` adds the wiki-markup counterparts of tags.
    """
    found = F.col(text)
    names = F.concat(tag_names(found), markup_tag_names(found)) if markup else tag_names(found)
    return pages.select(key, F.explode(names).alias("name"))


def unsupported_tag_names(c: Column, policy: TagPolicy | None = None) -> Column:
    known = list((policy or TagPolicy()).actions())
    return F.filter(tag_names(c), lambda n: ~is_one_of(n, known))


def parse_attributes(opening_tag: Column) -> Column:
    """Attributes of an opening tag as array<struct<attribute, value>>.

    The value is null unless there is exactly one equal sign; only `class` is trimmed.
    """
    raw = F.regexp_extract_all(
        opening_tag, F.lit(r"""\s+([^\s=<>/"']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s<>"']+))?)"""), 1
    )

    def entry(a: Column) -> Column:
        parts = F.split(a, "=")
        value = F.when(F.size(parts) == 2, F.get(parts, F.lit(1)))
        prop = F.get(parts, F.lit(0))
        return F.struct(
            prop.alias("attribute"),
            F.when(prop == "class", py_strip(value)).otherwise(value).alias("value"),
        )

    return F.transform(raw, entry)


def tag_attributes(pages: DataFrame, text: str, key: str = "pageid") -> DataFrame:
    """Attribute table (page, tag, attribute, value)."""
    opening = F.regexp_extract_all(F.col(text), F.lit(rf"(<{NAME}\s[^<>]*>)"), 1)
    tags = pages.select(key, F.explode(opening).alias("opening"))
    entries = tags.select(
        key,
        F.lower(F.regexp_extract("opening", f"<({NAME})", 1)).alias("tag"),
        F.explode(parse_attributes(F.col("opening"))).alias("entry"),
    )
    return entries.select(key, "tag", "entry.attribute", "entry.value")
