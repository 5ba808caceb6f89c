"""Templates: names, occurrences, parameters, and the keep/drop policy."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dims import BIG_PREFIXES, PARSER_FUNCTIONS, ListedPolicy, TemplatePolicy
from .sections import drop_sections, level2
from .text import (
    PY_WS,
    fold_nested,
    let,
    nfkc,
    py_strip,
    settle_nested,
    where_contains,
)

T1, T2 = "\ufdd2", "\ufdd3"  # a settled template
O, C = "\ufdd4", "\ufdd5"  # {{ and }}, so that a single brace is an ordinary character
P1, P2 = "\ufdd6", "\ufdd7"  # parameter references {{{x}}}
I1, I2 = "\ufdd8", "\ufdd9"  # a settled template inside another one
BAR, EQ = "\ufdda", "\ufddb"  # | and = inside an inner template

def magic_templates(c: Column) -> Column:
    """{{!}} becomes a bar; table-end templates become the end of a table."""
    return where_contains(c, "{{", _magic)


def _magic(c: Column) -> Column:
    tail = rf"{PY_WS}*(?:\|[^{{}}]*)?\}}\}}"
    c = F.regexp_replace(c, rf"\{{\{{{PY_WS}*!{tail}", "|")
    names = rf"(?:[Ee]nd|[Jj]ctbtm|{PY_WS}+(?:end|jctbtm))"
    return F.regexp_replace(c, rf"\{{\{{{names}{tail}", "|}")


def template_name(c: Column) -> Column:
    """Policy name: first raw character lower-cased, underscores as spaces, then trimmed.

    The first character is taken before trimming, so `' Cite'` keeps its capital.
    """
    first = lambda t: F.substring(t, 1, 1)
    lowered = lambda t: F.concat(F.lower(first(t)), t.substr(F.lit(2), F.length(t)))
    # Lower-casing knows all languages and takes its time; most names need none.
    small = let(c, lambda t: F.when(first(t).between("a", "z"), t).otherwise(lowered(t)))
    return py_strip(F.translate(small, "_", " "))


def census_name(c: Column) -> Column:
    """Census name: trimmed and lower-cased throughout."""
    return F.lower(py_strip(c))


def is_parser_function(name: Column) -> Column:
    return (name != "") & F.substring_index(name, ":", 1).isin(*PARSER_FUNCTIONS)


def _hide(c: Column) -> Column:
    def params(t: Column) -> Column:
        value = r"[^{}]*+(?:\{\{[^{}]*+\}\}[^{}]*+)*+"
        return F.regexp_replace(
            t, rf"(?<!\{{)\{{\{{\{{({value})\}}\}}\}}(?!\}})", f"{P1}$1{P2}"
        )

    c = where_contains(c, "{{{", params)
    return F.replace(F.replace(c, F.lit("{{"), F.lit(O)), F.lit("}}"), F.lit(C))


def _replace_all(c: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    for marker, text in pairs:
        c = F.replace(c, F.lit(marker), F.lit(text))
    return c


def _show(c: Column) -> Column:
    c = _replace_all(c, ((O, "{{"), (C, "}}"), (T1, "{{"), (T2, "}}")))
    return where_contains(c, P1, lambda t: _replace_all(t, ((P1, "{{{"), (P2, "}}}"))))


def _show_inner(c: Column) -> Column:
    return _replace_all(_show(c), ((I1, "{{"), (I2, "}}"), (BAR, "|"), (EQ, "=")))


def _each_template(c: Column, fn: Callable[[Column], Column]) -> Column:
    """Replace every matched template by `fn(body)`, from the innermost outwards."""
    return where_contains(c, "{{", lambda t: _show(settle_nested(_hide(t), O, C, fn)))


def _kept(body: Column) -> Column:
    return F.concat(F.lit(T1), body, F.lit(T2))


def _raw_name(body: Column) -> Column:
    return F.substring_index(body, "|", 1)


def mark_templates(c: Column) -> Column:
    """Every matched template, at any depth, between two markers."""
    return settle_nested(_hide(c), O, C, _kept)


def marked_names(marked: Column) -> Column:
    """Raw names of all matched templates in document order, nested ones included."""
    return F.regexp_extract_all(marked, F.lit(f"{T1}([^{T1}{T2}|]*)"), 1)


def raw_names(c: Column) -> Column:
    return marked_names(mark_templates(c))


def census_names(c: Column) -> Column:
    return F.transform(raw_names(c), census_name)


def policy_names(c: Column) -> Column:
    return F.transform(raw_names(c), template_name)


def asked_names(c: Column) -> Column:
    """The different names that a policy can be asked for, in policy form.

    A template in a name either goes, and the name is what is left, or stays, and no listed name has one in it. So
    names as written up to an inner template, and names without inner templates, are all there are.
    """
    without = lambda: let(_hide(c), lambda t: fold_nested(t, O, C, lambda body, _: F.lit(""), found=_raw_name))
    in_name = f"{T1}[^{T1}{T2}|]*{T1}"  # most texts have no template in a name: their names are as written
    none = F.array().cast("array<string>")

    def all_names(marked: Column) -> Column:
        return F.concat(marked_names(marked), F.when(marked.rlike(in_name), without()).otherwise(none))

    return F.array_distinct(F.transform(let(mark_templates(c), all_names), template_name))


def template_occurrences(
    pages: DataFrame,
    text: str = "wikitext",
    key: str = "pageid",
    streamlined: bool = False,
    names: Callable[[Column], Column] = census_names,
) -> DataFrame:
    """Occurrence table (page, name), one row per use; census names, or `policy_names`."""
    source = streamline(F.col(text)) if streamlined else F.col(text)
    return pages.select(key, F.explode(names(source)).alias("name"))


def apply_template_policy(c: Column, policy: TemplatePolicy | ListedPolicy) -> Column:
    """Remove every template the policy does not keep.

    Works from the innermost outwards: a dropped template inside a kept one
    disappears, a kept one inside a dropped one goes with it. The name is made once for all rules.
    """

    def settle(body: Column) -> Column:
        stays = let(template_name(_raw_name(body)), policy.keeps)
        return F.when(stays, _kept(body)).otherwise(F.lit(""))

    return _each_template(c, settle)


def unsupported_names(names: Column, policy: TemplatePolicy | ListedPolicy) -> Column:
    """The dropped ones among raw names, in policy form, the short description aside."""
    return F.filter(
        F.transform(names, template_name),
        lambda n: ~policy.keeps(n) & (n != "short description"),
    )


def invocations(c: Column) -> Column:
    """Bodies of all matched templates, inner ones before what they are in.

    Bars and equal signs of inner templates are masked, so that a body can be
    split at its own bars.
    """

    masked = lambda body, _: F.concat(F.lit(I1), F.translate(body, "|=", BAR + EQ), F.lit(I2))
    return let(_hide(c), lambda t: fold_nested(t, O, C, masked, found=lambda body: body))


def params_of(body: Column) -> Column:
    """Parameters of a body as array<struct<param, value>>, by name.

    Names are trimmed, values raw, empty values left out, and of two equal names
    the later one wins. Unnamed parameters are numbered from 1.
    """

    def entry(param: Column, at: Column, value: Column) -> Column:
        return F.struct(param.alias("param"), (-at).alias("at"), _show_inner(value).alias("value"))

    def entries(parts: Column) -> Column:
        placed = F.transform(parts, lambda p, i: F.struct(i.alias("at"), p.alias("text")))
        plain = F.transform(
            F.filter(placed, lambda e: ~e["text"].contains("=")),
            lambda e, i: entry((i + 1).cast("string"), e["at"], e["text"]),
        )
        named = F.transform(
            F.filter(placed, lambda e: e["text"].contains("=")),
            lambda e: entry(
                py_strip(F.substring_index(e["text"], "=", 1)),
                e["at"],
                e["text"].substr(F.instr(e["text"], "=") + 1, F.length(e["text"])),
            ),
        )
        return F.array_sort(F.filter(F.concat(plain, named), lambda e: e["value"] != ""))

    def last_ones(ordered: Column) -> Column:
        # Sorted by name, later ones first: the first of each name stays.
        first = F.filter(
            ordered, lambda e, i: (i == 0) | (F.get(ordered, i - 1)["param"] != e["param"])
        )
        return F.transform(first, lambda e: e.dropFields("at"))

    parts = let(F.split(body, r"\|"), lambda b: F.slice(b, F.lit(2), F.size(b)))
    return let(let(parts, entries), last_ones)


def template_params(pages: DataFrame, text: str = "wikitext", key: str = "pageid") -> DataFrame:
    """Parameter table (page, template, param, value), also for infobox extraction."""
    bodies = pages.select(key, F.explode(invocations(F.col(text))).alias("body"))
    entries = bodies.select(
        key,
        template_name(F.substring_index("body", "|", 1)).alias("template"),
        F.explode(params_of(F.col("body"))).alias("entry"),
    )
    return entries.select(key, "template", "entry.param", "entry.value")


_SHORT = rf"(?:[Ss]|{PY_WS}+s)hort[ _]description{PY_WS}*"


def marked_short_description(marked: Column) -> Column:
    """Parameter 1 of the short description, trimmed; empty string if there is none.

    Of several, the first one in the last level-2 section that has any counts.
    """
    carries = f"{T1}{_SHORT}[|{T2}]"
    carriers = F.filter(level2(marked), lambda s: s.rlike(carries))

    def value(section: Column) -> Column:
        body = F.regexp_extract(section, f"{T1}({_SHORT}(?:\\|[^{T1}{T2}]*)?){T2}", 1)
        entry = F.filter(params_of(body), lambda e: e["param"] == "1")
        return py_strip(F.coalesce(F.get(entry, F.lit(0))["value"], F.lit("")))

    return let(
        carriers,
        lambda s: F.when(F.size(s) > 0, value(F.element_at(s, -1))).otherwise(F.lit("")),
    )


def with_short_description(
    pages: DataFrame, text: str = "wikitext", out: str = "description"
) -> DataFrame:
    """Adds the NFKC short description; null for none."""
    raw = pages.withColumn(out, marked_short_description(mark_templates(F.col(text))))
    normal = raw.withColumn(out, nfkc(F.col(out)))
    return normal.withColumn(out, finish_description(F.col(out)))


def finish_description(normalised: Column) -> Column:
    """Null for the words that stand for no description."""
    return F.when(~normalised.isin("", "none"), py_strip(normalised))


def drop_big_templates(c: Column, prefixes: tuple[str, ...] = BIG_PREFIXES) -> Column:
    big = "|".join(_escape(p) for p in prefixes)

    def settle(body: Column) -> Column:
        is_big = census_name(_raw_name(body)).rlike(rf"\A(?:{big})")
        return F.when(is_big, F.lit("")).otherwise(_kept(body))

    return _each_template(c, settle)


def streamline(c: Column, extra_prefixes: tuple[str, ...] = ()) -> Column:
    """Text as a census sees it: without the sections, tables, references and
    page-sized templates that never reach the output."""
    from .tags import delete_tags, drop_wiki_tables, hide_opaque, show_opaque

    c = drop_sections(hide_opaque(c, comments=False), nested=False)
    c = drop_wiki_tables(delete_tags(c, ("table", "ref")))
    return show_opaque(drop_big_templates(c, BIG_PREFIXES + extra_prefixes))


def invocation_segments(c: Column) -> Column:
    """Text cut at its outermost templates: literal, template, literal, template, ...

    Even positions are literal text, odd ones whole templates as written.
    """

    def settle(body: Column) -> Column:
        return _kept(F.replace(F.replace(body, F.lit(T1), F.lit(I1)), F.lit(T2), F.lit(I2)))

    def cut(t: Column) -> Column:
        marked = settle_nested(_hide(t), O, C, settle)
        # Only outermost templates are marked now, so both markers alternate.
        marked = F.replace(F.replace(marked, F.lit(T1), F.lit(BAR + T1)), F.lit(T2), F.lit(T2 + BAR))
        return F.transform(F.split(marked, BAR), _show_inner)

    return let(c, lambda t: F.when(t.contains("{{"), cut(t)).otherwise(F.array(t)))


def _escape(literal: str) -> str:
    return literal.replace("-", r"\-")
