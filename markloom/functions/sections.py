"""Sections of a page, found by heading lines."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dims import REMOVED_SECTIONS
from .text import PY_WS, let, py_strip

# A heading line: equal signs on both sides of a title; the shorter side gives the level.
# Written so that a failing line is given up in linear time.
HEADING = r"^(={1,6})=*+[^=\n][^\n]*\1[ \t]*$"


def _heading_at_most(level: int) -> str:
    if level >= 6:
        return HEADING
    deeper = f"={{{level + 1}}}"
    return rf"^(?!{deeper}=*+[^=\n][^\n]*{deeper}[ \t]*$)(={{1,{level}}})=*+[^=\n][^\n]*\1[ \t]*$"


def split_at(c: Column, level: int = 6) -> Column:
    """Lead plus one piece per heading of at most this level. Nothing is lost."""
    return F.split(c, rf"(?dm)(?={_heading_at_most(level)})")


def piece_level(piece: Column) -> Column:
    """Heading level of a piece, 0 for the lead."""
    return F.length(F.regexp_extract(piece, rf"(?d)\A(={{1,6}})=*+[^=\n][^\n]*\1[ \t]*(?:\n|\z)", 1))


def piece_heading(piece: Column) -> Column:
    """Heading of a piece, trimmed and lower-cased; null for the lead."""
    title = F.regexp_extract(piece, r"(?d)\A(={1,6})(=*+[^=\n][^\n]*)\1[ \t]*(?:\n|\z)", 2)
    return F.when(title != "", F.lower(py_strip(title)))


def sections(c: Column) -> Column:
    """Flat split as array<struct<level, heading, body>>; the body keeps its heading line."""
    return F.transform(
        split_at(c),
        lambda p: F.struct(
            piece_level(p).alias("level"), piece_heading(p).alias("heading"), p.alias("body")
        ),
    )


def section_table(pages: DataFrame, text: str = "wikitext", key: str = "pageid") -> DataFrame:
    parts = pages.select(key, F.posexplode(sections(F.col(text))).alias("pos", "part"))
    return parts.select(key, "pos", "part.level", "part.heading", "part.body")


def join_flat(c: Column) -> Column:
    """Put a blank line before every heading, as joining the flat sections does."""
    return F.regexp_replace(c, f"(?dm){HEADING}", "\n\n$0")


def level2(c: Column) -> Column:
    """Lead and level-2 sections as an array.

    Text below a level-1 heading, and below a deeper heading that precedes
    every level-2 one, belongs to no section and is lost.
    """
    groups = F.transform(
        split_at(c, 2),
        # The lead ends at its first heading, whatever its level.
        lambda p, i: F.when(piece_level(p) == 2, p)
        .when((i == 0) & (piece_level(p) == 0), F.get(split_at(p), F.lit(0)))
        .when((i == 0) & (piece_level(p) > 2), F.lit("")),
    )
    return let(
        F.filter(groups, lambda p: p.isNotNull()),
        # Text that starts with a heading still has an (empty) lead.
        lambda kept: F.when(
            (F.size(kept) > 0) & (piece_level(F.get(kept, F.lit(0))) != 2), kept
        ).otherwise(F.concat(F.array(F.lit("")), kept)),
    )


def join_sections(parts: Column) -> Column:
    return F.array_join(parts, "\n\n")


def finish(c: Column) -> Column:
    """Trimmed text that ends with one newline."""
    return F.concat(py_strip(c), F.lit("\n"))


def drop_sections(
    c: Column, names: Iterable[str] = REMOVED_SECTIONS, nested: bool = True
) -> Column:
    """Remove sections by heading.

    `nested` takes the subsections along; the flat variant leaves them, unless
    they match themselves.
    """
    names = list(names)

    def named(piece: Column) -> Column:
        return F.coalesce(piece_heading(piece).isin(*names), F.lit(False))

    def without(text: Column, level: int) -> Column:
        # The first piece may begin with a deeper heading; that one's turn comes at its own level.
        gone = lambda p: (piece_level(p) == level) & named(p)
        return F.array_join(F.filter(split_at(text, level), lambda p: ~gone(p)), "")

    if not nested:
        return F.array_join(F.filter(split_at(c), lambda p: ~named(p)), "\n\n")
    # Most pages have no such heading at all: one cheap look decides.
    wanted = "|".join(n.replace(" ", r"\ ") for n in names)
    present = rf"(?im)^={{1,6}}{PY_WS}*(?:{wanted}){PY_WS}*="

    def level_of(t: Column, level: int) -> Callable[[Column], Column]:
        # A heading with one of these names begins with as many equal signs as its level, and no level makes new headings.
        here = rf"(?imu)^={{{level}}}(?!=){PY_WS}*(?:{wanted}){PY_WS}*="
        return lambda x: F.when(t.rlike(here), without(x, level)).otherwise(x)

    def all_levels(t: Column) -> Column:
        out = t
        for level in range(1, 7):
            out = let(out, level_of(t, level))
        return F.when(t.rlike(present), out).otherwise(t)

    return let(c, all_levels)
