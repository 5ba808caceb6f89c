"""Column helpers shared by the operators: matches with positions, span digests, staged tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let
from ..session import small_batches, through_table, work_dir

#: White space as the contracts define it: blank and the five control characters from tab to return.
SPACE = r"[ \t-\r]"
MATCHES = "array<struct<s:int,e:int,v:string>>"

__all__ = ["MATCHES", "SPACE", "match_list", "read", "scan", "small_batches", "span_text", "through_table", "whole_text", "work_dir"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


#: Items that ``scan`` reads at a time.
CHUNK = 64


def scan(items: Column, state: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """What ``step`` makes of each item and the state so far, as an array without nulls; ``step`` gives state and result.

    A fold copies its state at each step, so results must not pile up in one: a first fold finds the state before each
    chunk of items, and then every chunk is read on its own from there.
    """
    none, no_state = F.array().cast(f"array<{kind}>"), F.slice(F.array(state), 1, 0)

    def states(parts: Column) -> Column:
        through = lambda part, first: F.aggregate(part, first, lambda s, x: step(s, x)[0])
        start = F.struct(state.alias("state"), no_state.alias("before"))
        add = lambda acc, part: F.struct(
            through(part, acc["state"]).alias("state"), F.concat(acc["before"], F.array(acc["state"])).alias("before")
        )
        return F.aggregate(parts, start, add, lambda acc: acc["before"])

    def results(part: Column, first: Column) -> Column:
        def go(acc: Column, x: Column) -> Column:
            then, made = step(acc["state"], x)
            return F.struct(then.alias("state"), F.concat(acc["made"], F.array(made)).alias("made"))

        return F.aggregate(part, F.struct(first.alias("state"), none.alias("made")), go, lambda acc: acc["made"])

    def run(all_: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.floor((F.size(all_) - 1) / CHUNK), F.lit(0)).cast("int"))
        cut = F.transform(starts, lambda i: F.slice(all_, i * CHUNK + 1, CHUNK))
        return let(cut, lambda parts: F.flatten(F.zip_with(parts, states(parts), results)))

    return F.filter(let(items, run), lambda x: x.isNotNull())


def match_list(text: Column, pattern: str, gate: Column | None = None, around: int = 0) -> Column:
    """All leftmost matches with code-point positions, ends exclusive.

    Matches and the pieces between them come from two linear passes; a scan over both adds up the
    lengths. Texts without a match cost one pass. With ``around``, each match has the hash ``c`` of that many code
    points on either side, as far as the next match.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    columns, kind = [found.alias("v"), between.alias("g")], MATCHES[len("array<") : -1]
    if around:
        columns.append(F.slice(between, 2, F.greatest(F.size(between), F.lit(1))).alias("after"))
        kind = "struct<s:int,e:int,v:string,c:bigint>"

    def step(pos: Column, x: Column) -> tuple[Column, Column]:
        s = pos + F.length(x["g"])
        e = s + F.coalesce(F.length(x["v"]), F.lit(0))
        parts = [s.alias("s"), e.alias("e"), x["v"].alias("v")]
        if around:
            parts.append(F.xxhash64(F.substring(x["g"], -around, around), F.substring(x["after"], 1, around)).alias("c"))
        return e, F.when(x["v"].isNotNull(), F.struct(*parts))

    scanned = scan(F.arrays_zip(*columns), F.lit(0), step, kind)
    none = F.array().cast(f"array<{kind}>")
    return F.when(F.regexp_like(text, F.lit(pattern)) if gate is None else gate, scanned).otherwise(none)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of an array of (kind, s, e), comma-joined in the order of the array."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def tagged(
    matches: Column, kind: str, rank: int, keep: Callable[[Column], Column] | None = None, extra: tuple[str, ...] = ()
) -> Column:
    """Matches as spans (rank, kind, s, e, v and ``extra``), without those that ``keep`` refuses."""
    kept = F.filter(matches, keep) if keep else matches
    return F.transform(
        kept,
        lambda m: F.struct(
            F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), *[m[c].alias(c) for c in ("s", "e", "v", *extra)]
        ),
    )
