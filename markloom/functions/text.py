"""Text building blocks: whitespace, normalisation, and scoped rewriting.

Everything returns a Column and runs inside the JVM, except `nfkc`, for which
Spark has no built-in.

Two combinators carry the markup functions:

* `rewrite_matches` applies a Column function to each match of a pattern, which
  a plain `regexp_replace` cannot do;
* `settle_nested` settles nested pairs in one pass with a stack, however deep
  they are.

Markers used on the way are Unicode noncharacters (U+FDD0..U+FDEF). They are
never valid in interchanged text, and `guard` removes strays on entry.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import wraps

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import small_batches

# Every code point Python's str.strip / str.split / re `\s` treats as a space.
PY_WS = r"[\t-\r\x1c-\x20\x85\xa0\p{Z}]"
_WS_CHARS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

MARK = "\ufdd0"
CUT = "\ufdde"  # in front of openers and closers while pairs are matched
# Pieces that are folded on their own before they join the text so far.
FOLDED = 64


def built_once(build: Callable[..., Column]) -> Callable[..., Column]:
    """Keep a long expression for the life of the Spark context.

    Building one takes thousands of calls into the JVM, the same ones each time.
    Arguments must be hashable; Python functions do not belong in there.
    """
    kept: dict[tuple, Column] = {}

    @wraps(build)
    def get(*args) -> Column:
        context = SparkContext._active_spark_context
        key = (context.applicationId if context else None, *args)
        if key not in kept:
            kept[key] = build(*args)
        return kept[key]

    return get


def may_have_markers(c: Column) -> Column:
    """A cheap look for the first bytes of the markers' UTF-8 form."""
    return F.contains(c.cast("binary"), F.lit(b"\xef\xb7"))


def guard(c: Column) -> Column:
    """Drop noncharacters, so that markers can never be confused with input."""
    stripped = lambda t: F.regexp_replace(t, "[\ufdd0-\ufdef]", "")
    return let(c, lambda t: F.when(may_have_markers(t), stripped(t)).otherwise(t))


def each_line(c: Column, fn: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(F.split(c, "\n"), fn), "\n")


def let(c: Column, fn: Callable[[Column], Column]) -> Column:
    """Evaluate `c` once and hand it to `fn`, which may use it several times."""
    return F.get(F.transform(F.array(c), fn), F.lit(0))


def let_state(state: Column, c: Column, fn: Callable[[Column, Column], Column]) -> Column:
    """The next state, `fn(state, c)`, with `c` evaluated once.

    Like `let`, but what `fn` makes is handed on as it is: `let` copies it, and with it all that a state holds.
    """
    return F.aggregate(F.array(c), state, fn)


def settle(df: DataFrame, name: str, c: Column) -> DataFrame:
    """Add a column that is computed once per row, whatever happens above it.

    Spark moves a filter below the projections it depends on and repeats their
    expressions in it. It does not move one below a generator that makes its
    column, so a one-element explode keeps long text work from running twice.
    """
    return df.select("*", F.explode(F.array(c)).alias(name))


def py_strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_WS_CHARS))


def py_split(c: Column) -> Column:
    """Whitespace split without empty strings."""
    return F.filter(F.split(c, f"{PY_WS}+"), lambda x: x != "")


@F.arrow_udf(T.StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    # A few texts at a time: the others are never held as Python strings.
    def forms(part: pa.Array) -> pa.Array:
        return pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in part.to_pylist()], type=pa.string())

    parts = [forms(texts.slice(at, 64)) for at in range(0, len(texts), 64)]
    return pa.concat_arrays(parts) if parts else pa.array([], type=pa.string())


def nfkc(c: Column) -> Column:
    """NFKC form. Only rows with non-ASCII text travel to Python; ASCII is already normal.

    Give it a plain column: an expression with lambdas goes into a column first. Bounds the rows of an Arrow
    batch in the session: texts may be long, and a batch is held whole.
    """
    small_batches(SparkSession.active())
    return F.coalesce(_nfkc(F.when(c.rlike(r"[^\x00-\x7f]"), c)), c)


def slug(c: Column, runs: bool = True) -> Column:
    """File-name form of a title: trimmed, lower-cased, joined by underscores.

    `runs` splits on whitespace runs, otherwise on each single space.
    """
    base = F.lower(py_strip(c))
    return F.array_join(py_split(base) if runs else F.split(base, " "), "_")


TOKEN = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]"


def approx_tokens(c: Column) -> Column:
    """Token estimate: letter runs, digit runs and single symbols."""
    return F.size(F.regexp_extract_all(c, F.lit(f"({TOKEN})"), 1))


def count_of(c: Column, literal: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(literal), F.lit("")))) / len(literal)).cast("long")


def where_contains(c: Column, literal: str, fn: Callable[[Column], Column]) -> Column:
    """Apply `fn` only to texts that contain the literal.

    A byte search is far cheaper than a pass of a regular expression.
    """
    return let(c, lambda t: F.when(t.contains(literal), fn(t)).otherwise(t))


def rewrite_matches(c: Column, pattern: str, fn: Callable[[Column], Column]) -> Column:
    """Replace each match of `pattern` by `fn(match)`. One linear pass."""

    def rewrite(marked: Column) -> Column:
        parts = F.split(marked, MARK)
        return F.array_join(
            F.transform(parts, lambda p, i: F.when(i % 2 == 1, fn(p)).otherwise(p)), ""
        )

    return where_contains(F.regexp_replace(c, pattern, f"{MARK}$0{MARK}"), MARK, rewrite)


def settle_innermost(
    t: Column, opener: str, closer: str, fn: Callable[[Column], Column]
) -> Column:
    """Replace every innermost pair of one-character markers by `fn(content)`.

    Cut at the closers, the content of an innermost pair is what follows the
    last opener of a piece. Plain string functions do that, no pattern needed.
    """

    width = len(opener.encode())

    def settled(piece: Column) -> Column:
        # Sizes in bytes are known without a look at the text.
        def head(content: Column) -> Column:
            size = F.octet_length(piece) - F.octet_length(content) - width
            return piece.cast("binary").substr(F.lit(1), size).cast("string")

        return let(
            F.substring_index(piece, opener, -1), lambda content: F.concat(head(content), fn(content))
        )

    def pieces(ps: Column) -> Column:
        return F.transform(
            ps,
            lambda p, i: F.when(i == F.size(ps) - 1, p)
            .when(p.contains(opener), settled(p))
            .otherwise(F.concat(p, F.lit(closer))),
        )

    return F.array_join(let(F.split(t, closer), pieces), "")


def fold_text(pieces: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """One text from pieces, read in order with a state: `step(state, piece)` gives a struct (out, state)."""

    def one(s: Column, piece: Column) -> Column:
        done = lambda s, r: F.struct(F.array_append(s["done"], r["out"]).alias("done"), r["state"].alias("state"))
        return let_state(s, step(s["state"], piece), done)

    def some(all_: Column) -> Callable[[Column, Column], Column]:
        def fold(s: Column, at: Column) -> Column:
            part = F.slice(all_, at * FOLDED + 1, FOLDED)
            inner = F.aggregate(part, F.struct(strings.alias("done"), s["state"].alias("state")), one)
            join = lambda x: F.concat(s["done"], F.array(F.array_join(x["done"], "")))
            return let(inner, lambda x: F.struct(join(x).alias("done"), x["state"].alias("state")))

        return fold

    def run(all_: Column) -> Column:
        parts = F.sequence(F.lit(0), F.greatest((F.size(all_) - 1) / FOLDED, F.lit(0)).cast("int"))
        zero = F.struct(strings.alias("done"), start.alias("state"))
        return F.aggregate(parts, zero, some(all_), lambda s: F.array_join(s["done"], ""))

    strings = F.array().cast("array<string>")
    return let(pieces, run)


def fold_nested(
    c: Column,
    openers: str,
    closer: str,
    fn: Callable[[Column, Column], Column],
    found: Callable[[Column], Column] | None = None,
) -> Column:
    """Match one-character openers and closers and replace every pair by `fn(content, opener)`.

    One pass over the pieces between markers. The state is a stack of what every open
    pair holds so far, its opener in front; a closer takes the top, and the result goes to
    the pair below or to the finished text. Finished pieces are gathered in short lists, so
    no step copies the text in front of it. What is never closed stays as it is.

    Returns the text, or with `found` the values of `found(content)` in order of closing.
    """
    strings = F.array().cast("array<string>")
    cut = F.split(F.regexp_replace(c, f"[{openers}{closer}]", f"{CUT}$0"), CUT)

    def state(done: Column, opened: Column, seen: Column) -> Column:
        return F.struct(done.alias("done"), opened.alias("opened"), seen.alias("seen"))

    def shorter(stack: Column, by: int) -> Column:
        return F.slice(stack, F.lit(1), F.size(stack) - by)

    def close(s: Column, after: Column) -> Column:
        top = F.element_at(s["opened"], -1)  # cheap, so it may stand in several places
        below = lambda s, m: F.concat(F.element_at(s["opened"], -2), m)

        def put(s: Column, made: Column) -> Column:
            seen = F.array_append(s["seen"], found(made["body"])) if found else s["seen"]
            return F.when(
                F.size(s["opened"]) > 1,
                state(s["done"], F.array_append(shorter(s["opened"], 2), below(s, made["text"])), seen),
            ).otherwise(state(F.array_append(s["done"], made["text"]), strings, seen))

        def settled(body: Column) -> Column:
            text = F.concat(fn(body, F.substring(top, 1, 1)), after).alias("text")
            return F.struct(text, body.alias("body")) if found else F.struct(text)

        return let_state(s, let(top.substr(F.lit(2), F.length(top)), settled), put)  # the content is cut out once

    def step(s: Column, piece: Column) -> Column:
        first = F.substring(piece, 1, 1)
        return (
            F.when(first.isin(*openers), state(s["done"], F.array_append(s["opened"], piece), s["seen"]))
            .when((first == closer) & (F.size(s["opened"]) > 0), close(s, piece.substr(F.lit(2), F.length(piece))))
            .otherwise(state(F.array_append(s["done"], piece), s["opened"], s["seen"]))
        )

    def some(pieces: Column) -> Callable[[Column, Column], Column]:
        def fold(s: Column, at: Column) -> Column:
            part = F.slice(pieces, at * FOLDED + 1, FOLDED)
            inner = F.aggregate(part, state(strings, s["opened"], strings), step)
            return let(
                inner,
                lambda x: state(
                    F.concat(s["done"], F.array(F.array_join(x["done"], ""))),
                    x["opened"],
                    F.concat(s["seen"], x["seen"]),
                ),
            )

        return fold

    def run(pieces: Column) -> Column:
        parts = F.sequence(F.lit(0), ((F.size(pieces) - 1) / FOLDED).cast("int"))
        whole = lambda s: F.concat(F.array_join(s["done"], ""), F.array_join(s["opened"], ""))
        return F.aggregate(
            parts, state(strings, strings, strings), some(pieces), (lambda s: s["seen"]) if found else whole
        )

    return let(cut, run)


def settle_nested(c: Column, opener: str, closer: str, fn: Callable[[Column], Column]) -> Column:
    """Replace all matched pairs, from the innermost outwards, by `fn(content)`.

    Pairs without others inside go first, all at once; most pages have no others.
    """
    rest = lambda t: fold_nested(t, opener, closer, lambda body, _: fn(body))
    return where_contains(
        c, closer, lambda t: where_contains(settle_innermost(t, opener, closer, fn), closer, rest)
    )
