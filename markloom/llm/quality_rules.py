"""Quality rules with adaptive thresholds: per language and source, from mergeable quantile sketches.

Each document gets integer measures (per mille). The sketch of a measure in one (lang, source) is a
histogram over buckets whose width grows with the value: values below 64 are exact, larger ones keep their
six leading bits, a relative error under 1/32. Sketches merge by adding counts, so a source with a third
of all rows is at most a few hundred rows of each task. Upper limits are the third quartile plus ``REACH``
interquartile ranges, lower ones the first quartile minus as much, and no fixed limit stands beside them;
``SLACK`` is the least distance, which keeps uniform sources from cutting ordinary documents.

Column code only. One pass over the texts writes a table of numbers; sketches and the join read that.

Defined results: null and empty texts have no words and fail the base rules; null lang or source is a
group of its own; repeated rows are judged one by one and count in the sketch one by one; an empty table
gives an empty one; columns besides doc_id, text, lang and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, through_table, whole_text

MIN_WORDS = 10
WINDOW = 5
#: Interquartile ranges between the quartiles and the limits.
REACH = 4
#: Measure -> whether there is a lower limit, and how far limits are from the quartiles at least, in the measure's
#: unit. The distance keeps a source of equal documents from rejecting ordinary ones; it is no limit by itself.
SLACK = {
    "word_length": (True, 1500),  # 1000 * code points per word
    "symbols": (False, 40),  # 1000 * symbols per code point of words
    "dup_lines": (False, 300),  # 1000 * repeated lines per line
    "repeats": (False, 150),  # 1000 * words in repeated windows per word
    "capitals": (False, 200),  # 1000 * capitals A-Z per code point of words
}


def _repeated(words: DataFrame) -> DataFrame:
    """Add n_repeat_words: sort the windows' hashes, keep equal neighbours, add up what they cover."""
    n = F.col("n_words")
    at = lambda k: lambda i: F.get(F.col("h"), i + k)
    window = lambda i: F.struct(F.xxhash64(*[at(k)(i) for k in range(WINDOW)]).alias("w"), i.alias("i"))
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), (n - WINDOW).cast("int")), window))
    hashed = words.withColumn("h", F.transform("words", lambda w: F.xxhash64(w))).withColumn("win", windows)
    several = F.size(F.array_distinct(F.transform("win", lambda x: x["w"]))) < F.size("win")
    ordered = hashed.withColumn("ordered", F.when(several, F.array_sort("win")))
    same = lambda x, i: (x["w"] == F.get("ordered", i - 1)["w"]) | (x["w"] == F.get("ordered", i + 1)["w"])
    twice = F.filter("ordered", lambda x, i: F.coalesce(same(x, i), F.get("ordered", i - 1)["w"] == x["w"], F.get("ordered", i + 1)["w"] == x["w"], F.lit(False)))
    starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
    begin = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("sum"))
    covered = F.aggregate(
        starts, begin,
        lambda acc, i: F.struct(i.alias("last"), (acc["sum"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("sum")),
        lambda acc: acc["sum"],
    )
    return ordered.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each document."""
    text = whole_text()
    base = docs.select("doc_id", "lang", "source", text.alias("text"))
    words = base.withColumn("words", F.array_remove(F.split("text", SPACE + "+"), ""))
    lines = F.filter(F.split("text", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^ \t-\r]")))
    joined = F.array_join("words", "")
    counted = (
        words.withColumn("n_words", F.size("words").cast("long"))
        .withColumn("joined", joined)
        .withColumn("lines", lines)
        .withColumn("word_chars", F.length("joined").cast("long"))
        .withColumn("n_symbols", F.regexp_count("joined", F.lit(r"[#*$%&|<>]")).cast("long"))
        .withColumn("n_capitals", F.regexp_count("joined", F.lit(r"[A-Z]")).cast("long"))
        .withColumn("n_lines", F.size("lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    )
    return _repeated(counted).select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines", "n_repeat_words"
    )


def _measures() -> dict[str, Column]:
    share = lambda a, b: F.expr(f"(1000 * {a}) div greatest({b}, 1)")
    return {
        "word_length": share("word_chars", "n_words"),
        "symbols": share("n_symbols", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
        "capitals": share("n_capitals", "word_chars"),
    }


def bucket(v: Column) -> Column:
    """The sketch's bucket of a whole number: its six leading bits, the others zero."""
    shift = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, shift), shift)


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): merge two of them by adding n."""
    entries = F.array(*[F.struct(F.lit(k).alias("measure"), bucket(c).alias("bucket")) for k, c in _measures().items()])
    return (
        measured.where(~F.col("base_failed")).select("lang", "source", F.explode(entries).alias("x"))
        .groupBy("lang", "source", "x.measure", "x.bucket").agg(F.count("*").alias("n"))
    )


def limits(sketched: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per (lang, source): lo_<measure> and hi_<measure>, null where there is no limit."""
    from pyspark.sql import Window

    group = Window.partitionBy("lang", "source", "measure")
    summed = sketched.withColumn("below", F.sum("n").over(group.orderBy("bucket"))).withColumn("all", F.sum("n").over(group))
    quartile = lambda k: F.min(F.when(F.col("below") * 4 >= F.col("all") * k, F.col("bucket")))
    box = summed.groupBy("lang", "source", "measure").agg(quartile(1).alias("q1"), quartile(3).alias("q3"))
    one = lambda m, c: F.max(F.when(F.col("measure") == m, c))
    out = []
    for m, (lower, slack) in SLACK.items():
        reached = F.greatest((F.col("q3") - F.col("q1")) * reach, F.lit(slack))
        if lower:
            out.append(one(m, F.col("q1") - reached).alias(f"lo_{m}"))
        out.append(one(m, F.col("q3") + reached).alias(f"hi_{m}"))
    return box.groupBy(F.col("lang").alias("g_lang"), F.col("source").alias("g_source")).agg(*out)


def judge(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per document: its counts, base_failed and kept."""
    n = F.col("n_words")
    failed = (n < MIN_WORDS) | (F.col("n_repeat_words") * 100 > n * 20)
    measured = through_table(measure(docs).withColumn("base_failed", failed), "quality")
    limit = limits(sketch(measured), reach)
    odd = F.lit(False)
    for m, c in _measures().items():
        odd = odd | F.coalesce(bucket(c) > F.col(f"hi_{m}"), F.lit(False))
        if SLACK[m][0]:
            odd = odd | F.coalesce(bucket(c) < F.col(f"lo_{m}"), F.lit(False))
    joined = measured.join(
        limit, F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source")), "left"
    )
    return joined.withColumn("kept", ~F.col("base_failed") & ~odd)


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """The contract's columns of ``judge``."""
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _sql_bucket(v: str) -> str:
    return f"((({v}) >> greatest(length(bin({v})) - 6, 0)) << greatest(length(bin({v})) - 6, 0))"


def _sql() -> str:
    share = {
        "word_length": "(1000 * word_chars) // greatest(n_words, 1)",
        "symbols": "(1000 * n_symbols) // greatest(word_chars, 1)",
        "dup_lines": "(1000 * n_dup_lines) // greatest(n_lines, 1)",
        "repeats": "(1000 * n_repeat_words) // greatest(n_words, 1)",
        "capitals": "(1000 * n_capitals) // greatest(word_chars, 1)",
    }
    union = " UNION ALL ".join(
        f"SELECT rid, lang, source, base_failed, '{m}' AS measure, {_sql_bucket(e)} AS bucket FROM failing"
        for m, e in share.items()
    )
    slack = " ".join(f"WHEN '{m}' THEN {d}" for m, (_, d) in SLACK.items())
    lower = ", ".join(f"'{m}'" for m, (low, _) in SLACK.items() if low)
    return f"""
WITH base AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[ \\t-\\r]+'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS lines FROM base),
counted AS (
  SELECT *, len(words) AS n_words, array_to_string(words, '') AS joined, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines FROM split),
windows AS (
  SELECT rid, i, list_slice(words, i, i + {WINDOW - 1}) AS w
  FROM (SELECT rid, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM counted WHERE len(words) >= {WINDOW})),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM windows) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + {WINDOW})) AS p FROM twice) GROUP BY rid),
measured AS (
  SELECT c.rid, doc_id, lang, source, n_words::BIGINT AS n_words, length(joined)::BIGINT AS word_chars,
         (length(joined) - length(regexp_replace(joined, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (length(joined) - length(regexp_replace(joined, '[A-Z]', '', 'g')))::BIGINT AS n_capitals,
         n_lines, n_dup_lines::BIGINT AS n_dup_lines, coalesce(v.n, 0)::BIGINT AS n_repeat_words
  FROM counted c LEFT JOIN covered v ON v.rid = c.rid),
failing AS (
  SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * 20 AS base_failed FROM measured),
entries AS ({union}),
summed AS (
  SELECT lang, source, measure, bucket, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS below,
         sum(n) OVER (PARTITION BY lang, source, measure) AS total
  FROM (SELECT lang, source, measure, bucket, count(*) AS n FROM entries WHERE NOT base_failed GROUP BY ALL)),
box AS (
  SELECT lang, source, measure, min(bucket) FILTER (WHERE below * 4 >= total) AS q1,
         min(bucket) FILTER (WHERE below * 4 >= total * 3) AS q3 FROM summed GROUP BY ALL),
limited AS (
  SELECT lang, source, measure, CASE WHEN measure IN ({lower}) THEN q1 - reached END AS lo, q3 + reached AS hi
  FROM (SELECT *, greatest((q3 - q1) * {REACH}, CASE measure {slack} END) AS reached FROM box)),
odd AS (
  SELECT rid, bool_or(coalesce(bucket > hi, false) OR coalesce(bucket < lo, false)) AS is_odd
  FROM entries e LEFT JOIN limited l ON e.lang IS NOT DISTINCT FROM l.lang AND e.source IS NOT DISTINCT FROM l.source
       AND e.measure = l.measure GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT is_odd AS kept
FROM failing JOIN odd USING (rid)"""


SQL = _sql()
