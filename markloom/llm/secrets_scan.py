"""Secret scan: two character Markov models, one of random strings and one of ordinary identifiers.

Both are bigram models, smoothed by the frequency of single characters and trained on labelled samples that the corpus itself gives:
values of the base patterns (assignments, access keys, hexadecimal strings) are the random class, all
other identifier-like tokens the ordinary one. A token whose log-likelihood ratio per character passes
``THRESHOLD`` is a secret, in addition to the base spans.

Column code only. Training counts combine before they move; the models are two tables of
``len(ALPHABET) ** 2`` numbers whatever the corpus, and so travel inside the plan.

Defined results: null and empty texts have no spans; without labelled samples of both classes the models
say nothing and only base spans remain; repeated rows are scored one by one; columns besides doc_id and
text are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import match_list, scan, span_text, tagged, whole_text

KINDS = ("assign", "access", "hex")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?+\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
#: Identifier-like tokens: long enough for a bigram model to judge.
TOKEN = r"[A-Za-z0-9+/_=-]{16,}+"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Nats per bigram by which a token must be likelier as a random string.
THRESHOLD = 0.5
#: Observations that the frequency of single characters counts for; so many that a few unlabelled secrets among the
#: ordinary tokens do not make their own pairs ordinary.
PULL = 200
SPANS = "array<struct<rank:int,kind:string,s:int,e:int,v:string>>"


def base_spans(text: Column) -> Column:
    """Base spans, by start, then kind."""
    value = lambda m: F.length(F.regexp_extract(m["v"], ASSIGN, 1)) >= 6
    return F.array_sort(
        F.concat(
            tagged(match_list(text, ASSIGN), "assign", 0, value),
            tagged(match_list(text, ACCESS, F.contains(text, F.lit("AKIA"))), "access", 1),
            tagged(match_list(text, HEX), "hex", 2),
        ).cast(SPANS),
        lambda a, b: F.when(a["s"] != b["s"], a["s"] - b["s"]).otherwise(a["rank"] - b["rank"]),
    )


def _bigrams(token: Column) -> Column:
    """All pairs of neighbours; by splitting, since taking pieces by position walks the token for each of them."""
    chars = F.split(token, "")
    return F.zip_with(chars, F.slice(chars, 2, F.length(token)), lambda a, b: F.concat(a, b))


def train(docs: DataFrame) -> list[float]:
    """Log-likelihood ratio of each bigram (row: first character, column: second), row by row.

    The list has ``len(ALPHABET) ** 2`` entries, or none when a class has no sample.
    """
    text = whole_text()
    secret = F.concat(
        F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1)),
        F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
    )
    rest = F.regexp_replace(F.regexp_replace(text, ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    label = lambda tokens, secret: F.transform(tokens, lambda t: F.struct(F.lit(secret).alias("secret"), t.alias("token")))
    samples = docs.select(
        F.explode(F.concat(label(secret, True), label(F.regexp_extract_all(rest, F.lit(TOKEN), F.lit(0)), False))).alias("x")
    ).select("x.*")
    pairs = (
        samples.where(F.length("token") >= 6)
        .distinct()  # copies of a text are no further evidence
        .select("secret", F.explode(_bigrams(F.col("token"))).alias("pair"))
        .groupBy("secret", "pair").agg(F.count("*").alias("n"))
        .where(F.regexp_like("pair", F.lit(r"^[A-Za-z0-9+/_=-]{2}$")))
    )
    k = len(ALPHABET)
    counts = {True: [0] * (k * k), False: [0] * (k * k)}
    for r in pairs.collect():  # at most 2 * len(ALPHABET) ** 2 rows
        counts[r.secret][ALPHABET.index(r.pair[0]) * k + ALPHABET.index(r.pair[1])] += r.n
    if not all(map(any, counts.values())):
        return []
    secret, ordinary = (_chances(counts[c], k) for c in (True, False))
    return [math.log(a) - math.log(b) for a, b in zip(secret, ordinary)]


def _chances(counts: list[int], k: int) -> list[float]:
    """P(second | first), drawn towards how often the second character is at all."""
    single = [(sum(counts[b::k]) + 1) / (sum(counts) + k) for b in range(k)]
    rows = [sum(counts[a * k : a * k + k]) for a in range(k)]
    return [(counts[i] + PULL * single[i % k]) / (rows[i // k] + PULL) for i in range(k * k)]


def ratio(token: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio of a token's bigrams."""
    table = F.array(*[F.lit(x) for x in model])
    place = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    start = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))

    def step(acc: Column, i: Column) -> Column:
        gain = F.when(acc["last"] > 0, F.element_at(table, (acc["last"] - 1) * len(ALPHABET) + i)).otherwise(0.0)
        return F.struct(i.alias("last"), (acc["sum"] + gain).alias("sum"))

    return F.aggregate(F.filter(place, lambda i: i > 0), start, step, lambda acc: acc["sum"]) / (F.length(token) - 1)


def _apart(tokens: Column, spans: Column) -> Column:
    """Tokens that meet no span. Tokens do not meet each other, so only the spans before and the neighbour behind count."""
    both = F.array_sort(
        F.concat(spans, tokens),
        lambda a, b: F.when(a["s"] != b["s"], a["s"] - b["s"]).otherwise(a["rank"] - b["rank"]),
    )
    pairs = F.arrays_zip(both.alias("x"), F.slice(both, 2, F.greatest(F.size(both), F.lit(1))).alias("after"))
    random = len(KINDS)

    def step(reach: Column, p: Column) -> tuple[Column, Column]:
        x, after = p["x"], p["after"]
        token = x["rank"] == random
        free = token & (reach <= x["s"]) & (after["s"].isNull() | (after["s"] >= x["e"]))
        return F.when(token, reach).otherwise(F.greatest(reach, x["e"])), F.when(free, x)

    return F.when(F.size(tokens) == 0, tokens).otherwise(scan(pairs, F.lit(0), step, SPANS[len("array<") : -1]))


def find_secrets(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, spans (base) and random (tokens that only the models find), as arrays."""
    model = train(docs)
    text = whole_text()
    base = docs.select("doc_id", text.alias("text")).select("doc_id", "text", base_spans(F.col("text")).alias("spans"))
    if not model:
        return base.select("doc_id", "spans", F.array().cast(SPANS).alias("random"))
    tokens = tagged(match_list(F.col("text"), TOKEN), "random", len(KINDS)).cast(SPANS)
    found = F.filter(_apart(tokens, F.col("spans")), lambda x: ratio(x["v"], model) >= threshold)
    return base.select("doc_id", "spans", found.cast(SPANS).alias("random"))


def secret_digests(docs: DataFrame) -> DataFrame:
    """The contract's columns of ``find_secrets``."""
    found = find_secrets(docs)
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    every = F.array_sort(
        F.concat("spans", "random"),
        lambda a, b: F.when(a["s"] != b["s"], a["s"] - b["s"]).otherwise(a["rank"] - b["rank"]),
    )
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(span_text(F.col("spans")), 256).alias("base_sha256"),
        span_text(every).alias("spans"),
    )
