"""PII: information-theoretic sanitisation.

Base spans (mail addresses, IP addresses, card numbers, telephone numbers) are the protected entities.
The corpus says how strongly a term gives an entity away: with ``p`` over whole documents, the share of
the entity's information that the term discloses is ``PMI(entity, term) / IC(entity)``, 1 when the term
occurs with that entity only. Wherever terms above ``generalise_at`` occur, with the entity, far from it or in
documents without it, they are replaced by their class, and above ``remove_at`` removed; base spans are always
replaced by their kind.

A term that met an entity ``met`` times is in ``met`` documents at least, so only terms in at most
``N ** (1 - generalise_at) * n_entity ** generalise_at`` documents can disclose it: only these are paired.

Everything is Column code. Only spans and terms are shuffled, never texts; counts are combined before
they move, so one entity or term in a third of all rows is one row of each task.

Defined results: null and empty texts have no spans; an empty table gives an empty one; rows equal in
doc_id and text are the same document and get the same result each; a null doc_id is a key like any
other; columns besides doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import match_list, span_text, tagged, through_table, whole_text

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns. Possessive runs and the look-behinds keep them linear: a run is tried at its start, or
# where the last match ended, and nowhere else.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9]){15,}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
OCTETS = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"
SPANS = "array<struct<rank:int,kind:string,s:int,e:int,v:string,c:bigint>>"

#: Code points on either side of an entity that tell its surroundings apart.
AROUND = 64
#: Different surroundings of an entity in which a term must be in the document, so that copies of one text prove nothing.
SUPPORT = 3
GENERALISE_AT, REMOVE_AT = 0.8, 0.95
#: Words, and whole mail addresses, so that no word is taken out of one.
TERM = EMAIL + r"|\p{L}{3,}+"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _card(m: Column) -> Column:
    d = _digits(m["v"])
    return F.length(d).between(16, 19) & F.call_function("luhn_check", d)


def base_spans(text: Column) -> Column:
    """Spans of the four kinds, by kind, then start."""
    found = lambda pattern, gate=None: match_list(text, pattern, gate, AROUND)
    return F.concat(
        tagged(found(EMAIL, F.contains(text, F.lit("@"))), "email", 0, extra=("c",)),
        tagged(found(IP), "ip", 1, lambda m: F.regexp_like(m["v"], F.lit(OCTETS)), ("c",)),
        tagged(found(CARD), "card", 2, _card, ("c",)),
        tagged(
            found(PHONE, F.contains(text, F.lit("+"))),
            "phone", 3, lambda m: F.length(_digits(m["v"])).between(8, 15), ("c",),
        ),
    ).cast(SPANS)


def _terms(text: Column) -> Column:
    """The different words of a text, in lower case."""
    words = F.filter(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda w: ~F.contains(w, F.lit("@")))
    return F.array_distinct(F.transform(words, lambda w: F.lower(w)))


def disclosing(docs: DataFrame, staged: DataFrame, support: int = SUPPORT, threshold: float = GENERALISE_AT) -> DataFrame:
    """(entity, term, share): terms that disclose at least ``threshold`` of an entity's information."""
    n = staged.count()  # one number
    spans = staged.select("doc_id", "tkey", F.explode("spans").alias("x"))
    each = spans.groupBy("doc_id", "tkey", F.xxhash64("x.kind", "x.v").alias("entity")).agg(F.min("x.c").alias("ctx"))
    entities = (
        each.groupBy("entity", "ctx").agg(F.count("*").alias("docs"))
        .groupBy("entity").agg(F.sum("docs").alias("n_entity"), F.count("*").alias("different"))
        .where((F.col("different") >= support) & (F.col("n_entity") < n))
        .withColumn("most", F.pow(F.lit(float(n)), F.lit(1 - threshold)) * F.pow(F.col("n_entity").cast("double"), F.lit(threshold)))
    )
    entities = through_table(entities.select("entity", "n_entity", "most"), "entities")
    most = entities.agg(F.max("most").alias("most")).first().most  # one number
    frequency = (
        docs.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
        .where(F.col("n_term").between(support, (most or 0) * (1 + 1e-9)))
    )
    named = each.join(entities, "entity").select(
        F.col("doc_id").alias("e_doc"), F.col("tkey").alias("e_key"), "entity", "ctx", "n_entity", "most"
    )
    terms = staged.select("doc_id", "tkey", F.explode("terms").alias("term")).join(frequency, "term")
    same = F.col("doc_id").eqNullSafe(F.col("e_doc")) & (F.col("tkey") == F.col("e_key"))
    met = (
        terms.dropDuplicates(["doc_id", "tkey", "term"])
        .join(named, same & (F.col("n_term") <= F.col("most") * (1 + 1e-9)))
        .groupBy("entity", "term", "ctx").agg(F.count("*").alias("docs"), F.max("n_entity").alias("n_entity"), F.max("n_term").alias("n_term"))
        .groupBy("entity", "term").agg(F.sum("docs").alias("met"), F.count("*").alias("support"), F.max("n_entity").alias("n_entity"), F.max("n_term").alias("n_term"))
        .where(F.col("support") >= support)
    )
    information = F.ln(F.lit(n) / F.col("n_entity"))
    pmi = F.ln(F.lit(n) * F.least("met", "n_term") / (F.col("n_entity") * F.col("n_term")))
    return met.select("entity", "term", (pmi / information).alias("share")).where(F.col("share") >= threshold)


def find_pii(docs: DataFrame, support: int = SUPPORT, generalise_at: float = GENERALISE_AT, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, spans (rank, kind, s, e, v, c) and terms (s, e, term, share).

    ``with_text`` carries the text along, for ``sanitise``.
    """
    base = docs.select("doc_id", whole_text().alias("text"))
    text, key = F.col("text"), F.xxhash64("text").alias("tkey")
    found = base.select("doc_id", key, "text", base_spans(text).alias("spans"))
    met = F.when(F.size("spans") > 0, _terms(text)).alias("terms")
    staged = through_table(found.select("doc_id", "tkey", "spans", met, *(["text"] if with_text else [])), "pii")
    strong = disclosing(base, staged, support, generalise_at)
    strong = through_table(strong.groupBy("term").agg(F.max("share").alias("share")), "terms")
    hits = (
        base.select("doc_id", key, F.explode(match_list(text, TERM)).alias("m"))
        .select("doc_id", "tkey", "m.s", "m.e", F.lower("m.v").alias("term")).join(strong, "term").distinct()
        .groupBy("doc_id", "tkey").agg(F.array_sort(F.collect_list(F.struct("s", "e", "term", "share"))).alias("terms"))
        .select(F.col("doc_id").alias("h_doc"), F.col("tkey").alias("h_key"), "terms")
    )
    none = F.array().cast("array<struct<s:int,e:int,term:string,share:double>>")
    # A letter outside of A-Z may stand right before an address, and its word then reaches into that.
    into = lambda t: F.regexp_like(t["term"], F.lit("[^a-z]")) & F.exists(
        "spans", lambda x: (x["s"] < t["e"]) & (x["e"] > t["s"])
    )
    return (
        staged.drop("terms").join(hits, staged["doc_id"].eqNullSafe(hits["h_doc"]) & (staged["tkey"] == hits["h_key"]), "left")
        .select("doc_id", "spans", F.filter(F.coalesce("terms", none), lambda t: ~into(t)).alias("terms"), *(["text"] if with_text else []))
    )


def sanitise(docs: DataFrame, support: int = SUPPORT, generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT) -> DataFrame:
    """doc_id and text, with base spans as ``[KIND]``, strong terms as ``[TERM]`` and the strongest removed."""
    found = find_pii(docs, support, generalise_at, with_text=True)
    edits = F.array_sort(
        F.concat(
            F.transform("spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")).alias("by"))),
            F.transform("terms", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.when(x["share"] >= remove_at, F.lit("")).otherwise(F.lit("[TERM]")).alias("by"))),
        )
    )
    text = F.col("text")

    def step(acc: Column, x: Column) -> Column:
        fresh = x["s"] >= acc["pos"]  # an edit inside the one before it only widens that
        piece = F.concat(acc["out"], F.substring(text, acc["pos"] + 1, x["s"] - acc["pos"]), x["by"])
        return F.struct(F.greatest(acc["pos"], x["e"]).alias("pos"), F.when(fresh, piece).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))
    done = F.aggregate(edits, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["pos"] + 1, F.length(text))))
    return found.select("doc_id", done.alias("text"))


def pii_digests(docs: DataFrame) -> DataFrame:
    """The contract's columns of ``find_pii``."""
    found = find_pii(docs)
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    terms = F.transform("terms", lambda x: F.struct(F.lit("term").alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
    base = span_text(F.col("spans"))
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", F.nullif(base, F.lit("")), F.nullif(span_text(terms), F.lit(""))).alias("spans"),
    )
