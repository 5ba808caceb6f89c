"""Language identification by interpolated Kneser-Ney character models, one per language.

Words (runs of letters, lower case) are the unit: a model predicts each character of a word, and its end,
from the ``ORDER - 1`` before it, beginning marks included. Training counts words per language over all
training documents, then the n-grams of the distinct words; lower orders count the different characters
before an n-gram. All n-grams and contexts of all orders are kept, as tables. Models of up to
``SENT_CELLS`` numbers are sent to the documents whole, as arrays sorted by n-gram hash. Larger ones stay on
the cluster: the distinct words of all documents ask for their n-grams, whose probabilities come from joins
with the tables, order by order; they add up to one score per word and language, and the words' to the texts'.

A text belongs to the language with the least cross-entropy per character. Calibration: the cross-entropies
of training documents give each language a mean and a deviation, and texts more than ``REJECT``
deviations and ``MARGIN`` above the mean are rejected.

Defined results: null texts and texts without a letter are ``und`` with score 0, and rejected; documents
without lang train nothing; a null doc_id hashes like the empty string; without any training document every
text is ``und``; equal cross-entropies go to the language that sorts first; repeated rows are scored one by
one; columns besides doc_id, text and lang are ignored, or kept by ``keep_known``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import through_table
from .words import mix, slabs

ORDER = 5
#: Languages that are told apart; more of them is an error, not a cut.
MAX_LANGUAGES = 500
#: Deviations above the mean cross-entropy from which a text is no text of that language.
REJECT = 8.0
#: Nats per character that a rejected text is above the mean at least: texts of unseen words of the language are
#: less than that above it, texts of another language more.
MARGIN = 1.0
#: Slope of the score: nats per character that one language must be better by.
SLOPE = 20.0
#: Probability of a character that no order knows.
FLOOR = 1.0 / 65536
#: Numbers (n-grams and contexts times languages) up to which models are sent to the documents whole; larger ones are
#: joined. Both ways give the same scores.
SENT_CELLS = 8_000_000
#: Words that a task keeps.
KNOWN = 200_000
BEGIN, END = "\x02", "\x03"
#: What stands between words: anything but letters and numbers that are no digits.
GAP = r"[^\p{L}\p{Nl}\p{No}]+"
_WORD = re.compile(r"[^\W\d_]+")
_COEFF = mix(np.arange(1, ORDER + 2, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def _with_grams(words: DataFrame) -> DataFrame:
    """A row for each n-gram of the highest order in each word."""
    marked = F.regexp_extract_all(F.concat(F.lit(BEGIN * (ORDER - 1)), "word", F.lit(END)), F.lit("(?s)."), F.lit(0))
    place = F.sequence(F.lit(0), F.size("marked") - ORDER)
    grams = F.transform(place, lambda i: F.concat(*[F.get("marked", i + k) for k in range(ORDER)]))
    kept = [c for c in words.columns if c != "word"]
    return words.withColumn("marked", marked).select(*kept, F.explode(grams).alias("gram"))


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, c): counts of all n-grams of the highest order."""
    words = docs.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
    counted = words.where("word <> ''").groupBy("lang", "word").agg(F.count("*").alias("c"))
    return _with_grams(counted).groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def train(table: DataFrame) -> tuple[list[tuple[DataFrame, DataFrame]], int]:
    """Per order (lang, gram, part) and (lang, ctx, back): the models of all languages, and how many rows they have."""
    orders, size = [], 0
    for k in range(ORDER, 0, -1):
        # Discount per language: n1 / (n1 + 2 n2) of the counts.
        ones, twos = (F.sum((F.col("c") == i).cast("long")) for i in (1, 2))
        share = F.greatest(F.lit(0.05), F.least(F.lit(0.95), ones / (ones + 2 * twos)))
        discount = table.groupBy("lang").agg(F.when(ones > 0, share).otherwise(0.5).alias("d"))
        contexts = table.groupBy("lang", F.substring("gram", 1, k - 1).alias("ctx")).agg(F.sum("c").alias("total"), F.count("*").alias("kinds"))
        contexts = contexts.join(F.broadcast(discount), "lang")
        contexts = through_table(contexts.select("lang", "ctx", "total", "d", (F.col("d") * F.col("kinds") / F.col("total")).alias("back")), "contexts")
        size += table.count() + contexts.count()
        contexts = F.broadcast(contexts) if k == 1 else contexts  # one row per language
        grams = table.withColumn("ctx", F.substring("gram", 1, k - 1)).join(contexts, ["lang", "ctx"])
        part = F.greatest(F.col("c") - F.col("d"), F.lit(0.0)) / F.col("total")
        orders.append((grams.select("lang", "gram", part.alias("part")), contexts.select("lang", "ctx", "back")))
        if k > 1:
            table = table.groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("c"))
            table = through_table(table, "grams")
    return orders[::-1], size


def joined_scores(docs: DataFrame, orders: list[tuple[DataFrame, DataFrame]], languages: list[str]) -> DataFrame:
    """(h, size, letters, s0, s1, ...): the word's hash, code points with the end, and log-probability in each language."""
    size = (F.length("word") + 1).cast("long")
    words = docs.select(F.explode(F.split(F.lower("text"), GAP)).alias("word")).where("word <> ''").distinct()
    words = words.select("word", F.xxhash64("word").alias("h"), size.alias("size"), F.col("word").rlike(r"\p{L}").alias("letters"))
    asked = through_table(_with_grams(words), "asked")
    every = F.explode(F.array(*[F.lit(x) for x in languages])).alias("lang")
    p = None
    for k, (parts, contexts) in enumerate(orders, 1):
        each = asked.select(F.substring("gram", ORDER - k + 1, k).alias("gram")).distinct().select("gram", every)
        each = each.withColumn("ctx", F.substring("gram", 1, k - 1)).withColumn("end", F.substring("gram", 2, k))
        each = each.join(parts, ["lang", "gram"], "left").join(contexts, ["lang", "ctx"], "left")
        each = each.withColumn("less", F.lit(FLOOR)) if p is None else each.join(p.select("lang", F.col("gram").alias("end"), F.col("p").alias("less")), ["lang", "end"])
        value = F.coalesce("part", F.lit(0.0)) + F.coalesce("back", F.lit(1.0)) * F.col("less")
        p = through_table(each.select("lang", "gram", value.alias("p")), "probabilities")
    sums = [F.sum(F.when(F.col("lang") == x, F.ln("p"))).alias(f"s{i}") for i, x in enumerate(languages)]
    wide = p.groupBy("gram").agg(*sums)
    return asked.join(wide, "gram").groupBy("h", "size", "letters").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(languages))])


def score_joined(docs: DataFrame, scores: DataFrame, languages: list[str]) -> DataFrame:
    """What ``score_sent`` gives, by a join of each text's words with the words' scores."""
    kept = [c for c in docs.columns if c != "text"]
    row = ["__row", *kept]
    hashes = F.transform(F.array_remove(F.split(F.lower("text"), GAP), ""), lambda w: F.xxhash64(w))
    each = docs.withColumn("__row", F.monotonically_increasing_id()).select(*row, F.explode_outer(hashes).alias("h"))
    met = each.groupBy(*row, "h").agg(F.count("*").alias("__n")).join(scores, "h", "left")
    total = lambda c: F.sum(F.col(c) * F.col("__n"))
    summed = met.groupBy(*row).agg(
        F.max("letters").alias("__letters"), total("size").alias("__size"), *[total(f"s{i}").alias(f"__s{i}") for i in range(len(languages))]
    )
    known = F.coalesce("__letters", F.lit(False))
    h = summed.withColumn("__h", F.when(known, F.array(*[-F.col(f"__s{i}") / F.col("__size") for i in range(len(languages))])))
    best = h.withColumn("__best", F.array_min("__h"))
    odds = F.aggregate("__h", F.lit(0.0), lambda acc, x: acc + F.exp(-SLOPE * (x - F.col("__best"))))
    name = F.get(F.array(*[F.lit(x) for x in languages]), (F.array_position("__h", F.col("__best")) - 1).cast("int"))
    return best.select(
        *kept, F.coalesce(name, F.lit("und")).alias("lang_pred"), F.coalesce(1.0 / odds, F.lit(0.0)).alias("score"), F.col("__best").alias("entropy")
    )


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of n-grams given as rows of code points."""
    total = np.zeros(len(codes), np.uint64)
    for j in range(codes.shape[1]):
        total += (codes[:, j].astype(np.uint64) + np.uint64(1)) * _COEFF[j]
    return mix(total ^ _COEFF[codes.shape[1]])


def _codes(grams: pd.Series, k: int) -> np.ndarray:
    joined = "".join(grams)
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32).reshape(-1, k) if k else np.zeros((len(grams), 0), np.uint32)


def _table(frame: pd.DataFrame, gram: str, k: int, languages: list[str], columns: list[str]) -> tuple:
    """Sorted hashes of n-grams, and for each column a matrix (n-gram, language), nan where there is none."""
    hashes = gram_hashes(_codes(frame[gram], k))
    keys, row = np.unique(hashes, return_inverse=True)
    lang = frame["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy()
    out = []
    for c in columns:
        m = np.full((len(keys), len(languages)), np.nan, np.float32)
        m[row, lang] = frame[c].to_numpy()
        out.append(m)
    return keys, *out


def collected(orders: list[tuple[DataFrame, DataFrame]], languages: list[str]) -> dict:
    """The whole models as arrays: per order (hashes, probability part, context hashes, back-off weight)."""
    out = []
    for k, (parts, contexts) in enumerate(orders, 1):
        keys, p = _table(parts.toArrow().to_pandas(), "gram", k, languages, ["part"])
        ctx_keys, back = _table(contexts.toArrow().to_pandas(), "ctx", k - 1, languages, ["back"])
        out.append((keys, np.nan_to_num(p, nan=0.0), ctx_keys, np.nan_to_num(back, nan=1.0)))
    return {"languages": languages, "orders": out, "floor": FLOOR}


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def word_scores(words: list[str], model: dict) -> np.ndarray:
    """Log-probability of each word in each language."""
    pad = ORDER - 1
    joined = "".join(BEGIN * pad + w + END for w in words)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    sizes = np.array([len(w) + pad + 1 for w in words])
    begins = np.cumsum(sizes) - sizes
    # Places of predicted characters: all but the beginning marks.
    own = np.repeat(np.arange(len(words)), sizes - pad)
    place = np.arange(len(own)) - np.repeat(np.cumsum(sizes - pad) - (sizes - pad), sizes - pad) + begins[own] + pad
    p = np.full((len(own), len(model["languages"])), model["floor"], np.float32)
    for k, (keys, part, ctx_keys, back) in enumerate(model["orders"], 1):
        window = codes[place[:, None] + np.arange(1 - k, 1)]
        at, known = _find(keys, gram_hashes(window))
        ctx_at, ctx_known = _find(ctx_keys, gram_hashes(window[:, :-1]))
        weight = np.where(ctx_known[:, None], back[ctx_at], np.float32(1.0))
        p = np.where(known[:, None], part[at], np.float32(0.0)) + weight * p
    return np.add.reduceat(np.log(p.astype(np.float64)), np.cumsum(sizes - pad) - (sizes - pad), axis=0)


def _has_letter(words: list[str]) -> bool:
    return any(map(str.isalpha, words)) or any(c.isalpha() for w in words for c in w)


def score_sent(docs: DataFrame, model: dict) -> DataFrame:
    """The columns of docs but for text, with lang_pred, score and entropy (nats per character)."""
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("entropy", T.DoubleType())]
    kept = [f for f in docs.schema if f.name != "text"]
    schema = T.StructType([*kept, *added])
    names = schema.names
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        width = len(model["languages"])
        known: dict[str, int] = {}
        table = np.zeros((0, width))
        for batch, texts in slabs(batches):
            found = [_WORD.findall(t.decode().lower()) for t in texts]
            if len(known) > KNOWN:
                known, table = {}, np.zeros((0, width))
            fresh = list({w for ws in found for w in ws if w not in known})
            if fresh:
                known.update(zip(fresh, range(len(table), len(table) + len(fresh))))
                table = np.concatenate((table, word_scores(fresh, model)))
            pred, sure, entropy = [], [], []
            for ws in found:
                if not ws or not _has_letter(ws):
                    pred.append("und")
                    sure.append(0.0)
                    entropy.append(None)
                    continue
                h = -table[[known[w] for w in ws]].sum(0) / (sum(map(len, ws)) + len(ws))
                best = int(np.argmin(h))
                pred.append(model["languages"][best])
                sure.append(float(1.0 / np.exp(-SLOPE * (h - h[best])).sum()))
                entropy.append(float(h[best]))
            new = [pa.array(pred, pa.string()), pa.array(sure, pa.float64()), pa.array(entropy, pa.float64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in names[:-3]), *new], names=names)

    return docs.mapInArrow(run, schema)


def score(docs: DataFrame) -> DataFrame:
    """The columns of docs but for text, with lang_pred, score and entropy (nats per character)."""
    rows = docs.where(~F.col("held_out") & F.col("__lang").isNotNull() & F.col("text").isNotNull())
    table = through_table(gram_counts(rows.select(F.col("__lang").alias("lang"), "text")), "grams")
    languages = sorted(r.lang for r in table.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if not languages:
        kept = [c for c in docs.columns if c != "text"]
        return docs.select(*kept, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("entropy"))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    orders, size = train(table)
    if size * len(languages) <= SENT_CELLS:
        return score_sent(docs, collected(orders, languages))
    return score_joined(docs, through_table(joined_scores(docs, orders, languages), "scores"), languages)


def identify(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """doc_id (or other columns), held_out, lang_pred, score, entropy and rejected."""
    columns = columns or ["doc_id"]
    asked = docs.select(*columns, "text", held_out(F.col("doc_id")).alias("held_out"), F.col("lang").alias("__lang"))
    scored = through_table(score(asked), "languages")
    own = scored.where(~F.col("held_out") & (F.col("__lang") == F.col("lang_pred")))
    usual = own.groupBy(F.col("lang_pred").alias("__pred")).agg(F.avg("entropy").alias("__mean"), F.coalesce(F.stddev("entropy"), F.lit(0.0)).alias("__dev"))
    limit = F.col("__mean") + F.greatest(REJECT * F.col("__dev"), F.lit(MARGIN))
    odd = F.coalesce(F.col("entropy") > limit, F.lit(False)) | (F.col("lang_pred") == "und")
    return scored.join(usual, F.col("lang_pred") == F.col("__pred"), "left").select(
        *columns, "held_out", "lang_pred", "score", "entropy", odd.alias("rejected")
    )


def languages(docs: DataFrame) -> DataFrame:
    """The contract's columns, and whether the text is rejected."""
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score", "rejected")


#: Rejected documents up to which they are sent to the documents instead of the other way round.
SENT = 100_000


def keep_known(docs: DataFrame) -> DataFrame:
    """The documents that are not rejected, as they were."""
    keyed = docs.withColumn("__key", F.xxhash64("text"))
    gone = identify(keyed, ["doc_id", "__key"]).where("rejected").select(F.col("doc_id").alias("__id"), F.col("__key").alias("__gone"))
    gone = through_table(gone.distinct(), "rejected")
    gone = F.broadcast(gone) if gone.count() <= SENT else gone
    return keyed.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__gone")), "left_anti").select(*docs.columns)
