"""Benchmark decontamination: an FM-index per shard of the training texts.

Each task cuts its documents into shards of about ``SHARD_WORDS`` words and indexes each: suffix positions are
sorted, the last words before them go into a wavelet matrix, every 16th position is kept. All test phrases
(windows of ``WINDOW`` item words) are searched backwards at once, occurrences are located from the kept
positions, and overlapping ones merge to removal spans. Nothing is shuffled; a document never leaves its task.

Phrases go to the tasks in blocks of at most ``BLOCK_BYTES`` of benchmark text. A larger benchmark takes
several passes, each of which adds its spans to those found so far, so nothing that is broadcast grows.
Words are compared as 64-bit hashes.

Defined results: null and empty texts, and texts without a word, have no words and no hits; null or empty
items have no windows; equal items count once by item_id, a null item_id as the empty string; repeated documents
are handled one by one; a document longer than a shard is cut into pieces that overlap by a window; columns
besides doc_id and text are carried along or left out, as ``columns`` says.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fm_index import FMIndex
from .words import LETTERS, Powers, slabs, word_hashes

WINDOW = 13
SHARD_WORDS = 1 << 19
#: Benchmark text per pass.
BLOCK_BYTES = 8 << 20
#: A document is contaminated if at least one word in so many is hit.
SHARE = 20


def phrases_of(items: list[tuple[str, str]]) -> dict:
    """Distinct windows of items as word hashes (words, aligned to the right; lengths), and the items of each.

    The items of window p are names[item[k]] for k in first[p]:first[p + 1].
    """
    names = sorted({i for i, _ in items})
    number = {x: k for k, x in enumerate(names)}
    hashes, bounds = word_hashes([t.encode() for _, t in items], LETTERS, Powers())
    rows, owner = [np.zeros((0, WINDOW + 1), np.uint64)], []
    for (name, _), a, b in zip(items, bounds[:-1], bounds[1:]):
        if a == b:
            continue
        n = min(WINDOW, b - a)
        windows = np.lib.stride_tricks.sliding_window_view(hashes[a:b], n)
        full = np.zeros((len(windows), WINDOW + 1), np.uint64)
        full[:, WINDOW - n : WINDOW] = windows
        full[:, WINDOW] = n
        rows.append(full)
        owner += [number[name]] * len(full)
    unique, inverse = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
    pairs = np.unique(np.column_stack((inverse.reshape(-1), np.array(owner, np.int64))), axis=0)
    return {
        "names": names, "words": unique[:, :WINDOW], "lengths": unique[:, WINDOW].astype(np.int64),
        "item": pairs[:, 1], "first": np.searchsorted(pairs[:, 0], np.arange(len(unique) + 1)),
    }


def occurrences(phrases: dict, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, text, word of the text) of every occurrence in the texts."""
    none = np.zeros(0, np.int64)
    out = []
    at = 0
    while at < len(bounds) - 1:
        # As many texts as make a shard; a longer text is cut into overlapping pieces.
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + SHARD_WORDS, "right")) - 1)
        lo, hi = int(bounds[at]), int(bounds[end])
        step = SHARD_WORDS if end == at + 1 else hi - lo + 1
        for a in range(lo, max(hi, lo + 1), step):
            b = min(hi, a + step + WINDOW - 1) if end == at + 1 else hi
            inner = bounds[at : end + 1] - lo if end > at + 1 else np.array([0, b - a])
            if b == a:
                continue
            index = FMIndex(words[a:b], inner)
            found, low, high = index.search(phrases["words"], phrases["lengths"])
            place, owner = index.locate(low, high)
            text = np.searchsorted(index.begins, place, "right") - 1
            out.append((found[owner], text + at, place - index.begins[text] + (a - lo if end == at + 1 else 0)))
        at = end
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (none, none, none)  # type: ignore[return-value]


def merge(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Union of spans as flat start, end, start, end, …; touching spans become one."""
    if not len(starts):
        return np.zeros(0, np.int64)
    by = np.argsort(starts, kind="stable")
    s, e = starts[by], np.maximum.accumulate(ends[by])
    new = np.concatenate(([True], s[1:] > e[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(s) - 1]))
    return np.column_stack((s[new], e[last])).reshape(-1)


def _pass(docs: DataFrame, items: list[tuple[str, str]]) -> DataFrame:
    """Add the occurrences of some items to the columns __n_words, __spans and __items."""
    sent = docs.sparkSession.sparkContext.broadcast(phrases_of(items))
    names = docs.columns

    def annotate(rows: list[pa.RecordBatch], hashes: list[np.ndarray], sizes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        phrases = sent.value
        n_words = np.concatenate(sizes)
        bounds = np.concatenate(([0], np.cumsum(n_words)))
        phrase, text, place = occurrences(phrases, np.concatenate(hashes), bounds)
        by = np.argsort(text, kind="stable")
        phrase, text, place = phrase[by], text[by], place[by]
        cut = np.searchsorted(text, np.arange(len(n_words) + 1))
        at = 0
        for batch in rows:
            spans, hit = [], []
            old_spans, old_items = batch.column(names.index("__spans")), batch.column(names.index("__items"))
            for k in range(len(batch)):
                a, b = cut[at + k], cut[at + k + 1]
                before, had = old_spans[k].as_py(), old_items[k].as_py()
                if a == b:
                    spans.append(before)
                    hit.append(had)
                    continue
                old = np.array(before, np.int64).reshape(-1, 2)
                s = np.concatenate((old[:, 0], place[a:b]))
                e = np.concatenate((old[:, 1], place[a:b] + phrases["lengths"][phrase[a:b]]))
                spans.append(merge(s, e).tolist())
                first, item = phrases["first"], phrases["item"]
                own = {int(i) for p in np.unique(phrase[a:b]) for i in item[first[p] : first[p + 1]]}
                hit.append(sorted({phrases["names"][i] for i in own} | set(had)))
            new = {
                "__n_words": pa.array(n_words[at : at + len(batch)], pa.int64()),
                "__spans": pa.array(spans, pa.list_(pa.int64())),
                "__items": pa.array(hit, pa.list_(pa.string())),
            }
            at += len(batch)
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(i)) for i, c in enumerate(names)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        rows, hashes, sizes, held = [], [], [], 0
        for batch, texts in slabs(batches):
            h, bounds = word_hashes(texts, LETTERS, powers)
            rows.append(batch)
            hashes.append(h)
            sizes.append(np.diff(bounds))
            held += len(h)
            if held >= SHARD_WORDS:
                yield from annotate(rows, hashes, sizes)
                rows, hashes, sizes, held = [], [], [], 0
        if rows:
            yield from annotate(rows, hashes, sizes)

    return docs.mapInArrow(run, docs.schema)


def scan(docs: DataFrame, benchmark: DataFrame, columns: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The given columns of docs (default: all), with __n_words, __spans (word numbers) and __items (sorted ids)."""
    columns = columns or docs.columns
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first().b  # one number
    blocks = max(1, -(-int(total) // block_bytes))
    kept = list(dict.fromkeys([*columns, "text"]))
    out = docs.select(
        *kept,
        F.lit(0).cast(T.LongType()).alias("__n_words"),
        F.array().cast("array<long>").alias("__spans"),
        F.array().cast("array<string>").alias("__items"),
    )
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == block).distinct()
        out = _pass(out, [(r.name, r.text) for r in part.collect()])  # about block_bytes
    return out.select(*columns, "__n_words", "__spans", "__items")


def _hits() -> Column:
    pairs = F.sequence(F.lit(0), F.size("__spans") - 2, F.lit(2))
    total = F.aggregate(pairs, F.lit(0).cast("long"), lambda acc, i: acc + F.get("__spans", i + 1) - F.get("__spans", i))
    return F.when(F.size("__spans") > 0, total).otherwise(F.lit(0).cast("long"))


def contaminated(share: int = SHARE) -> Column:
    return (_hits() > 0) & (_hits() * share >= F.col("__n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns, and the merged spans as flat word numbers."""
    return scan(docs, benchmark, ["doc_id", "text"]).select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        _hits().alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
        F.array_join("__spans", ",").alias("spans"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, as they were."""
    columns = docs.columns
    return scan(docs, benchmark).where(~contaminated()).select(*columns)


def cut_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All documents, every removal span taken out of its text together with what stands between its words."""
    columns = docs.columns
    # Pieces that begin with a word; the piece before the first word stays.
    lead = F.regexp_extract("text", r"^[\x00-/:-@\[-`{-\x7F]*+", 0)
    pieces = F.regexp_extract_all("text", F.lit(r"[^\x00-/:-@\[-`{-\x7F]++[\x00-/:-@\[-`{-\x7F]*+"), F.lit(0))
    inside = lambda i: F.exists(
        F.sequence(F.lit(0), F.size("__spans") - 2, F.lit(2)), lambda k: (F.get("__spans", k) <= i) & (i < F.get("__spans", k + 1))
    )
    rest = F.concat(lead, F.array_join(F.filter(pieces, lambda x, i: ~inside(i)), ""))
    done = scan(docs, benchmark).withColumn("text", F.when(F.size("__spans") > 0, rest).otherwise(F.col("text")))
    return done.select(*columns)
