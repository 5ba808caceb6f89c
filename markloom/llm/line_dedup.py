"""Line dedup by a segment-partition edit join: a line goes when an earlier one is at most ``EDITS`` edits away.

Lines are compared without white space around them, by code points. Lines of ``EXACT`` to ``NEAR - 1`` code
points go when an equal line stands earlier, longer ones also when a similar one does; shorter ones always stay.
Earlier means a smaller (doc_id, line number); the first of equal lines stands for all.

1. Lines of at least ``NEAR`` code points are cut into ``EDITS + 1`` segments. One of them is untouched by the
   edits between two similar lines, so a line probes the segments of lines that are up to ``EDITS`` shorter,
   at the few places where an alignment with that many edits can put them (length-aware substring index).
2. Keys are dealt out once; a task streams through them. Lists that would make many pairs are split again:
   edits change at most ``2 * EDITS`` of ``2 * EDITS + 1`` groups of characters, so similar lines agree in
   the count of some group; parity signatures of their character pairs tell most of the rest apart.
3. Pairs are verified by a bit-parallel automaton of width ``2 * EDITS + 1`` along the diagonal.

What is shuffled is hashes, the texts of candidate lines, and each document once for its clean text.

Defined results: null and empty texts have one empty line, which stays; equal rows are one document, each
gets the same result; null doc_ids come after all others; an empty table gives an empty one; a document may
lose all its lines and is then the empty text; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import through_table
from .keyed import bounds, record_batch, taken, whole_groups
from .words import Powers, byte_class, mix, run_hashes, running, slabs, sum_hashes

EDITS = 2
EXACT, NEAR = 20, 40
#: Pairs that a list may make before it is split by character counts.
LIST_PAIRS = 32
FILTER_BITS = 1 << 22
_SECOND = 0xD1B54A32D192ED03
_SPACE = np.concatenate((byte_class(b" \t\x0b\x0c\r")[:128], np.zeros(1, bool)))


class Lines:
    """All lines of some texts: code points, where each begins and ends without white space, its text."""

    def __init__(self, texts: list[bytes]):
        self.codes = np.frombuffer(b"\n".join(texts).decode().encode("utf-32-le"), np.uint32)
        breaks = np.flatnonzero(self.codes == 10)
        start = np.concatenate(([0], breaks + 1)) if texts else np.zeros(0, np.int64)
        end = np.concatenate((breaks, [len(self.codes)])) if texts else np.zeros(0, np.int64)
        inside = np.flatnonzero(~_SPACE[np.minimum(self.codes, 128)] & (self.codes != 10))
        a, b = np.searchsorted(inside, start), np.searchsorted(inside, end)
        some = b > a
        self.start, self.end = start.copy(), start.copy()
        self.start[some], self.end[some] = inside[a[some]], inside[b[some] - 1] + 1
        self.size = self.end - self.start
        counts = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
        self.doc = np.repeat(np.arange(len(texts)), counts)
        self.number = np.arange(len(self.doc)) - np.repeat(np.cumsum(counts) - counts, counts)


def _occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, tkey, line, size, h, g): every line of at least EXACT code points, with two hashes."""
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("tkey", T.LongType()), T.StructField("line", T.IntegerType()),
        T.StructField("size", T.IntegerType()), T.StructField("h", T.LongType()), T.StructField("g", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = Powers(), Powers(_SECOND)
        for batch, texts in slabs(batches):
            lines = Lines(texts)
            at = np.flatnonzero(lines.size >= EXACT)
            h = run_hashes(lines.codes, lines.start[at], lines.end[at], one).view(np.int64)
            g = run_hashes(lines.codes, lines.start[at], lines.end[at], two).view(np.int64)
            doc = pa.array(lines.doc[at])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(doc), batch.column(1).take(doc), pa.array(lines.number[at], pa.int32()),
                    pa.array(lines.size[at], pa.int32()), pa.array(h), pa.array(g),
                ],
                names=schema.names,
            )

    return docs.select("doc_id", "tkey", "text").mapInArrow(run, schema)


def segment(size: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of segment i of lines of a size: EDITS + 1 segments, the last ones longer by one."""
    k = EDITS + 1
    base, longer = size // k, size % k
    return i * base + np.maximum(0, i - (k - longer)), base + (i >= k - longer)


def shifts(i: int, shorter: int) -> range:
    """Where segment i of a line that is ``shorter`` by so much may stand in a line, relative to its own place."""
    return range(max(-i, shorter - (EDITS - i)), min(i, shorter + (EDITS - i)) + 1)


_KEYS = pa.schema([("key", pa.int64()), ("h", pa.int64())])


def _keyed(key: np.ndarray, probe: np.ndarray | bool) -> np.ndarray:
    """A key whose lowest bit is set for probes, so that one number sorts a list's entries before its probes."""
    return ((key & ~np.uint64(1)) | np.asarray(probe).astype(np.uint64)).view(np.int64)


def _dealt(rows: DataFrame) -> DataFrame:
    """Entries and probes of one list in one task, in order."""
    return rows.repartition(F.shiftright("key", 1)).sortWithinPartitions("key")


def _keys(docs: DataFrame) -> DataFrame:
    """(key, h): index entries and probes of every line of at least NEAR code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for _, texts in slabs(batches):
            lines = Lines(texts)
            at = np.flatnonzero(lines.size >= NEAR)
            total = running(lines.codes, powers)
            h = sum_hashes(total, lines.start[at], lines.end[at], powers).view(np.int64)
            h, once = np.unique(h, return_index=True)
            at = at[once]
            start, size = lines.start[at], lines.size[at]
            for shorter in range(EDITS + 1):
                fits = size - shorter >= NEAR
                for i in range(EDITS + 1):
                    place, length = segment(size - shorter, i)
                    for shift in shifts(i, shorter):
                        ok = fits & (place + shift >= 0) & (place + shift + length <= size)
                        a = (start + place + shift)[ok]
                        key = sum_hashes(total, a, a + length[ok], powers)
                        tag = mix((size[ok] - shorter).astype(np.uint64) * np.uint64(EDITS + 1) + np.uint64(i))
                        # Without a shift, an entry of the index is its own probe.
                        key = _keyed(mix(key ^ tag), bool(shorter or shift))
                        yield record_batch({"key": key, "h": h[ok]}, _KEYS)

    return docs.select("text").mapInArrow(run, "key long, h long")


_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("probe", pa.bool_())])


def _pairs(c: dict[str, np.ndarray], own: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows inside ``own`` and between it and ``others``, without those that signatures rule out."""
    i, j = np.triu_indices(len(own), 1)
    i = np.concatenate((own[i], np.repeat(own, len(others))))
    j = np.concatenate((own[j], np.tile(others, len(own))))
    open_ = c["h"][i] != c["h"][j]
    if "s0" in c:
        differ = np.bitwise_count(c["s0"][i] ^ c["s0"][j]) + np.bitwise_count(c["s1"][i] ^ c["s1"][j])
        open_ &= differ <= 4 * EDITS
    a, b = c["h"][i[open_]], c["h"][j[open_]]
    return np.minimum(a, b), np.maximum(a, b)


def _found(pairs: list) -> pa.RecordBatch:
    found = np.unique(np.concatenate([np.column_stack(p) for p in pairs]), axis=0)
    none = [pa.nulls(len(found), pa.int64()), pa.nulls(len(found), pa.bool_())]
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1]), *none], schema=_FOUND)


def _meet(limit: int | None):
    """Pairs of each list of rows sorted by key; lists of more pairs as (a, key, probe), b null."""

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column(0).to_numpy()
            rest = [batch.column(i) for i in range(1, batch.num_columns)]
            columns = [pa.array(both & ~np.int64(1)), pa.array((both & 1).astype(bool)), *rest]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "probe", *batch.schema.names[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in whole_groups(unpacked(batches), "key"):
            at = bounds(c["key"])
            entries = np.add.reduceat((~c["probe"]).astype(np.int64), at[:-1])
            # Most lists are a single row, or have no entry of the index.
            some = np.repeat((entries > 0) & (np.diff(at) > 1), np.diff(at))
            if not some.any():
                continue
            c = taken(c, some)
            c = taken(c, np.lexsort((c["h"], c["probe"], c["key"])))
            new = np.ones(len(c["key"]), bool)
            new[1:] = (c["key"][1:] != c["key"][:-1]) | (c["h"][1:] != c["h"][:-1]) | (c["probe"][1:] != c["probe"][:-1])
            c = taken(c, new)
            if "s0" in c:
                c |= {k: c[k].view(np.uint64) for k in ("s0", "s1")}
            at = bounds(c["key"])
            entries = np.add.reduceat((~c["probe"]).astype(np.int64), at[:-1])
            size = np.diff(at)
            pairs, large, made = [], [], 0
            for k in np.flatnonzero((entries > 0) & (size > 1)):
                lo, mid, hi = at[k], at[k] + entries[k], at[k + 1]
                if limit is not None and entries[k] * (hi - lo) > limit:
                    large.append(np.arange(lo, hi))
                    continue
                # A long list is paired a few entries at a time.
                step = max(1, 100_000 // int(hi - lo))
                for e in range(lo, mid, step):
                    pairs.append(_pairs(c, np.arange(e, min(mid, e + step)), np.arange(min(mid, e + step), hi)))
                    made += len(pairs[-1][0])
                    if made > 100_000:
                        yield _found(pairs)
                        pairs, made = [], 0
            if pairs:
                yield _found(pairs)
            if large:
                rows = taken(c, np.concatenate(large))
                none = pa.nulls(len(rows["h"]), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(rows["h"]), none, pa.array(rows["key"]), pa.array(rows["probe"], pa.bool_())], schema=_FOUND)

    return run


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, g, value) of the lines whose h is wanted, and of a few more."""
    bit = F.col("h").bitwiseAND(FILTER_BITS - 1)
    rows = wanted.select(F.shiftright(bit, 15).alias("block"), bit.bitwiseAND(32767).alias("bit"))
    blocks = rows.groupBy("block").agg(F.expr("bitmap_construct_agg(bit)").alias("bits")).collect()  # at most 128 rows of 4 KB
    table = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in blocks:
        part = np.frombuffer(bytes(r.bits), np.uint8)
        table[r.block * 4096 : r.block * 4096 + len(part)] = part
    asked = docs.sparkSession.sparkContext.broadcast(np.unpackbits(table, bitorder="little").astype(bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = Powers(), Powers(_SECOND)
        for _, texts in slabs(batches):
            lines = Lines(texts)
            at = np.flatnonzero(lines.size >= NEAR)
            h = run_hashes(lines.codes, lines.start[at], lines.end[at], one).view(np.int64)
            h, once = np.unique(h, return_index=True)
            hit = asked.value[h & (FILTER_BITS - 1)]
            h, at = h[hit], at[once][hit]
            if len(h):
                g = run_hashes(lines.codes, lines.start[at], lines.end[at], two).view(np.int64)
                value = [lines.codes[a:b].tobytes().decode("utf-32-le") for a, b in zip(lines.start[at], lines.end[at])]
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(g), pa.array(value)], names=["h", "g", "value"])

    return docs.select("text").mapInArrow(run, "h long, g long, value string").dropDuplicates(["h", "g"])


def _split(rows: DataFrame) -> DataFrame:
    """Rows (key, h, probe, value) once per group of characters, as (key, h) keyed by that group's counts too, and signed.

    The signature (s0, s1) says which of 128 classes an odd number of the line's character pairs falls on. An
    edit takes away two of those pairs at most and adds two, so it changes four bits at most.
    """
    groups = 2 * EDITS + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(3).to_pylist()
            codes = np.frombuffer("".join(values).encode("utf-32-le"), np.uint32)
            sizes = np.array([len(v) for v in values], np.int64)
            begin = np.concatenate(([0], np.cumsum(sizes)))
            owner = np.repeat(np.arange(len(values)), sizes)
            inner = owner[1:] == owner[:-1]
            pair = (mix((codes[:-1].astype(np.uint64) << np.uint64(32)) | codes[1:]) & np.uint64(127)).astype(np.int64)
            odd = np.bincount((owner[:-1] * 128 + pair)[inner], minlength=len(values) * 128).astype(np.uint8) & 1
            sign = np.packbits(odd.reshape(-1, 128), axis=1, bitorder="little").view(np.int64)
            probe = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            kind, weight = codes % groups, mix(codes.astype(np.uint64) + np.uint64(1))
            for g in range(groups):
                total = np.concatenate(([np.uint64(0)], np.cumsum(np.where(kind == g, weight, np.uint64(0)))))
                counts = total[begin[1:]] - total[begin[:-1]]
                key = mix(batch.column(0).to_numpy().view(np.uint64) ^ mix(counts + np.uint64(g)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_keyed(key, probe)), batch.column(1), pa.array(sign[:, 0].copy()), pa.array(sign[:, 1].copy())],
                    names=["key", "h", "s0", "s1"],
                )

    return rows.mapInArrow(run, "key long, h long, s0 long, s1 long")


def within(a: str, b: str, edits: int = EDITS) -> bool:
    """Whether two lines are at most so many edits apart: one small bit set of diagonals per number of edits."""
    if abs(len(a) - len(b)) > edits:
        return False
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << 2 * edits + 1) - 1
    # Bit x of state d: len(prefix of a) - len(prefix of b) = x - edits is reached with d edits.
    state = [((1 << d + 1) - 1) << edits & full for d in range(edits + 1)]
    for j, c in enumerate(b):
        mask = masks.get(c, 0)
        same = (mask >> j - edits if j >= edits else mask << edits - j) & full
        before = state[0]
        state[0] &= same
        for d in range(1, edits + 1):
            now = state[d]
            state[d] = ((now & same) | before >> 1 | before | state[d - 1] << 1) & full
            before = now
        if not state[edits]:
            return False
    return bool(state[edits] >> len(a) - len(b) + edits & 1)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [within(x, y) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in range(4)], names=["h", "g", "to_h", "to_g"])


def similar_lines(docs: DataFrame) -> DataFrame:
    """(h, g, to_h, to_g): different lines of at least NEAR code points that are at most EDITS edits apart."""
    found = through_table(_dealt(_keys(docs)).mapInArrow(_meet(LIST_PAIRS), "a long, b long, key long, probe boolean"), "lines")
    wanted = found.select(F.explode(F.array("a", "b")).alias("h")).where("h is not null").distinct()
    texts = through_table(_texts(docs, wanted), "texts")
    pairs = found.where("b is not null").select("a", "b")
    large = found.where("b is null").select("key", F.col("a").alias("h"), "probe")
    if not large.isEmpty():
        fine = _split(large.join(texts.select("h", "value"), "h").select("key", "h", "probe", "value"))
        pairs = pairs.union(_dealt(fine).mapInArrow(_meet(None), "a long, b long, key long, probe boolean").select("a", "b"))
    side = lambda x: texts.select(F.col("h").alias(x), F.col("g").alias(f"g_{x}"), F.col("value").alias(f"v_{x}"))
    both = pairs.distinct().join(side("a"), "a").join(side("b"), "b").select("a", "g_a", "b", "g_b", "v_a", "v_b")
    return both.mapInArrow(_verify, "h long, g long, to_h long, to_g long")


def _gone(docs: DataFrame) -> DataFrame:
    """(id, key, gone): the numbers of the lines that go, for the documents that lose any."""
    lines = through_table(_occurrences(docs), "occurrences")
    where = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tkey", "line")
    classes = through_table(lines.groupBy("h", "g").agg(F.min(where).alias("first"), F.count("*").alias("n")), "classes")
    links = through_table(similar_lines(docs), "similar")
    ends = lambda h, g, x: classes.select(F.col("h").alias(h), F.col("g").alias(g), F.col("first").alias(x))
    placed = links.join(ends("h", "g", "one"), ["h", "g"]).join(ends("to_h", "to_g", "two"), ["to_h", "to_g"])
    later = F.col("one") > F.col("two")
    behind = placed.select(
        F.when(later, F.col("h")).otherwise(F.col("to_h")).alias("h"), F.when(later, F.col("g")).otherwise(F.col("to_g")).alias("g")
    ).distinct().withColumn("behind", F.lit(True))
    heads = classes.join(behind, ["h", "g"], "left").where("n > 1 or behind")
    drop = F.coalesce("behind", F.lit(False)) | (where != F.col("first"))
    gone = lines.join(heads, ["h", "g"]).where(drop)
    return gone.groupBy(F.col("doc_id").alias("id"), F.col("tkey").alias("key")).agg(F.sort_array(F.collect_set("line")).alias("gone"))


def clean_lines(docs: DataFrame) -> DataFrame:
    """All columns, ``text`` without the lines that go, and __lines (their number before) and __gone (which went)."""
    keyed = docs.withColumn("tkey__", F.xxhash64(F.coalesce("text", F.lit(""))))
    plain = keyed.select("doc_id", F.col("tkey__").alias("tkey"), F.coalesce("text", F.lit("")).alias("text"))
    gone = _gone(plain).select(F.col("id").alias("__id"), F.col("key").alias("__key"), F.col("gone").alias("__gone"))
    joined = keyed.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("tkey__") == F.col("__key")), "left")
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("__gone", i)), "\n")
    return joined.select(
        *[F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept).alias("text") if c == "text" else F.col(c) for c in docs.columns],
        F.size(lines).alias("__lines"),
        F.coalesce("__gone", F.array().cast("array<int>")).alias("__gone"),
    )


def line_report(docs: DataFrame) -> DataFrame:
    """One row per document: n_lines, n_gone, gone (line numbers from 0, comma-joined) and the clean text."""
    done = clean_lines(docs.select("doc_id", "text"))
    return done.select(
        "doc_id", F.col("__lines").cast("long").alias("n_lines"), F.size("__gone").cast("long").alias("n_gone"),
        F.array_join(F.col("__gone").cast("array<string>"), ",").alias("gone"), F.coalesce("text", F.lit("")).alias("text"),
    )


#: What a line holds that is text: a letter or a digit.
WORD = r"[\p{L}\p{N}]"


def drop_repeated(docs: DataFrame) -> DataFrame:
    """The documents with clean texts and their n_chars, without those that lost lines and have no word left."""
    done = clean_lines(docs)
    stays = (F.size("__gone") == 0) | F.col("text").rlike(WORD)
    chars = lambda c: F.when(F.size("__gone") > 0, F.length("text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c)
    return done.where(stays).select(*[chars(c) if c == "n_chars" else F.col(c) for c in docs.columns])
