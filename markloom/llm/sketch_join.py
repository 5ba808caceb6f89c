"""MinHash near-dedup by bottom-k sketches from one hash function.

1. A pass turns each text into its set of word shingles, hashed by one function, and retains the ``K`` smallest values: the
   bottom-k sketch. Equal sets are one set from here on.
2. Inverted lists: sets are dealt out by retained value, and each list learns its length. A value of one set only goes.
   Alike sets share at least ``least_shared`` retained values, so they share one of the rarest
   ``size - least_shared + 1`` of either; only those stay in the index, frequent passages mostly don't.
3. Overlaps: in each list, every set meets the list's centre of its size class (the one whose values are in most other sets). Pairs
   are estimated first: the smallest ``K`` values of both sketches together are the union's sketch, and the share of them
   that both sets hold estimates the similarity. What passes is verified by Jaccard on the full sets.
4. Sets of one list that are still in different components meet each other, unless their distances to their common
   centre differ by more than alike sets' can (Jaccard distance keeps the triangle inequality), or parity signatures
   of the full sets (two sets differ in at least as many shingles as their signatures in bits) rule them out.
5. Components of all verified links.

``least_shared`` is exact for sets of up to ``4 * (K - BOUND)`` shingles. For larger ones it is the quantile of the number
of common values among ``K`` random ones of the union that a pair of the least similarity misses with a chance below
1e-12. The estimate filter uses the same bound; where both sketches hold whole sets it is the similarity itself.

Values that a sample of the sketches shows in very many sets count as equally frequent and are dealt out by set, so no task
gets the list of a passage that a third of all documents share; which values these are changes only the work.

Defined results: null and empty texts have no shingles and link with nothing; fewer than four words are one shingle;
equal rows are linked like other copies; a null doc_id takes part, is the last choice as a component's id, and is kept if
it is that; an empty table gives an empty one; other columns are ignored, or carried along by ``drop_near_duplicates``.
Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import through_table
from .components import components
from .keyed import arrays, bounds, joined, record_batch, taken
from .words import NOT_SPACE, Powers, lists, mix, slabs, word_hashes

SHINGLE = 4
#: Percent of the union that the intersection must reach.
ALIKE = 80
#: Retained values of a set.
K = 192
#: The most common values among K of the union that a pair of similarity ALIKE has with a chance of all but 1e-12.
MISSED = 1e-12
#: One sketch of so many is looked at for very frequent values, and those in this share of them are such.
SAMPLED, FREQUENT = 64, 1 / 256
#: Stands for the list length of very frequent values.
VERY = (1 << 31) - 1
#: Bits of the filter that says which full sets are asked for.
FILTER_BITS = 1 << 22
#: Bits of the parity signature, in numbers of 64.
WORDS = 16
_COEFF = mix(np.arange(11, SHINGLE + 12, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)) | np.uint64(1)


def _bound() -> int:
    chance, q = 0.0, 0
    while (chance := chance + comb(K, q) * (ALIKE / 100) ** q * (1 - ALIKE / 100) ** (K - q)) <= MISSED:
        q += 1
    return q


BOUND = _bound()


def least_shared(n: Column) -> Column:
    """Retained values that a set of n shingles shares with any set like it.

    Both sets' union has at most n / 0.8 shingles, of which at most n / 4 are not in both.
    """
    differ = F.floor(n * (100 - ALIKE) / ALIKE)
    whole = F.least(F.ceil(n * ALIKE / 100), K - differ)
    return F.when(n <= K, whole).otherwise(F.greatest(F.lit(BOUND), K - differ))


def shingle_sets(texts: list[bytes], powers: Powers) -> list[np.ndarray]:
    """The distinct shingles of each text, ascending."""
    hashes, begin = word_hashes(texts, NOT_SPACE, powers)
    rolled = np.zeros(0, np.uint64)
    if len(hashes) >= SHINGLE:
        n = len(hashes) - SHINGLE + 1
        rolled = hashes[:n] * _COEFF[0]
        for k in range(1, SHINGLE):
            rolled += hashes[k : n + k] * _COEFF[k]
        rolled = mix(rolled + _COEFF[SHINGLE])
    out = []
    for lo, hi in zip(begin[:-1], begin[1:]):
        if hi - lo >= SHINGLE:
            out.append(np.unique(rolled[lo : hi - SHINGLE + 1]))
        elif hi > lo:
            out.append(mix((hashes[lo:hi] * _COEFF[: hi - lo]).sum(keepdims=True) + _COEFF[hi - lo]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def identity(values: np.ndarray) -> int:
    """One number per set."""
    size = np.full(1, len(values), np.uint64) * _COEFF[2]
    return int(mix(mix(values ^ _COEFF[1]).sum(keepdims=True) ^ size).view(np.int64)[0])


def signature(values: np.ndarray) -> np.ndarray:
    """Bit j says whether an odd number of values falls on j."""
    odd = np.bincount((values >> np.uint64(7) & np.uint64(64 * WORDS - 1)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _describe(docs: DataFrame) -> DataFrame:
    """doc_id, tkey, sid and n of every document; sketch and signature once for equal sets that lie together."""
    fields = [T.StructField("sid", T.LongType()), T.StructField("n", T.IntegerType()), *(T.StructField(c, T.ArrayType(T.LongType())) for c in ("sketch", "sig"))]
    schema = T.StructType([docs.schema["doc_id"], T.StructField("tkey", T.LongType()), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch, texts in slabs(batches):
            made = shingle_sets(texts, powers)
            sid = np.array([identity(s) for s in made], np.int64)
            n = np.array([len(s) for s in made], np.int32)
            new = np.zeros(len(sid), bool)
            new[np.unique(sid, return_index=True)[1]] = True
            new &= n > 0
            kept = [s[:K] if f else s[:0] for s, f in zip(made, new)]
            ends = np.concatenate(([0], np.cumsum([len(s) for s in kept]))).astype(np.int32)
            values = np.concatenate(kept).view(np.int64)
            sketch = pa.ListArray.from_arrays(pa.array(ends, mask=np.append(~new, False)), pa.array(values))
            bits = np.concatenate([signature(s) for s, f in zip(made, new) if f] or [np.zeros(0, np.int64)])
            steps = np.concatenate(([0], np.cumsum(new))).astype(np.int32) * WORDS
            sig = pa.ListArray.from_arrays(pa.array(steps, mask=np.append(~new, False)), pa.array(bits))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sid), pa.array(n), sketch, sig], names=schema.names)

    return docs.select("doc_id", F.xxhash64("text").alias("tkey"), "text").mapInArrow(run, schema)


def _entries(sets: DataFrame) -> DataFrame:
    """(value, sid, n, class, score): index entries of sets that may be like another one.

    The score is the mean length of the lists a set is in: an original that many near copies were made from shares
    all its values with most of them, each copy lacks some.
    """
    sample = sets.where(F.pmod("sid", F.lit(SAMPLED)) == 0)
    often = sample.select(F.explode("sketch").alias("value")).groupBy("value").count()
    size = sample.agg((F.count("*") * FREQUENT).alias("size"))
    # At most K / FREQUENT values: every set of the sample counts K values at most.
    often = through_table(often.join(F.broadcast(size), F.col("count") > F.greatest("size", F.lit(16))).select("value"), "frequent")
    often = F.broadcast(often.withColumn("very", F.lit(True)))
    all_ = sets.select("sid", "n", F.explode("sketch").alias("value")).join(often, "value", "left")
    # Very frequent values are dealt out by set: their length is not asked for.
    count = F.count("*").over(Window.partitionBy("value", F.when(F.col("very"), F.col("sid"))))
    length = F.when(F.col("very"), F.lit(VERY).cast("long")).otherwise(count)
    shared = all_.select("sid", "n", "value", length.alias("length")).where("length > 1")
    # Rarest values first. Those that no other set has would come before them.
    held = F.array_sort(F.collect_list(F.struct("length", "value")))  # K at most
    score = F.sum("length") / F.least(F.first("n"), F.lit(K))
    grouped = shared.groupBy("sid").agg(F.first("n").alias("n"), held.alias("held"), score.alias("score"))
    take = F.size("held") - least_shared(F.col("n")) + 1
    chosen = grouped.where(take > 0).select("sid", "n", "score", F.explode(F.slice("held", 1, take.cast("int"))).alias("e"))
    group = F.floor(F.log("n") / float(np.log(100 / ALIKE))).cast("int")
    return chosen.select(F.col("e.value").alias("value"), "sid", "n", group.alias("class"), "score")


def _estimated(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sketches say they may be alike."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    # The upper halves keep the order of the values, unsigned; equal ones can only add to an estimate.
    known = sets.join(asked, "sid").select("sid", "n", F.transform("sketch", lambda v: F.shiftrightunsigned(v, 32)).alias("sketch"))
    side = lambda x: known.select(F.col("sid").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    union = F.array_sort(F.array_union("s_a", "s_b"))
    common = F.array_intersect("s_a", "s_b")
    whole = F.greatest("n_a", "n_b") <= K
    exact = (F.size(common) + 2) * 100 >= (F.size(union) - 2) * ALIKE  # but for halves that are equal by chance
    drawn = F.size(F.array_intersect(F.slice(union, 1, K), common)) >= BOUND
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * ALIKE
    return both.where(fits & F.when(whole, exact).otherwise(drawn)).select("a", "b")


def _full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sid, items) of the sets that are asked for, and of a few more."""
    bit = F.pmod("sid", F.lit(FILTER_BITS)).cast("int")
    marks = wanted.select(F.shiftright(bit, 15).alias("block"), bit.bitwiseAND(32767).alias("bit"))
    parts = marks.groupBy("block").agg(F.expr("bitmap_construct_agg(bit)").alias("bits")).collect()  # at most 128 rows of 4 KB
    table = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in parts:
        part = np.frombuffer(bytes(r.bits), np.uint8)
        table[r.block * 4096 : r.block * 4096 + len(part)] = part
    asked = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, open_ = Powers(), np.unpackbits(asked.value, bitorder="little").astype(bool)
        for _, texts in slabs(batches):
            found = {}
            for s in shingle_sets(texts, powers):
                if len(s) and open_[(sid := identity(s)) % FILTER_BITS]:
                    found[sid] = s
            if found:
                ends = np.concatenate(([0], np.cumsum([len(s) for s in found.values()])))
                items = lists(np.concatenate(list(found.values())).view(np.int64), ends)
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), items], names=["sid", "items"])

    return docs.select("text").mapInArrow(run, "sid long, items array<long>").dropDuplicates(["sid"])


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b, apart, linked) of the pairs: Jaccard distance of the full sets, and whether they are alike."""
    pairs = through_table(pairs, "candidates")
    # Dealt out by sid once for both sides of the join.
    sets = _full_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct())
    side = lambda x: sets.select(F.col("sid").alias(x), F.col("items").alias(f"i_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.select("a", "b", F.size("i_a").alias("x"), F.size("i_b").alias("y"), F.size(F.array_intersect("i_a", "i_b")).alias("o"))
    union = F.col("x") + F.col("y") - F.col("o")
    return through_table(both.select("a", "b", (1 - F.col("o") / union).alias("apart"), (F.col("o") * 100 >= union * ALIKE).alias("linked")), "verified")


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
#: Pairs that are looked at together.
_BLOCK = 1 << 18


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by value and size: pairs of fitting sizes in different components, not too differently far from their centre."""
    held = None
    for batch in batches:
        if not len(batch):
            continue
        c, fresh = arrays(batch), 0
        if held is not None and held["value"][-1] == c["value"][0]:
            fresh = len(held["value"])
            c = joined([held, c])
        value, n, sid, comp = c["value"], c["n"].astype(np.int64), c["sid"], c["comp"]
        centre, apart = c["centre"], c["apart"]
        sig = np.array([c[f"s{k}"] for k in range(WORDS)]).view(np.uint64)
        at = bounds(value)
        begin = np.repeat(at[:-1], np.diff(at))
        # Sizes ascend: only the sets before a set, from the first that is large enough.
        step = np.zeros(len(value), np.int64)
        for lo, hi in zip(at[:-1], at[1:]):
            step[lo:hi] = lo + np.searchsorted(n[lo:hi] * 100, n[lo:hi] * ALIKE, "left")
        count = np.arange(len(value)) - np.maximum(step, begin)
        count[:fresh] = 0
        total = np.cumsum(count)
        x0 = 0
        while x0 < len(value):
            x1 = max(x0 + 1, int(np.searchsorted(total, (total[x0 - 1] if x0 else 0) + _BLOCK, "right")))
            k = count[x0:x1]
            x = np.repeat(np.arange(x0, x1), k)
            y = np.repeat(np.arange(x0, x1) - k, k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            near = ~((centre[x] == centre[y]) & (np.abs(apart[x] - apart[y]) > 1 - ALIKE / 100 + 1e-9))
            keep = near & (comp[x] != comp[y])
            x, y = x[keep], y[keep]
            # |x & y| is at most (|x| + |y| - differing bits) / 2, and at least ALIKE / (100 + ALIKE) of both sizes.
            most = n[x] + n[y] - np.bitwise_count(sig[:, x] ^ sig[:, y]).sum(0, dtype=np.int64)
            keep = most * (100 + ALIKE) >= 2 * ALIKE * (n[x] + n[y])
            if keep.any():
                a, b = sid[x[keep]], sid[y[keep]]
                both = np.unique(np.column_stack([np.minimum(a, b), np.maximum(a, b)]), axis=0)
                yield record_batch({"a": both[:, 0], "b": both[:, 1]}, _PAIRS)
            x0 = x1
        lo = int(np.searchsorted(value, value[-1], "left"))
        held = taken(c, slice(lo + int(np.searchsorted(n[lo:] * 100, int(n[-1]) * ALIKE, "left")), None))


def _links(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, comp) of the sets that are linked with another one."""
    entries = through_table(_entries(sets), "entries")
    centres = entries.groupBy("value", "class").agg(F.max(F.struct("score", "sid")).alias("c"))
    centres = centres.select("value", "class", F.col("c.sid").alias("centre"))
    placed = through_table(entries.drop("score").join(centres, ["value", "class"]), "placed")
    pair = F.least("sid", "centre").alias("a"), F.greatest("sid", "centre").alias("b")
    stars = placed.where("sid <> centre").select(*pair).distinct()
    first = _verified(_estimated(stars, sets), docs)
    links = first.where("linked").select("a", "b")
    found = components(links)
    own = found.select(F.col("node").alias("sid"), "comp")
    far = first.select("a", "b", "apart")
    entry = placed.select("value", "sid", "n", "centre", *pair).join(own, "sid", "left").join(far, ["a", "b"], "left")
    apart = F.when(F.col("sid") == F.col("centre"), F.lit(0.0)).otherwise(F.coalesce("apart", F.lit(float("nan"))))
    entry = entry.select("value", "sid", "n", "centre", F.coalesce("comp", "sid").alias("comp"), apart.alias("apart"))
    # Lists whose sets are all in one component are done.
    entry = through_table(entry, "rest")
    several = entry.groupBy("value").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("value")
    signed = sets.select("sid", *(F.col("sig")[k].alias(f"s{k}") for k in range(WORDS)))
    open_ = entry.join(several, "value").join(signed, "sid").repartition("value").sortWithinPartitions("value", "n", "sid")
    pairs = open_.mapInArrow(_across, "a long, b long").distinct()
    second = _estimated(through_table(pairs, "across"), sets)
    more = _verified(second, docs).where("linked").select("a", "b")
    return found if more.isEmpty() else components(links.union(more))


def _classes(docs: DataFrame) -> DataFrame:
    """doc_id, tkey, n and first: the least (doc_id, tkey) of the component, the document itself without shingles."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    described = through_table(_describe(docs), "sketches")
    some = described.where("n > 0").groupBy("sid").agg(F.first("n").alias("n"), *(F.first(c, True).alias(c) for c in ("sketch", "sig")))
    sets = through_table(some, "sets")
    linked = _links(docs, sets)
    rows = described.select("doc_id", "tkey", "sid", "n")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tkey")
    heads = rows.where("n > 0").groupBy("sid").agg(F.min(key).alias("first"))
    heads = heads.join(linked.withColumnRenamed("node", "sid"), "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    least = heads.groupBy("comp").agg(F.min("first").alias("least"))
    heads = heads.join(least, "comp").select("sid", "least")
    own = F.when(F.col("n") > 0, F.col("least")).otherwise(key)
    return rows.join(heads, "sid", "left").select("doc_id", "tkey", "n", own.alias("first"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """The contract's columns: doc_id, n_shingles, component_id, kept."""
    made = _classes(docs).select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("first.doc_id").alias("component_id"))
    return made.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents without those that a document of a smaller id in their component stands for; equal rows are one."""
    classes = _classes(docs)
    kept = classes.where(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tkey") == F.col("first.tkey")))
    kept = kept.select(F.col("doc_id").alias("__id"), F.col("tkey").alias("__tkey")).distinct()
    keyed = docs.withColumn("__key", F.xxhash64(F.coalesce("text", F.lit(""))))
    out = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__tkey")))
    return out.dropDuplicates(["doc_id", "__key"]).select(*docs.columns)
