"""N-gram Jaccard join with set-relation skipping: documents whose sets of word shingles are 80 % alike.

1. One pass turns each text into its set of shingle hashes and writes the set's identity and size.
   Equal sets are one set from here on. The same pass counts shingles that repeat inside a task; the sums
   go into a table of ``BUCKETS`` levels that puts frequent shingles last in the order of all shingles. Any
   order gives the same result, this one keeps frequent shingles out of the index.
2. Index lists: by the prefix filter, two sets that are alike share one of their first
   ``n - ceil(0.8 n) + 1`` shingles. Those are dealt out by shingle. Lists with one set are dropped.
3. First answers: in every list each set is compared with the list's centre only, the set with the most
   copies among those of a fitting size. That settles near copies with as many comparisons as sets. Parity
   signatures of ``SIGNATURE`` bits, lower bounds of how much two sets differ, come before the sets themselves. They
   say little of sets that are larger than they have bits: two sets of ``LONG`` shingles have one of ``WIDE`` bits, too.
4. Derived answers: what is left are pairs of one list that are in different components. Lists are sorted by size,
   so the block of sets that are too small is skipped, then sets whose position rules them out. The answers of
   two sets to their common centre bound their own overlap from below and above; most pairs are settled by
   that alone, the rest is compared.
5. Components of all links.

Defined results: null and empty texts have no shingles and link with nothing; fewer than five words are one
shingle; equal rows are linked documents like any other copies; a null doc_id takes part, and is
the last choice as a component's id; an empty table gives an empty one; columns besides doc_id and text are
ignored, or kept by ``one_of_each``. Shingles and sets are compared by hashes of 43 and 64 bits
(two different shingles of one pair of sets of 1,000 meet with a chance of 1e-7).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import through_table
from .components import components
from .keyed import arrays, bounds, joined, record_batch, taken
from .words import NOT_SPACE, Powers, mix, sized_words, slabs

SHINGLE = 5
#: Percent of the union that the intersection must reach.
ALIKE = 80
#: Size of the table of levels, whatever the corpus.
BUCKETS = 1 << 20
#: A shingle is frequent when the tasks together have seen it this often beside itself.
FREQUENT = 16
#: Bits of the filter that says which sets a pass has to hand out.
FILTER_BITS = 1 << 22
#: Bits of the parity signature of a set.
SIGNATURE = 1024
#: Shingles from which a set has a second signature of so many bits, about a sixth of the set itself or less.
LONG, WIDE = 1500, 1 << 14
#: Rows of three numbers that are sent to all tasks; larger tables are shuffled.
SENT = 500_000
#: Lists of more sets than twice this are compared set by set, shorter ones together.
SHORT = 32
#: Shingles that a task counts together.
COUNTED = 3_000_000
_LOW48 = (1 << 48) - 1
_COEFF = mix(np.arange(1, SHINGLE + 2, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)

_LENGTH = np.arange(SHINGLE + 1, dtype=np.uint64) * _COEFF[SHINGLE]


def shingles(texts: list[bytes], powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text as 48-bit numbers, in ascending order, and where each text's begin.

    A number is five bits of the words' length, long words first, and a hash: chance brings short words
    together again and again, so they come last in the order of all shingles. There are at most 65,536
    texts, so that text and shingle are one number to sort.
    """
    hashes, begin, size = sized_words(texts, NOT_SPACE, powers)
    until = np.concatenate(([0], np.cumsum(size)))
    count = np.diff(begin)
    parts = []
    if len(hashes) >= SHINGLE:
        n = len(hashes) - SHINGLE + 1
        value = hashes[:n] * _COEFF[0]
        for k in range(1, SHINGLE):
            value += hashes[k : n + k] * _COEFF[k]
        value += _LENGTH[SHINGLE]
        # Windows that reach into the next text don't count.
        inner = np.ones(n, bool)
        for k in range(1, SHINGLE):
            ends = begin[1:-1] - k
            inner[ends[(ends >= 0) & (ends < n)]] = False
        doc = np.repeat(np.arange(len(texts)), count)[:n]
        length = until[SHINGLE:] - until[:n]
        parts.append(_packed(np.compress(inner, value), np.compress(inner, length), np.compress(inner, doc)))
    for d in np.flatnonzero((count > 0) & (count < SHINGLE)):
        value = (hashes[begin[d] : begin[d + 1]] * _COEFF[: count[d]]).sum(keepdims=True) + _LENGTH[count[d]]
        parts.append(_packed(value, until[begin[d + 1] : begin[d + 1] + 1] - until[begin[d]], np.array([d])))
    packed = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
    new = np.ones(len(packed), bool)
    new[1:] = packed[1:] != packed[:-1]
    packed = np.compress(new, packed)
    bounds = np.searchsorted(packed, np.arange(len(texts), dtype=np.uint64) << np.uint64(48))
    return packed & np.uint64(_LOW48), np.concatenate((bounds, [len(packed)]))


def _packed(value: np.ndarray, length: np.ndarray, doc: np.ndarray) -> np.ndarray:
    short = (31 - np.minimum(31, length // 2)).astype(np.uint64)
    return (doc.astype(np.uint64) << np.uint64(48)) | (short << np.uint64(43)) | (mix(value) >> np.uint64(21))


def identities(value: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """One number per set: equal sets have equal ones."""
    total = np.concatenate(([np.uint64(0)], np.cumsum(mix(value ^ _COEFF[0]))))
    n = np.diff(begin).astype(np.uint64)
    return mix((total[begin[1:]] - total[begin[:-1]]) ^ (n * _COEFF[1])).view(np.int64)


def signatures(value: np.ndarray, begin: np.ndarray, bits: int = SIGNATURE) -> np.ndarray:
    """Parity signatures as rows of 64-bit numbers: bit j says whether an odd number of shingles falls on j.

    Two sets differ in at least as many shingles as their signatures in bits.
    """
    rows = len(begin) - 1
    doc = np.repeat(np.arange(rows), np.diff(begin))
    bit = (value >> np.uint64(20) & np.uint64(bits - 1)).astype(np.int64)
    odd = np.bincount(doc * bits + bit, minlength=rows * bits).astype(np.uint8) & 1
    return np.packbits(odd.reshape(rows, bits), axis=1, bitorder="little").view(np.int64)


def _wide(value: np.ndarray, begin: np.ndarray) -> pa.ListArray:
    """Signatures of WIDE bits of the sets of LONG shingles and more, null for the others."""
    size = np.diff(begin)
    long = size >= LONG
    until = np.concatenate(([0], np.cumsum(size[long])))
    sig = signatures(value[np.repeat(long, size)], until, WIDE)
    offsets = np.concatenate(([0], np.cumsum(long * (WIDE // 64))))
    none = np.concatenate((~long, [False]))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32(), mask=none), pa.array(sig.reshape(-1)))


def ordered(value: np.ndarray, begin: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The shingles of each set in the order of all shingles: by level, then by hash."""
    level = levels[(value & np.uint64(BUCKETS - 1)).astype(np.int64)].astype(np.uint64)
    token = (level << np.uint64(48)) | value
    for d in np.unique(np.searchsorted(begin, np.flatnonzero(level), "right") - 1):
        token[begin[d] : begin[d + 1]].sort()
    return token.view(np.int64)


def _describe(docs: DataFrame) -> DataFrame:
    """doc_id, tkey, sid, n, sig, wide of every document; and rows (bucket, seen) of repeated shingles, the others null."""
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("tkey", T.LongType()), T.StructField("sid", T.LongType()),
        T.StructField("n", T.IntegerType()), T.StructField("sig", T.ArrayType(T.LongType())),
        T.StructField("wide", T.ArrayType(T.LongType())),
        T.StructField("bucket", T.IntegerType()), T.StructField("seen", T.LongType()),
    ])

    def counted(parts: list[np.ndarray], kinds: list[pa.DataType]) -> pa.RecordBatch:
        value, n = np.unique(np.concatenate(parts), return_counts=True)
        bucket = (value[n > 1] & np.uint64(BUCKETS - 1)).astype(np.int64)
        at, inverse = np.unique(bucket, return_inverse=True)
        total = np.bincount(inverse, n[n > 1], len(at)).astype(np.int64)
        empty = [pa.nulls(len(at), k) for k in kinds]
        return pa.RecordBatch.from_arrays([*empty, pa.array(at, pa.int32()), pa.array(total)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        parts, held, kinds = [], 0, []
        for batch, texts in slabs(batches):
            value, begin = shingles(texts, powers)
            sid = identities(value, begin)
            ids, keys = batch.column(0), batch.column(1)
            kinds = [ids.type, pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            none = [pa.nulls(len(batch), pa.int32()), pa.nulls(len(batch), pa.int64())]
            size = pa.array(np.diff(begin), pa.int32())
            sig = signatures(value, begin)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sig) + 1) * sig.shape[1], pa.int32()), pa.array(sig.reshape(-1)))
            yield pa.RecordBatch.from_arrays([ids, keys, pa.array(sid), size, lists, _wide(value, begin), *none], names=schema.names)
            # Copies inside the slab count once, so that the levels say how many different sets hold a shingle.
            _, once = np.unique(sid, return_index=True)
            if len(once) < len(sid):
                value = np.concatenate([value[begin[i] : begin[i + 1]] for i in once])
            parts.append(value)
            held += len(value)
            if held >= COUNTED:
                yield counted(parts, kinds)
                parts, held = [], 0
        if held:
            yield counted(parts, kinds)

    return docs.select("doc_id", F.xxhash64("text").alias("tkey"), "text").mapInArrow(run, schema)


def _levels(described: DataFrame) -> np.ndarray:
    """The table of levels: at most BUCKETS rows come to the driver."""
    rows = described.where("bucket is not null").groupBy("bucket").agg(F.sum("seen").alias("seen"))
    found = rows.where(F.col("seen") >= FREQUENT).toArrow()
    levels = np.zeros(BUCKETS, np.uint8)
    seen = found.column("seen").to_numpy()
    levels[found.column("bucket").to_numpy()] = np.minimum(31, np.log2(np.maximum(seen, 1)).astype(np.int64) - 3)
    return levels


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - (ALIKE * n + 99) // 100 + 1


def _prefixes(docs: DataFrame, sent: object) -> DataFrame:
    """(token, sid, n, pos, w): index entries of every set; w counts its copies in a slab."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for _, texts in slabs(batches):
            value, begin = shingles(texts, powers)
            sid = identities(value, begin)
            token = ordered(value, begin, sent.value)
            n = np.diff(begin)
            _, once, copies = np.unique(sid, return_index=True, return_counts=True)
            once, copies = once[n[once] > 0], copies[n[once] > 0]
            length = prefix_length(n[once])
            owner = np.repeat(np.arange(len(once)), length)
            pos = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            row = once[owner]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(token[begin[row] + pos]), pa.array(sid[row]), pa.array(n[row], pa.int32()),
                    pa.array(pos, pa.int32()), pa.array(copies[owner], pa.int32()),
                ],
                names=["token", "sid", "n", "pos", "w"],
            )

    return docs.select("text").mapInArrow(run, "token long, sid long, n int, pos int, w int")


def _fits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(a, b) >= ALIKE * np.maximum(a, b)


#: Rows of one list that are looked at together; a longer list goes on with the centres found so far.
LIST_ROWS = 65_536
_LISTS = pa.schema([("token", pa.int64()), ("sid", pa.int64()), ("n", pa.int32()), ("pos", pa.int32()), ("center", pa.int64()), ("cn", pa.int32()), ("m", pa.int32())])


def _centred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by token and sid: drop lists of one set, give every entry the centre of its list."""
    known: dict[str, np.ndarray] = {}  # centres of the list that goes on
    last = None

    def settle(c: dict[str, np.ndarray], more: bool) -> pa.RecordBatch | None:
        nonlocal known, last
        new = np.ones(len(c["token"]), bool)
        new[1:] = (c["token"][1:] != c["token"][:-1]) | (c["sid"][1:] != c["sid"][:-1])
        total = np.add.reduceat(c["w"], np.flatnonzero(new))
        c = taken(c, new) | {"w": total}
        starts = bounds(c["token"])
        size = np.diff(starts)
        goes_on = last is not None and c["token"][0] == last
        several = size > 1
        if goes_on:
            several[0] = True
        if more:
            several[-1] = True
        c = taken(c | {"m": np.repeat(size, size)}, np.repeat(several, size))
        if not len(c["token"]):
            known, last = {}, None
            return None
        center, cn = np.zeros(len(c["token"]), np.int64), np.zeros(len(c["token"]), np.int32)
        open_ = np.ones(len(center), bool)
        chosen_sid, chosen_n = [], []
        if goes_on:
            for s, n in zip(known["sid"], known["n"]):
                hit = open_ & (c["token"] == last) & _fits(c["n"], n)
                center[hit], cn[hit] = s, n
                open_ &= ~hit
            chosen_sid, chosen_n = list(known["sid"]), list(known["n"])
        tail = c["token"][-1]
        while open_.any():
            rest = np.flatnonzero(open_)
            at = bounds(c["token"][rest])
            most = np.maximum.reduceat(c["w"][rest], at[:-1])
            top = np.flatnonzero(c["w"][rest] == np.repeat(most, np.diff(at)))
            pick = rest[top[np.searchsorted(top, at[:-1])]]
            own = np.repeat(pick, np.diff(at))
            hit = _fits(c["n"][rest], c["n"][own])
            center[rest[hit]], cn[rest[hit]] = c["sid"][own[hit]], c["n"][own[hit]]
            open_[rest[hit]] = False
            if more and c["token"][pick[-1]] == tail:
                if not goes_on or tail != last:
                    chosen_sid, chosen_n, last, goes_on = [], [], tail, True
                chosen_sid.append(c["sid"][pick[-1]])
                chosen_n.append(c["n"][pick[-1]])
        last = tail if more else None
        known = {"sid": np.array(chosen_sid), "n": np.array(chosen_n)} if more else {}
        return record_batch(c | {"center": center, "cn": cn}, _LISTS)

    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        if not len(batch):
            continue
        held.append(arrays(batch))
        if sum(len(h["token"]) for h in held) < LIST_ROWS:
            continue
        c = joined(held)
        cut = int(np.searchsorted(c["token"], c["token"][-1], "left"))
        if cut:
            if (out := settle(taken(c, slice(0, cut)), False)) is not None:
                yield out
            held = [taken(c, slice(cut, None))]
        else:
            if (out := settle(c, True)) is not None:
                yield out
            held = []
    if held and (out := settle(joined(held), False)) is not None:
        yield out


def _sets(docs: DataFrame, wanted: DataFrame, sent: object) -> DataFrame:
    """(sid, items) of the sets whose sid is wanted, and of a few more."""
    bit = F.col("sid").bitwiseAND(FILTER_BITS - 1)
    rows = wanted.select(F.shiftright(bit, 15).alias("block"), bit.bitwiseAND(32767).alias("bit"))
    blocks = rows.groupBy("block").agg(F.expr("bitmap_construct_agg(bit)").alias("bits")).collect()  # at most 128 rows of 4 KB
    table = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in blocks:
        part = np.frombuffer(bytes(r.bits), np.uint8)
        table[r.block * 4096 : r.block * 4096 + len(part)] = part
    asked = docs.sparkSession.sparkContext.broadcast(np.unpackbits(table, bitorder="little").astype(bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for _, texts in slabs(batches):
            value, begin = shingles(texts, powers)
            sid = identities(value, begin)
            _, once = np.unique(sid, return_index=True)
            once = once[asked.value[sid[once] & (FILTER_BITS - 1)] & (np.diff(begin)[once] > 0)]
            if not len(once):
                continue
            token = ordered(value, begin, sent.value)
            parts = [token[begin[i] : begin[i + 1]] for i in once]
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
            items = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(parts)))
            yield pa.RecordBatch.from_arrays([pa.array(sid[once]), items], names=["sid", "items"])

    return docs.select("text").mapInArrow(run, "sid long, items array<long>").dropDuplicates(["sid"])


def _possible(pairs: DataFrame, described: DataFrame) -> DataFrame:
    """The pairs (a, b) that their signatures don't rule out, the wide ones of two large sets included."""
    known = described.where("n > 0").select("sid", "n", "sig").dropDuplicates(["sid"])
    side = lambda x: known.select(F.col("sid").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    left = both.where(_may("s_a", "s_b")).select("a", "b", "n_a", "n_b")
    large = described.where("wide is not null").select("sid", "wide").dropDuplicates(["sid"])
    side = lambda x: large.select(F.col("sid").alias(x), F.col("wide").alias(f"w_{x}"))
    both = left.join(side("b"), "b", "left").join(side("a"), "a", "left")
    return both.where(F.coalesce(_may("w_a", "w_b"), F.lit(True))).select("a", "b")


def _may(one: str, two: str) -> Column:
    """Whether sets of n_a and n_b shingles with these signatures may be alike."""
    bits = F.zip_with(one, two, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(bits, F.lit(0), lambda acc, x: acc + x)
    # |a & b| = (|a| + |b| - |a ^ b|) / 2, and 100 |a & b| >= ALIKE |a | b| needs (100 + ALIKE) |a & b| >= ALIKE (|a| + |b|).
    total = F.col("n_a") + F.col("n_b")
    return (total - differ) * (100 + ALIKE) >= total * (2 * ALIKE)


def _overlaps(pairs: DataFrame, docs: DataFrame, sent: object) -> DataFrame:
    """(a, b, n_a, n_b, o): sizes and exact overlap of the pairs (a, b) of sids."""
    pairs = through_table(pairs, "pairs")
    # Dealt out by sid once: both sides of the join read that exchange, so the sets of b don't move again.
    sets = _sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct(), sent)
    side = lambda x: sets.select(F.col("sid").alias(x), F.col("items").alias(f"i_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    sizes = [F.size(f"i_{x}").alias(f"n_{x}") for x in "ab"]
    return through_table(both.select("a", "b", *sizes, F.size(F.array_intersect("i_a", "i_b")).alias("o")), "overlaps")


def _alike() -> Column:
    return F.col("o") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("o")) * ALIKE


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sure", pa.bool_())])


def _derived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by token and size: pairs of different components that size, position and centre don't rule out."""
    out: list[tuple[np.ndarray, ...]] = []
    held: dict[str, np.ndarray] | None = None

    def flush() -> pa.RecordBatch:
        a, b, sure = (np.concatenate(x) for x in zip(*out))
        out.clear()
        rows = np.unique(np.column_stack([np.minimum(a, b), np.maximum(a, b), sure]), axis=0)
        return record_batch({"a": rows[:, 0], "b": rows[:, 1], "sure": rows[:, 2].astype(bool)}, _PAIRS)

    for batch in batches:
        if not len(batch):
            continue
        c = arrays(batch)
        fresh = 0
        if held is not None and held["token"][-1] == c["token"][0]:
            fresh = len(held["token"])
            c = joined([held, c])
        token, sid, comp, center = c["token"], c["sid"], c["comp"], c["center"]
        n, pos, cn, o = (c[k].astype(np.int64) for k in ("n", "pos", "cn", "o"))
        f = np.array([c[f"f{k}"] for k in range(SIGNATURE // 64)]).view(np.uint64)

        def compare(x: np.ndarray, y: np.ndarray) -> None:
            differ = np.bitwise_count(f[:, x] ^ f[:, y]).sum(0, dtype=np.int64)  # noqa: B023
            need = (ALIKE * (n[x] + n[y]) + 99 + ALIKE) // (100 + ALIKE)  # noqa: B023
            open_ = n[x] + n[y] - differ >= 2 * need  # noqa: B023
            x, y, need = x[open_], y[open_], need[open_]
            most = np.minimum(n[x] - pos[x], n[y] - pos[y]) + np.minimum(pos[x], pos[y])  # noqa: B023
            same = (center[x] == center[y]) & (o[x] >= 0) & (o[y] >= 0)  # noqa: B023
            above = np.minimum(o[x], o[y]) + np.minimum(n[x] - o[x], n[y] - o[y])  # noqa: B023
            # Pairs with a centre have been compared, and are not linked.
            open_ = (most >= need) & ~(same & (above < need)) & (center[y] != sid[x]) & (center[x] != sid[y])  # noqa: B023
            x, y, need, same = x[open_], y[open_], need[open_], same[open_]
            if len(x):
                out.append((sid[x], sid[y], same & (o[x] + o[y] - cn[x] >= need)))  # noqa: B023

        at = bounds(token)
        short = np.repeat(np.diff(at) <= 2 * SHORT, np.diff(at))
        # Short lists all at once: every set with the one before it, with the one before that, and so on.
        i, back = np.flatnonzero(short[fresh:]) + fresh, 1
        while len(i):
            i = i[i >= back]
            i = i[(token[i - back] == token[i]) & (n[i - back] * 100 >= n[i] * ALIKE)]
            x = i[comp[i - back] != comp[i]]
            compare(x, x - back)
            back += 1
        # Long ones set by set. Sizes ascend: the block of sets that are too small is skipped.
        for lo, hi in zip(at[:-1], at[1:]):
            if hi - lo <= 2 * SHORT:
                continue
            least = lo + np.searchsorted(n[lo:hi] * 100, n[lo:hi] * ALIKE, "left")
            for x in range(max(lo + 1, fresh), hi):
                y = np.arange(least[x - lo], x)
                y = y[comp[y] != comp[x]]
                if len(y):
                    compare(np.full(len(y), x), y)
                if sum(len(p[0]) for p in out) > 50_000:
                    yield flush()
        if sum(len(p[0]) for p in out) > 50_000:
            yield flush()
        # Of the list that may go on, only sets that are large enough for the sets to come.
        lo = int(np.searchsorted(token, token[-1], "left"))
        keep = lo + int(np.searchsorted(n[lo:] * 100, int(n[-1]) * ALIKE, "left"))
        held = taken(c, slice(keep, None))
    if out:
        yield flush()


def _signed(left: DataFrame, described: DataFrame) -> DataFrame:
    """Entries of lists with sets of several components, with the numbers f0, f1, ... of the signature."""
    known = described.where("n > 0").select("sid", "sig").dropDuplicates(["sid"])
    parts = [F.col("sig")[k].alias(f"f{k}") for k in range(SIGNATURE // 64)]
    several = left.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    return left.join(several, "token").join(known.select("sid", *parts), "sid").drop("m")


def _sent(table: DataFrame) -> DataFrame:
    """A written table of a few numbers a row, sent to all tasks if it has at most SENT rows."""
    return F.broadcast(table) if table.count() <= SENT else table


def _spread(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition(order[0]).sortWithinPartitions(*order)


def _linked(docs: DataFrame, described: DataFrame) -> DataFrame:
    """(node, comp) of every set that is linked with another one."""
    sent = docs.sparkSession.sparkContext.broadcast(_levels(described))
    entries = _spread(_prefixes(docs, sent), "token", "sid")
    lists = through_table(entries.mapInArrow(_centred, "token long, sid long, n int, pos int, center long, cn int, m int"), "lists")
    stars = lists.where("sid <> center").select(F.col("sid").alias("a"), F.col("center").alias("b")).distinct()
    first = _overlaps(_possible(stars, described), docs, sent)
    links = first.where(_alike()).select("a", "b")
    found = components(links)
    placed = (
        lists.join(_sent(found.withColumnRenamed("node", "sid")), "sid", "left")
        .join(_sent(first.select(F.col("a").alias("sid"), F.col("b").alias("center"), "o")), ["sid", "center"], "left")
        .select("token", "sid", "n", "pos", "center", "cn", "m", F.coalesce("comp", "sid").alias("comp"),
                # Unknown, as -1, where the signatures alone told two sets apart.
                F.when(F.col("sid") == F.col("center"), F.col("n")).otherwise(F.coalesce("o", F.lit(-1))).alias("o"))
    )
    left = _spread(_signed(placed, described), "token", "n", "sid")
    pairs = left.mapInArrow(_derived, "a long, b long, sure boolean").groupBy("a", "b").agg(F.max("sure").alias("sure"))
    pairs = through_table(pairs, "derived")
    more = pairs.where("sure").select("a", "b")
    unsure = through_table(_possible(pairs.where("not sure").select("a", "b"), described), "possible")
    if not unsure.isEmpty():
        more = more.union(_overlaps(unsure, docs, sent).where(_alike()).select("a", "b"))
    if more.isEmpty():
        return found
    # Components of components: only the links that are new.
    name = lambda x: found.select(F.col("node").alias(x), F.col("comp").alias(f"{x}_comp"))
    moved = more.join(name("a"), "a", "left").join(name("b"), "b", "left")
    again = components(moved.select(F.coalesce("a_comp", "a").alias("a"), F.coalesce("b_comp", "b").alias("b")))
    ends = again.select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    old = found.join(ends, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
    alone = again.join(found.select("node"), "node", "left_anti")
    return through_table(old.union(alone), "nodes")


def _classes(docs: DataFrame) -> DataFrame:
    """doc_id, tkey, sid, n and first: the least (doc_id, tkey) of the component, the document itself without shingles."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    described = through_table(_describe(docs), "shingles")
    rows = described.where("bucket is null").select("doc_id", "tkey", "sid", "n")
    linked = _linked(docs, described)
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tkey")
    heads = rows.where("n > 0").groupBy("sid").agg(F.min(key).alias("first"))
    heads = heads.join(linked.withColumnRenamed("node", "sid"), "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    least = heads.groupBy("comp").agg(F.min("first").alias("least"))
    heads = heads.join(least, "comp").select("sid", "least")
    own = F.when(F.col("n") > 0, F.col("least")).otherwise(key)
    return rows.join(heads, "sid", "left").select("doc_id", "tkey", "sid", "n", own.alias("first"))


def similar_documents(docs: DataFrame) -> DataFrame:
    """The contract's columns: doc_id, n_shingles, component_id."""
    return _classes(docs).select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("first.doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without those that a document of a smaller id in their component stands for.

    Rows that are equal in doc_id and text are one document: one of them stays.
    """
    columns = docs.columns
    classes = through_table(_classes(docs), "classes")
    kept = classes.where(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tkey") == F.col("first.tkey")))
    kept = kept.groupBy(F.col("doc_id").alias("__id"), F.col("tkey").alias("__tkey")).agg(F.count("*").alias("__rows"))
    keyed = docs.withColumn("__key", F.xxhash64(F.coalesce("text", F.lit(""))))
    out = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__tkey")))
    if not kept.where("__rows > 1").isEmpty():
        out = out.dropDuplicates(["doc_id", "__key"])
    return out.select(*columns)
