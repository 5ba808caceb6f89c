"""Hard-negative mining by threshold joins with an inverted index, in the manner of L2AP.

Rows are dealt into blocks of a bounded number of values; anchors go past every block (a stated query set against all
rows). Inside a block:

1. Dimensions are put in ascending order of their energy. For a threshold, the leading dimensions of a row whose norm
   times the anchor's cannot reach it are left out of the index; rows of which nothing remains are no candidates. Rows
   are sorted by where their indexed part begins, so the list of a dimension is a run of rows.
2. An anchor goes through the lists from the last dimension to the first and accumulates partial scores. Rows whose partial
   score and the product of both remaining norms stay below the threshold are pruned.
3. What is left is scored exactly, in whole numbers. The threshold starts near the largest score possible and is
   lowered until the anchor's windows are full or nothing lies lower; a full window raises it again.

The first join gives each anchor its positives; their scores are the windows of the second one, for negatives. Results of
the blocks, at most a window each, are merged by rank.

Defined results: rows with a null label, a null or empty vector, or null or non-finite entries take no part; rows with a
null vec_id do, as positives and negatives, after all others on a tie; repeated rows are rows of their own; missing entries
of shorter vectors count as 0; entries beyond the range of long are its ends, scores likewise; a window whose positive's
score is negative is empty; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import through_table
from .whitening import usable

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: Percent of the positive's score that a negative's score lies between.
LEAST, MOST = 50, 95
#: Values of a block: an index holds two copies of it, in 4 to 8 bytes each.
BLOCK_VALUES = 1 << 23
#: A block is not made smaller than this to keep more cores busy.
BLOCK_ROWS = 4096
#: Thresholds, as shares of the largest score an anchor can have with a row of the block.
LEVELS = (0.8, 0.6, 0.45, 0.34, 0.25, 0.18, 0.1, 0.05)
#: Anchors that are read before they go past the index, and what goes past it together.
ANCHORS, ANCHOR_TILE, ROW_TILE, DIM_TILE = 1024, 32, 8192, 8
#: Pairs that are scored exactly at once.
PAIRS = 1 << 16
_INF = np.iinfo(np.int64).max


def _vectors(column: pa.Array, dim: int | None = None) -> np.ndarray:
    """Rows of whole numbers, shorter ones filled with 0; cut or filled to ``dim`` if given."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(size.max()) if len(size) else 0
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width)[None, :] < size[:, None]] = flat
    if dim is None or dim == width:
        return out
    return out[:, :dim] if dim < width else np.pad(out, ((0, 0), (0, dim - width)))


class Index:
    """Rows of a block, given in the order that decides ties."""

    def __init__(self, x: np.ndarray, rid: np.ndarray, label: np.ndarray, vec_id: pa.Array | None = None):
        largest = int(np.abs(x).max()) if x.size else 0
        self.largest = max(largest, 1)
        self.whole = x.astype(np.int32) if 0 <= largest < 1 << 31 else x
        self.rid, self.label, self.vec_id = rid, label, vec_id
        scaled = (x / self.largest).astype(np.float32)
        self.dims = np.argsort((scaled.astype(np.float64) ** 2).sum(0), kind="stable")
        self.scaled = scaled[:, self.dims]
        self.cuts = np.append(np.arange(0, x.shape[1], DIM_TILE), x.shape[1])
        self.norms = np.sqrt(self._before(self.scaled))
        self.reach = float(self.norms[:, -1].max()) if len(x) else 0.0

    def _before(self, x: np.ndarray) -> np.ndarray:
        """Squares of the entries before each cut."""
        total = np.cumsum(x.astype(np.float64) ** 2, axis=1)
        return np.column_stack([np.zeros(len(x)), total[:, self.cuts[1:] - 1]]) if x.shape[1] else np.zeros((len(x), 1))

    def search(self, q: np.ndarray, own: np.ndarray, label: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: int, alike: bool) -> list:
        """For each anchor and window [lo, hi] the first k rows as (scores, rows); rows of its label, or of others."""
        found: list = [None] * len(q)
        size = np.maximum(np.abs(q).max(1), 1) if q.shape[1] else np.ones(len(q))
        scaled = (q / size[:, None]).astype(np.float32)[:, self.dims]
        norms = np.sqrt(self._before(scaled))
        unit = size.astype(np.float64) * self.largest  # of scaled scores
        full = norms[:, -1] * self.reach  # the largest scaled score
        # Rounding of single-precision sums.
        slack = (2e-7 * (q.shape[1] + 8)) * full
        floor = np.where((lo <= hi), lo, _INF).min(1) / unit - 2 * slack
        top = hi.max(1) / unit + slack
        open_ = np.arange(len(q))
        for level in (*LEVELS, None):
            t = full[open_] * level if level is not None else np.full(len(open_), -np.inf)
            t = np.maximum(t, floor[open_])
            go = t <= np.maximum(top[open_], floor[open_])
            if level is not None:
                go &= full[open_] > 0
            now, t = open_[go], t[go]
            if len(now):
                share = float((t / np.maximum(norms[now, -1], 1e-30)).min())
                order, start = self._indexed(share)
                for at in range(0, len(now), ANCHOR_TILE):
                    some = now[at : at + ANCHOR_TILE]
                    made = self._scan(order, start, q[some], scaled[some], norms[some], unit[some], slack[some],
                                      t[at : at + ANCHOR_TILE], own[some], label[some], lo[some], hi[some], k, alike)
                    for i, m, least in zip(some, made, t[at : at + ANCHOR_TILE]):
                        found[i] = m
                        if level is not None and least > floor[i]:
                            real = least * unit[i] + slack[i] * unit[i]
                            if any(len(s) < k and l < real for (s, _), l, h in zip(m, lo[i], hi[i]) if l <= h):
                                found[i] = None
            open_ = np.array([i for i in open_ if found[i] is None], dtype=np.int64)
            if not len(open_):
                break
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        return [m if m is not None else [none] * lo.shape[1] for m in found]

    def _indexed(self, share: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows sorted by the first cut that is indexed, without those of which nothing is, and that cut."""
        start = (self.norms[:, 1:] < share * (1 - 1e-6)).sum(1)
        order = np.argsort(start, kind="stable")
        order = order[: np.searchsorted(start[order], len(self.cuts) - 1)] if share > 0 else order
        return order, np.minimum(start[order], max(len(self.cuts) - 2, 0))

    def _scan(self, order, start, q, scaled, norms, unit, slack, t, own, label, lo, hi, k, alike):  # noqa: ANN001, ANN202
        t, sure = t.copy(), t + slack
        best = [[(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(lo.shape[1])] for _ in q]
        safe = int(np.abs(q).max() if q.size else 0) * self.largest * max(q.shape[1], 1) < 1 << 62
        for at in range(0, len(order), ROW_TILE):
            rows, first = order[at : at + ROW_TILE], start[at : at + ROW_TILE]
            x, left = self.scaled[rows], self.norms[rows].astype(np.float32)
            score = np.zeros((len(q), len(rows)), np.float32)
            alive = (self.label[rows][None, :] == label[:, None]) == alike
            for c in range(len(self.cuts) - 2, -1, -1):
                a, b = self.cuts[c], self.cuts[c + 1]
                n = int(np.searchsorted(first, c, "right"))  # the lists of these dimensions
                score[:, :n] += scaled[:, a:b] @ x[:n, a:b].T
                # Rows that these lists don't hold keep the bound they had when their own ended.
                rest = norms[:, c].astype(np.float32)[:, None] * left[:n, c][None, :] * np.float32(1 + 1e-6)
                alive[:, :n] &= score[:, :n] + rest >= (t - slack)[:, None]
                if not c or np.count_nonzero(alive) * 16 < alive.size:
                    break
            i, j = np.nonzero(alive)
            if not len(i):
                continue
            real = self._exact(q, i, rows[j], safe)
            # Below the threshold some rows get this far and others don't.
            keep = (self.rid[rows[j]] != own[i]) & (real >= (sure * unit)[i])
            i, j, real = i[keep], rows[j[keep]], real[keep]
            ends = np.searchsorted(i, np.arange(len(q) + 1))
            for a in np.flatnonzero(np.diff(ends)):
                s, r = real[ends[a] : ends[a + 1]], j[ends[a] : ends[a + 1]]
                for w in range(lo.shape[1]):
                    inside = (s >= lo[a, w]) & (s <= hi[a, w])
                    if inside.any():
                        best[a][w] = _first(np.concatenate([best[a][w][0], s[inside]]), np.concatenate([best[a][w][1], r[inside]]), k)
                full = [b[0][-1] if len(b[0]) >= k else None for b, l, h in zip(best[a], lo[a], hi[a]) if l <= h]
                if full and None not in full:
                    t[a] = max(t[a], min(full) / unit[a] - 2 * slack[a])
        return best

    def _exact(self, q: np.ndarray, i: np.ndarray, rows: np.ndarray, safe: bool) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        for at in range(0, len(i), PAIRS):
            x, y = self.whole[rows[at : at + PAIRS]], q[i[at : at + PAIRS]]
            if safe:
                out[at : at + PAIRS] = np.einsum("ij,ij->i", x, y, dtype=np.int64)
            else:
                out[at : at + PAIRS] = np.clip((x.astype(object) * y.astype(object)).sum(1), -_INF - 1, _INF).astype(np.int64)
        return out


def _first(score: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best; rows stand in the order that decides ties."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        above = np.flatnonzero(score > least)
        equal = np.flatnonzero(score == least)
        equal = equal[np.argsort(row[equal], kind="stable")[:k]]
        at = np.concatenate([above, equal])
        score, row = score[at], row[at]
    at = np.lexsort((row, -score.astype(np.float64) if np.abs(score).max() < 1 << 53 else ~score))[:k]
    return score[at], row[at]


def _probe(k: int, alike: bool):  # noqa: ANN202
    """A task: blocks of rows, each followed by all anchors."""

    def results(index: dict, anchors: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(anchors).combine_chunks()
        get = lambda name: table.column(name).combine_chunks()
        x, label, rid = get("x"), get("label").to_numpy(), get("rid").to_numpy()
        windows = _vectors(get("lo")), _vectors(get("hi"))
        count = np.diff(get("lo").offsets.to_numpy())
        lo, hi = (np.where(np.arange(w.shape[1])[None, :] < count[:, None], w, fill) for w, fill in zip(windows, (1, 0)))
        groups = [(part, np.flatnonzero(label == name)) for name, part in index.items()] if alike else [(index[None], np.arange(len(rid)))]
        for part, at in groups:
            if not len(at):
                continue
            q = _vectors(x.take(pa.array(at)), part.scaled.shape[1])
            made = part.search(q, rid[at], label[at], lo[at], hi[at], k, alike)
            rows = [(a, w, s, r) for a, m in zip(at, made) for w, (ss, rr) in enumerate(m) for s, r in zip(ss, rr)]
            if rows:
                a, w, s, r = (np.array(c, np.int64) for c in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[a]), get("vec_id").take(pa.array(a)), pa.array(w, pa.int32()), pa.array(part.rid[r]), part.vec_id.take(pa.array(r)), pa.array(s)],
                    names=["anchor", "anchor_id", "window", "rid", "vec_id", "score"],
                )

    def built(parts: list[pa.RecordBatch]) -> dict:
        if not parts:
            return {}
        table = pa.Table.from_batches(parts).combine_chunks()
        get = lambda name: table.column(name).combine_chunks()
        x, rid, label, vec_id = _vectors(get("x")), get("rid").to_numpy(), get("label").to_numpy(), get("vec_id")
        if not alike:
            return {None: Index(x, rid, label, vec_id)}
        order = np.argsort(label, kind="stable")
        at = np.split(order, np.flatnonzero(np.diff(label[order])) + 1)
        return {label[a[0]]: Index(x[a], rid[a], label[a], vec_id.take(pa.array(a))) for a in at}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows, index, anchors = None, [], None, []
        for batch in batches:
            blocks, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            key = blocks.astype(np.int64) * 2 + kinds
            edges = np.concatenate(([0], np.flatnonzero(np.diff(key)) + 1, [len(key)]))
            for lo, hi in zip(edges[:-1], edges[1:]):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if blocks[lo] != block:
                    if anchors and index:
                        yield from results(index, anchors)
                    block, rows, index, anchors = blocks[lo], [], None, []
                if not kinds[lo]:
                    rows.append(part)
                    continue
                if index is None:
                    index, rows = built(rows), []
                anchors.append(part)
                if sum(map(len, anchors)) >= ANCHORS:
                    if index:
                        yield from results(index, anchors)
                    anchors = []
        if anchors and index:
            yield from results(index, anchors)

    return run


def _join(rows: DataFrame, anchors: DataFrame, blocks: int, k: int, alike: bool) -> DataFrame:
    """The first k rows of each anchor and window, over all blocks: (anchor, anchor_id, window, rid, vec_id, score, rank)."""
    none = F.array().cast("array<long>")
    own = rows.select("block", F.lit(0).alias("kind"), "rid", "vec_id", "label", "x", none.alias("lo"), none.alias("hi"))
    past = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "rid", "vec_id", "label", "x", "lo", "hi")
    dealt = own.unionByName(past).repartition(blocks, "block")
    dealt = dealt.sortWithinPartitions("block", "kind", F.asc_nulls_last("vec_id"), "rid")
    kind = rows.schema["vec_id"].dataType.simpleString()
    made = dealt.mapInArrow(_probe(k, alike), f"anchor long, anchor_id {kind}, window int, rid long, vec_id {kind}, score long")
    place = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    return made.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: str, scale: int = SCALE, column: str = "embedding") -> DataFrame:
    """Hard negatives of every anchor (rows for which the SQL condition ``is_anchor`` holds) and positive."""
    wide = F.col(column).cast("array<double>")
    x = F.transform(wide, lambda c: F.floor(c * scale).cast("long"))
    rows = vectors.where(F.col("label").isNotNull() & usable(wide))
    rows = rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", F.col("label").cast("long").alias("label"), x.alias("x"),
                       F.coalesce(F.expr(is_anchor), F.lit(False)).alias("anchor"))
    rows = through_table(rows, "vectors")
    n, values = rows.agg(F.count("*"), F.sum(F.size("x"))).first()
    busy = min(2 * vectors.sparkSession.sparkContext.defaultParallelism, -(-n // BLOCK_ROWS))
    blocks = max(1, -(-(values or 0) // BLOCK_VALUES), busy)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int"))
    anchors = rows.where("anchor")
    ends = F.array(F.lit(-_INF - 1)), F.array(F.lit(_INF))
    positives = _join(rows, anchors.withColumns({"lo": ends[0], "hi": ends[1]}), blocks, POSITIVES, True)
    positives = through_table(positives.select("anchor", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # Whole-number ends of least * p <= 100 * s <= most * p; a negative p has none.
    p = F.col("positive_score").cast("decimal(38,0)")
    low, high = F.ceil(p * LEAST / 100).cast("long"), F.floor(p * MOST / 100).cast("long")
    windows = positives.where("positive_score >= 0").withColumns({"lo": low, "hi": high})
    lists = windows.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "lo", "hi"))).alias("w"))  # POSITIVES at most
    asked = anchors.drop("anchor").join(lists.withColumnRenamed("anchor", "rid"), "rid")
    asked = asked.select("rid", "vec_id", "label", "x", F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi"))
    found = _join(rows, asked, blocks, NEGATIVES, False)
    # Positives stand in the order of their ranks, and those without a window come last.
    found = found.select("anchor", "anchor_id", (F.col("window") + 1).alias("p"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"), F.col("rank").cast("int").alias("rank"))
    return found.join(positives.withColumnRenamed("rank", "p"), ["anchor", "p"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def relabelled(vectors: DataFrame) -> DataFrame:
    """Rows whose vec_id is divisible by 7 get the next label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.select("vec_id", "embedding", moved.alias("label"))


def hard_negative_rows(vectors: DataFrame) -> DataFrame:
    """The contract's columns."""
    return mine(relabelled(vectors), "vec_id % 50 = 0")


SQL = f"""
WITH valid AS (
  SELECT row_number() OVER () AS rid, vec_id, embedding,
         CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0),
entries AS (
  SELECT rid, generate_subscripts(embedding, 1) AS d, CAST(unnest(embedding) AS DOUBLE) AS c FROM valid),
usable AS (
  SELECT rid FROM entries GROUP BY rid HAVING bool_and(coalesce(isfinite(c), false))),
x AS (
  SELECT rid, d, CAST(floor({SCALE} * c) AS BIGINT) AS x FROM entries JOIN usable USING (rid)),
rows_ AS (SELECT rid, vec_id, label FROM valid JOIN usable USING (rid)),
scores AS (
  SELECT a.rid AS a, b.rid AS b, sum(a.x * b.x) AS s
  FROM x a JOIN x b USING (d) WHERE a.rid IN (SELECT rid FROM rows_ WHERE vec_id % 50 = 0) GROUP BY 1, 2),
pairs AS (
  SELECT a, b, CAST(s AS BIGINT) AS s, l.vec_id AS anchor_id, r.vec_id AS vec_id, l.label = r.label AS same
  FROM scores JOIN rows_ l ON l.rid = a JOIN rows_ r ON r.rid = b WHERE a <> b),
positives AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY a ORDER BY s DESC, vec_id NULLS LAST, b) AS k FROM pairs WHERE same) WHERE k <= {POSITIVES}),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.s AS positive_score, n.vec_id AS negative_id, n.s AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.vec_id NULLS LAST, n.b) AS rank
  FROM positives p JOIN pairs n ON n.a = p.a AND NOT n.same AND {LEAST} * p.s <= 100 * n.s AND 100 * n.s <= {MOST} * p.s)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= {NEGATIVES}
"""
