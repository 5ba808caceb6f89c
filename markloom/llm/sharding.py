"""Sharding by extendible hashing: only oversized buckets split on another bit of the hash.

A document's hash has ``BITS`` bits, the first half from its key, the second half from its text, so that
rows that share a key can still be split. A shard is a prefix of that hash. Bytes are summed once per cell
(a prefix some bits longer than a shard should need), and prefixes of every depth are sums of cells: a
cell's shard is its shortest prefix that fits the limit. Cells that do not fit themselves are split a few
bits further in another round, over their rows only.

Column code only. What is shuffled is two numbers per document, combined to cells before it moves. Texts
move only in ``write_shards``.

Defined results: a null doc_id hashes like the empty string, a null text has no bytes; a single document
above the limit, and rows equal in doc_id and text that are above it together, stay one shard marked
``oversized``, as no bit can part them; an empty table gives an empty one; columns besides doc_id and
text are ignored, except that ``write_shards`` writes them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import through_table

BITS = 60
#: Bytes of text per shard.
LIMIT = 16 << 20
#: Bits by which cells are finer than evenly filled shards, and by which later rounds refine them.
FINER = 6


def hash_bits(key: Column, text: Column) -> Column:
    half = lambda c: F.shiftright(F.conv(F.substring(F.md5(c.cast("binary")), 1, 8), 16, 10).cast("long"), 2)
    high = half(F.coalesce(key.cast("string"), F.lit("")))
    return F.shiftleft(high, 30).bitwiseOR(half(F.coalesce(text, F.lit(""))))


def _round(rows: DataFrame, lo: int, hi: int, limit: int) -> DataFrame:
    """(cell, depth, bytes, docs): the shard of every cell of ``hi`` bits, given that ``lo - 1`` bits are too few."""
    cells = rows.groupBy(F.shiftright("h", BITS - hi).alias("cell")).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n"))
    levels = F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("depth")
    wide = cells.select("cell", "b", "n", levels).withColumn("prefix", F.expr(f"shiftright(cell, {hi} - depth)"))
    sums = wide.groupBy("depth", "prefix").agg(F.sum("b").alias("bytes"), F.sum("n").alias("docs"))
    fits = sums.where((F.col("bytes") <= limit) | (F.col("docs") == 1) | (F.col("depth") == hi))
    own = wide.select("cell", "depth", "prefix").join(fits, ["depth", "prefix"])
    return own.groupBy("cell").agg(F.min(F.struct("depth", "bytes", "docs")).alias("x")).select("cell", "x.*")


def assign(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, shard (bits), depth, shard_bytes, shard_docs, oversized, and the hash h."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = through_table(docs.select("doc_id", hash_bits(F.col("doc_id"), F.col("text")).alias("h"), size.alias("n_bytes")), "shards")
    total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("b")).first().b  # one number
    lo, hi = 0, min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + FINER)
    rest, parts = rows, []
    while True:
        found = through_table(_round(rest, lo, hi, limit), "cells")
        placed = rest.withColumn("cell", F.shiftright("h", BITS - hi)).join(found, "cell")
        over = (F.col("bytes") > limit) & (F.col("docs") > 1) & F.lit(hi < BITS)
        parts.append(placed.where(~over).select("doc_id", "h", "n_bytes", "depth", "bytes", "docs"))
        if hi == BITS or found.where(over).isEmpty():
            break
        rest = placed.where(over).select("doc_id", "h", "n_bytes")
        lo, hi = hi + 1, min(BITS, hi + FINER)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    bits = F.expr(f"case when depth = 0 then '' else lpad(bin(shiftright(h, {BITS} - depth)), depth, '0') end")
    return out.select(
        "doc_id", "n_bytes", bits.alias("shard"), F.col("depth").cast("int").alias("depth"),
        F.col("bytes").cast("long").alias("shard_bytes"), F.col("docs").cast("long").alias("shard_docs"),
        (F.col("bytes") > limit).alias("oversized"), "h",
    )


def directory(assigned: DataFrame) -> DataFrame:
    """One row per shard of ``assign``: shard, depth, bytes, docs, first_hash and last_hash.

    The shard's slots of the directory are all hashes between the two. It is kept in this short form, since a table of all
    slots has two to the power of the greatest depth.
    """
    shards = assigned.groupBy("shard", "depth").agg(F.max("shard_bytes").alias("bytes"), F.max("shard_docs").alias("docs"))
    prefix = F.when(F.col("depth") > 0, F.conv("shard", 2, 10).cast("long")).otherwise(F.lit(0).cast("long"))
    first = F.call_function("shiftleft", prefix, F.lit(BITS) - F.col("depth"))
    wide = F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(BITS) - F.col("depth"))
    return shards.select("shard", "depth", "bytes", "docs", first.alias("first_hash"), (first + wide - 1).alias("last_hash"))


def locate(docs: DataFrame, entries: DataFrame) -> DataFrame:
    """(doc_id, shard): where ``directory`` says that each document is or would be; a prefix nobody has gives null.

    A lookup by equal prefixes, one for each depth that the directory has (at most ``BITS`` + 1 numbers).
    """
    entries = through_table(entries, "directory")
    depths = [r.depth for r in entries.select("depth").distinct().collect()]
    hashed = docs.select("doc_id", hash_bits(F.col("doc_id"), F.col("text")).alias("h"))
    found = F.lit(None).cast("string")
    for d in sorted(depths):
        at = entries.where(F.col("depth") == d)
        at = at.select(F.shiftright("first_hash", BITS - d).alias(f"p{d}"), F.col("shard").alias(f"s{d}"))
        hashed = hashed.join(at, F.shiftright("h", BITS - d) == F.col(f"p{d}"), "left")
        found = F.coalesce(found, F.col(f"s{d}"))
    return hashed.select("doc_id", found.alias("shard"))


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> str:
    """Write the documents as one folder ``shard=x<bits>`` per shard; returns the name of that column.

    Tables with a column ``shard`` of their own keep it: the folders' column has underscores added then.
    """
    name = "shard"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    where = assign(docs, limit).select("h", F.concat(F.lit("x"), "shard").alias("to")).distinct()
    rows = docs.select(F.struct("*").alias("row"), hash_bits(F.col("doc_id"), F.col("text")).alias("key"))
    placed = rows.join(where, F.col("key") == F.col("h"))
    own = [F.col("row")[c].alias(c) for c in docs.columns]
    placed.select(*own, F.col("to").alias(name)).repartition(name).write.partitionBy(name).parquet(path)
    return name


def shard_rows(docs: DataFrame) -> DataFrame:
    """The query's columns of ``assign``."""
    return assign(docs).drop("h")


SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
    ((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT >> 2) << 30)
    | (('0x' || substr(md5(coalesce(text, '')), 1, 8))::BIGINT >> 2) AS h FROM documents),
wide AS (
  SELECT rid, doc_id, n_bytes, h, depth, h >> ({BITS} - depth) AS prefix
  FROM d, (SELECT unnest(range(0, {BITS + 1})) AS depth) AS levels),
sums AS (SELECT depth, prefix, sum(n_bytes)::BIGINT AS bytes, count(*) AS docs FROM wide GROUP BY ALL),
leaf AS (
  SELECT wide.*, bytes, docs FROM wide JOIN sums USING (depth, prefix)
  WHERE bytes <= {LIMIT} OR docs = 1 OR depth = {BITS}
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY depth) = 1)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth::INTEGER, '0') END AS shard,
       depth::INTEGER AS depth, bytes AS shard_bytes, docs AS shard_docs, bytes > {LIMIT} AS oversized FROM leaf"""
