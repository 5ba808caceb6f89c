"""Near duplicates by sketches against all pairs: short and long sets, copies, ties, nulls, hot groups."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from markloom.llm import sketch_join

from ..conftest import SF_DIR

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 4]) for k in range(len(words) - 3)) if len(words) > 3 else frozenset([tuple(words)])


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        own = least.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), own, d == own))
    return sorted(out, key=repr)


def answers(docs):
    got = sketch_join.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()
    return sorted(map(tuple, got), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    shared = [word() for _ in range(150)]
    rows = [(900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one  TWO"), (None, "one two"), (905, "one"), (906, "x " * 5000), (None, None)]
    at = 0
    for size in (3, 4, 5, 20, 60, 150, 190, 200, 400, 1500):
        base = [word() for _ in range(size)]
        for edits in (0, 0, 1, 2, 3, 5, 8):
            text = list(base)
            for _ in range(edits * max(1, size // 80)):
                text[rng.randrange(size)] = word()
            rows.append((at, " ".join(text)))
            at += 1
        rows.append((at, " ".join(shared + [word() for _ in range(size)])))
        at += 1
    return [*rows, rows[9]]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_all_pairs(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({"sid": F.lit("s"), "n": F.lit(0), "value": F.lit(1), "comp": F.lit(2), "kept": F.lit(3)}).repartition(3)
    assert answers(docs) == expected(rows)
    left = sketch_join.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    firsts = {(d, t) for (d, t), e in zip(rows, [None] * len(rows)) if (d, len(shingles(t)), d, True) in expected(rows)}
    assert {(r.doc_id, r.text) for r in left.collect()} >= {f for f in firsts if f[0] is not None}


def test_matches_all_pairs_on_the_sample(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert answers(docs) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_hot_groups(spark):
    """A third of all documents are near copies of one, a third share a long passage only."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(9000)}"
    base, passage = [word() for _ in range(120)], [word() for _ in range(60)]
    rows = []
    for i in range(120):
        near = list(base)
        near[rng.randrange(120)] = word()
        near[rng.randrange(120)] = word()
        rows += [(3 * i, " ".join(near)), (3 * i + 1, " ".join([*passage, *(word() for _ in range(40))])), (3 * i + 2, " ".join(word() for _ in range(100)))]
    assert answers(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert sketch_join.near_duplicates(none).count() == 0 and sketch_join.drop_near_duplicates(none).count() == 0


def test_bound_covers_all_but_a_tiny_chance():
    from math import comb

    miss = sum(comb(sketch_join.K, q) * 0.8**q * 0.2 ** (sketch_join.K - q) for q in range(sketch_join.BOUND))
    assert miss <= sketch_join.MISSED
