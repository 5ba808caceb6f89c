"""Large sets that are not alike are told apart by signatures, so their shingles are not shuffled."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from markloom.llm import ngram_join


def test_large_sets_are_ruled_out_by_their_signatures(spark):
    random.seed(8)
    words = lambda n: [f"w{random.randrange(50_000)}" for _ in range(n)]
    one, small = words(3000), words(400)
    near = one[:1500] + ["else"] + one[1501:]
    texts = [one, near, words(3100), words(2900), small, [*small[:-1], "else"], words(390)]
    docs = spark.createDataFrame(list(enumerate(map(" ".join, texts))), "doc_id long, text string")
    described = ngram_join._describe(docs).cache()
    sids = {r.doc_id: r.sid for r in described.where("bucket is null").collect()}
    number = {v: k for k, v in sids.items()}
    nodes = described.where("bucket is null").select("sid").distinct()
    pairs = nodes.withColumnRenamed("sid", "a").crossJoin(nodes.withColumnRenamed("sid", "b")).where(F.col("a") < F.col("b"))
    left = {tuple(sorted((number[r.a], number[r.b]))) for r in ngram_join._possible(pairs, described).collect()}
    assert left == {(0, 1), (4, 5)}
    found = {r.doc_id: r.component_id for r in ngram_join.similar_documents(docs).collect()}
    assert found == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6}


def test_wide_signatures_are_lower_bounds(spark):
    import numpy as np

    random.seed(9)
    sets = [np.array(sorted(random.sample(range(1 << 43), n)), np.uint64) for n in (1499, 1500, 4000, 20)]
    sets.append(np.sort(np.concatenate((sets[2][40:], sets[3]))))
    begin = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    wide = ngram_join._wide(np.concatenate(sets), begin)
    assert [x is None for x in wide.to_pylist()] == [True, False, False, True, False]
    rows = {i: np.array(wide[i].as_py(), np.int64).view(np.uint64) for i in (1, 2, 4)}
    for i, j in ((1, 2), (2, 4), (1, 4)):
        assert np.bitwise_count(rows[i] ^ rows[j]).sum() <= len(set(sets[i].tolist()) ^ set(sets[j].tolist()))
