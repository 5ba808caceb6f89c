"""The methods of the operators against brute force, and their time on texts with very many matches."""

from __future__ import annotations

import math
import re
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from markloom.llm import pii, quality_rules, secrets_scan, sharding

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def disclosed(texts, support=pii.SUPPORT, least=pii.GENERALISE_AT):
    """Term -> greatest share, over mail addresses in the texts."""
    n, entities, frequency, met = len(texts), defaultdict(set), defaultdict(set), defaultdict(dict)
    for i, t in enumerate(texts):
        terms = {w.lower() for w in re.findall(r"[^\W\d_]{3,}", EMAIL.sub(" ", t))}
        seen = defaultdict(set)
        found = list(EMAIL.finditer(t))
        for k, m in enumerate(found):
            lo = found[k - 1].end() if k else 0
            hi = found[k + 1].start() if k + 1 < len(found) else len(t)
            seen[m.group()].add((t[max(lo, m.start() - pii.AROUND) : m.start()], t[m.end() : min(hi, m.end() + pii.AROUND)]))
        for e in seen:
            assert len(seen[e]) == 1  # one address, one place: no choice between surroundings
            entities[e].add((i, *seen[e]))
        for w in terms:
            frequency[w].add(i)
        for e in seen:
            for w in terms:
                met[e, w][i] = next(iter(seen[e]))
    out = {}
    for (e, w), docs in met.items():
        ne, nt = len(entities[e]), len(frequency[w])
        if len(set(docs.values())) < support or ne == n:
            continue
        share = math.log(n * len(docs) / (ne * nt)) / math.log(n / ne)
        if share >= least:
            out[w] = max(share, out.get(w, 0))
    return out


def test_disclosing_terms_match_brute_force(spark):
    import random

    random.seed(5)
    word = lambda k: "".join(random.choice("abcdefg") for _ in range(k))
    common, rare = [word(4) for _ in range(30)], [word(6) for _ in range(8)]
    texts = []
    for i in range(240):
        words = [random.choice(common) for _ in range(25)]
        if i % 3 == 0:
            who = i // 3 % 4
            words.insert(random.randrange(25), f"p{who}@x.org")
            words += [rare[who]] * (random.random() < 0.9) + [rare[who + 4]] * (random.random() < 0.4)
        if i % 40 == 7:
            words.append(random.choice(rare))
        texts.append(" ".join(words))
    texts += [texts[0]] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = disclosed(texts)
    assert want
    got = {r.doc_id: r.terms for r in pii.find_pii(docs).collect()}
    for i, t in enumerate(texts):
        found = [(m.start(), m.end(), m.group()) for m in re.finditer(r"[^\W\d_]{3,}", t) if m.group() in want]
        assert [(x.s, x.e, x.term) for x in got[i]] == found
        assert all(x.share == pytest.approx(want[x.term]) for x in got[i])


def test_disclosing_terms_go_far_from_their_entity_and_without_it(spark):
    filler = lambda i: " ".join(f"plain words number {c * 3}" for c in "abcdefghij"[i % 4 :]) + " "
    said = [(i, f"{i} boss@corp.example {filler(i)}{filler(i + 1)}Zebrafish") for i in range(20)]
    alone = [(50, "The zebrafish swims"), (51, None), (52, ""), (None, "zebrafish ézebra@corp.example")]
    other = [(100 + i, f"{filler(i)} for {i}") for i in range(400)]
    docs = spark.createDataFrame(said + alone + other, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    # 20 of 424 documents have the address, 22 the term: a share of 0.97, removed.
    assert clean[0] == f"0 [EMAIL] {filler(0)}{filler(1)}" and clean[50] == "The  swims"
    assert clean[51] == clean[52] == "" and clean[None] == " é[EMAIL]" and clean[100] == other[0][1]


def test_time_grows_with_the_matches(spark):
    made = {
        pii.pii_digests: lambda n: " ".join(f"10.{i // 250 % 250}.{i % 250}.7 word" for i in range(n)),
        secrets_scan.secret_digests: lambda n: " ".join(f"password = abc{i:05d} some_longer_identifier_{i}" for i in range(n)),
    }
    for digests, text in made.items():
        took = []
        for n in (4000, 4000, 16000):  # the first one warms up
            docs = spark.createDataFrame([(1, text(n))], "doc_id long, text string")
            start = time.time()
            row = digests(docs).first()
            took.append(time.time() - start)
            assert max(row[1:5], key=lambda x: x if isinstance(x, int) else 0) == n
        assert took[2] <= 6 * took[1] + 1


def test_tokens_apart_from_spans(spark):
    spans = [(0, "assign", 0, 40, ""), (2, "hex", 5, 30, ""), (0, "assign", 90, 120, "")]
    tokens = [(3, "random", 10, 26, "in both"), (3, "random", 31, 39, "in the longer"), (3, "random", 40, 60, "between"),
              (3, "random", 70, 91, "into the next"), (3, "random", 120, 140, "behind")]
    df = spark.createDataFrame([(spans, tokens), (spans, []), ([], tokens)], f"a {secrets_scan.SPANS}, b {secrets_scan.SPANS}")
    got = [[x.v for x in r.c] for r in df.select(secrets_scan._apart(F.col("b"), F.col("a")).alias("c")).collect()]
    assert got == [["between", "behind"], [], [t[4] for t in tokens]]


def test_limits_tighten_in_a_uniform_source(spark):
    words = lambda i: " ".join(f"w{i:03d}x{k:02d}" for k in range(40))
    line = lambda i, k: f"{words(i)} line {k} of text"
    docs = [(i, "en", "a", "\n".join(line(10 * i + k, k) for k in range(5))) for i in range(60)]
    symbols = words(1) + " ###" * 9  # 9 % symbols
    lines = "\n".join(line(k, k) for k in range(6)) + "\n" + "\n".join(f"short {k}\nshort {k}" for k in range(6))
    docs += [(100, "en", "a", symbols), (101, "en", "a", lines), (102, "en", "b", symbols), (103, None, None, words(2)), (104, "en", "a", None)]
    df = spark.createDataFrame(docs, "doc_id long, lang string, source string, text string").repartition(2)
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules.quality_verdicts(df).collect()}
    assert all(got[i] == (False, True) for i in range(60))
    assert got[100] == (False, False) and got[101] == (False, False)
    assert got[102] == (False, True) and got[103] == (False, True) and got[104] == (True, False)


def brute_shards(docs, limit):
    """doc_id -> prefix, by splitting buckets bit by bit."""
    out = {}

    def put(rows, depth):
        if len(rows) <= 1 or sum(n for _, _, n in rows) <= limit or depth == sharding.BITS:
            for i, h, _ in rows:
                out[i] = f"{h:0{sharding.BITS}b}"[:depth]
            return
        for bit in (0, 1):
            half = [r for r in rows if r[1] >> (sharding.BITS - depth - 1) & 1 == bit]
            if half:
                put(half, depth + 1)

    put(docs, 0)
    return out


def test_oversized_documents_and_the_directory(spark):
    texts = [(i, "x" * 50) for i in range(6)] + [(6, "y" * 1000), (7, "z" * 700), (8, None), (9, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assigned = sharding.assign(docs, 200).persist()
    rows = assigned.collect()
    assert {r.doc_id: r.shard for r in rows} == brute_shards([(r.doc_id, r.h, r.n_bytes) for r in rows], 200)
    entries = sharding.directory(assigned)
    for e in entries.collect():
        assert all((e.first_hash <= r.h <= e.last_hash) == (r.shard == e.shard) for r in rows)
    found = {r.doc_id: r.shard for r in sharding.locate(docs, entries).collect()}
    assert found == {r.doc_id: r.shard for r in rows}
    assert sharding.locate(docs.limit(0), entries).count() == 0 == sharding.directory(sharding.assign(docs.limit(0))).count()


def test_shards_keep_columns_of_clashing_names(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * 50, f"s{i}", i * 2, "r") for i in range(9)], "doc_id long, text string, shard string, h long, row string")
    name = sharding.write_shards(docs, str(tmp_path / "out"), 200)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert name == "shard_" and sorted(map(tuple, back.select(*docs.columns).collect())) == sorted(map(tuple, docs.collect()))
