"""A task of the pipeline holds one Python worker at a time: executors keep every worker that a task has needed."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline

TEXTS = ["One small text, with words.", "", None, "Grüße 世界 🙂\n\n  and  blanks ", "One small text, with words."]


@pytest.fixture
def docs(spark):
    rows = [(i, "en", "web", t) for i, t in enumerate(TEXTS)] + [(None, None, None, "no id")]
    return spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")


def test_tokens_has_one_python_step_per_task(spark, docs):
    made = corpus_pipeline.tokens(spark, docs, "")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("MapInArrow", plan)) == 1


def test_tokens_of_odd_rows(spark, docs):
    from hashlib import sha256

    from markloom.llm import bpe
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(bpe.default_tokenizer())
    got = {r.doc_id: r for r in corpus_pipeline.tokens(spark, docs, "").collect()}
    assert len(got) == len(TEXTS) + 1
    for i, t in [*enumerate(TEXTS), (None, "no id")]:
        ids = made.encode(t or "", add_special_tokens=False).ids
        decoded = made.decode(ids, skip_special_tokens=False)
        assert (got[i].ids, got[i].n_tokens) == (ids, len(ids))
        assert got[i].decoded_sha256 == sha256(decoded.encode()).hexdigest()
