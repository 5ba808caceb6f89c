"""Words that a task has met are looked up, and give the ids of the whole text."""

from __future__ import annotations

import random

from tokenizers import Tokenizer

from markloom.llm import bpe


def _made():
    with open(bpe.default_tokenizer(), encoding="utf-8") as f:
        text = f.read()
    return Tokenizer.from_str(text), bpe.special_texts(text)


def test_a_word_is_encoded_once():
    made, special = _made()
    asked: list[str] = []

    def encode(texts):
        asked.extend(texts)
        return [e.ids for e in made.encode_batch_fast(texts, add_special_tokens=False)]

    words = bpe.Words(encode, special)
    chunks = [f"One line, number {i}; the same words again.".encode() for i in range(200)]
    got = words.ids_of(chunks[:100]) + words.ids_of(chunks[100:])
    assert [g.tolist() for g in got] == [made.encode(c.decode(), add_special_tokens=False).ids for c in chunks]
    assert len(asked) == len(set(asked)) <= 220


def test_chunks_of_any_text_are_encoded_as_alone():
    made, special = _made()
    random.seed(4)
    signs = [*"ab Zé'’\n\t .,!19-<|>²́日😀", "'s", "'ll", "  ", "\n\n", " \n", "<|endoftext|>", "don't", "\r\n", "\x00", "٣"]
    for kind in (special, None):
        words = bpe.Words(lambda texts: [e.ids for e in made.encode_batch_fast(texts, add_special_tokens=False)], kind)
        for _ in range(400):
            chunks = ["".join(random.choices(signs, k=random.randrange(1, 25))).encode() for _ in range(4)]
            want = [made.encode(c.decode(), add_special_tokens=False).ids for c in chunks]
            assert [g.tolist() for g in words.ids_of(chunks)] == want
        assert words.ids_of([]) == []
