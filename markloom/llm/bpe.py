"""Byte-level BPE encoding with content-defined chunk reuse, and decoding.

A rolling hash over ``WINDOW`` bytes cuts texts into chunks where its low bits are zero, so equal passages
give equal chunks wherever they stand. Of each chunk the part between its first and last agreed place is
encoded once per task and looked up from then on. An agreed place is a blank between two ASCII letters or
digits: the pre-tokeniser always starts a piece there, so what is encoded on either side cannot differ from
the whole text's encoding. A chunk join is repaired by encoding it anew from the last agreed place before
it to the first one after it; a chunk without agreed places becomes part of that join, which so grows until
both sides agree, over the whole text if need be.

New chunks and joins are put together from their words: what stands between the places where a byte-level
pre-tokeniser starts a piece, or between agreed places if the tokenizer is no such one or the text holds an added
token. A word is encoded once per task and looked up from then on.

Encoding is narrow: nothing is shuffled, and a task holds ``KEPT_BYTES`` of known pieces and ``WORD_BYTES`` of known
words at most. The tokenizer's file is read on the driver and sent once.

Defined results: null and empty texts have no ids and decode to the empty text; repeated rows are encoded
one by one; an empty table gives an empty one; ids that the vocabulary lacks decode to nothing; other
columns are carried along.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from itertools import chain, filterfalse, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import byte_class, mix, slabs

WINDOW = 16
#: A chunk ends where so many low bits of the rolling hash are zero: about 1 KB.
CHUNK_BITS = 10
KEPT_BYTES = 32 << 20
WORD_BYTES = 48 << 20
_GEAR = mix(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)
_ALNUM = byte_class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the WINDOW bytes that begin at each place, in log2(WINDOW) steps."""
    h, width, factor = _GEAR[data], 1, 0x9E3779B1
    while width < WINDOW and len(h) > width:
        h = h[:-width] * np.uint32(factor) + h[width:]
        width, factor = width * 2, factor * factor & 0xFFFFFFFF
    return h ^ (h >> np.uint32(15))


def _starts() -> np.ndarray:
    """Whether a piece starts between two bytes: ASCII letters, digits, punctuation, apostrophe, blank and line break are told apart.

    A piece ends where letters, digits or punctuation end. Blanks join what follows, and so does an apostrophe before
    letters; how white space is cut depends on what follows, so nothing ends behind it.
    """
    kind = np.zeros(256, np.uint8)
    kind[33:127] = 3
    kind[_ALNUM] = 1
    kind[48:58] = 2
    kind[ord("'")], kind[ord(" ")], kind[ord("\n")] = 4, 5, 6
    ends = np.zeros((7, 7), bool)
    ends[1, 2:], ends[2, [1, 3, 4, 5, 6]], ends[3, [1, 2, 5, 6]] = True, True, True
    return ends[kind[:, None], kind[None, :]]


_STARTS = _starts()


def word_places(codes: np.ndarray) -> np.ndarray:
    """Places where a byte-level pre-tokeniser starts a piece, whatever stands around them; not all of them."""
    return np.flatnonzero(_STARTS[codes[:-1], codes[1:]]) + 1


def agreed_places(codes: np.ndarray) -> np.ndarray:
    plain = _ALNUM[codes]
    return np.flatnonzero((codes[1:-1] == 32) & plain[:-2] & plain[2:]) + 1


def cuts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Chunk ends and agreed places of some text."""
    codes = np.frombuffer(data, np.uint8)
    if len(codes) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.flatnonzero(rolling(codes) & np.uint32((1 << CHUNK_BITS) - 1) == 0) + WINDOW
    return ends, agreed_places(codes)


def pieces(data: bytes) -> list[bytes]:
    """The text as chunk bodies and repaired joins, in order; each can be encoded alone."""
    ends, agreed = cuts(data)
    ends = ends[ends < len(data)]
    if not len(ends) or not len(agreed):
        return [data] if data else []
    after = np.searchsorted(agreed, ends)
    before = np.searchsorted(agreed, ends, "right") - 1
    places = np.concatenate((agreed[before[before >= 0]], agreed[after[after < len(agreed)]]))
    edges = [0, *np.unique(places).tolist(), len(data)]
    return [data[a:b] for a, b in zip(edges[:-1], edges[1:]) if a < b]


class Words:
    """Ids of the words of chunks: numbered, with the ids of all numbers one after the other."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], special: list[bytes] | None):
        """``special`` are texts that are found before the pre-tokeniser cuts; None says that it is no byte-level one."""
        self.encode, self.special = encode, special
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids, self.begin, self.held = np.zeros(0, np.int32), np.zeros(1, np.int64), 0

    def _learn(self, fresh: list[bytes]) -> None:
        made = self.encode([p.decode() for p in fresh])
        self.number.update(zip(fresh, range(len(self.number), len(self.number) + len(fresh))))
        self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(made), np.int32)))
        self.begin = np.concatenate((self.begin, self.begin[-1] + np.cumsum([len(ids) for ids in made])))
        self.held += sum(map(len, fresh)) + 200 * len(fresh)

    def ids_of(self, chunks: list[bytes]) -> list[np.ndarray]:
        """The ids of each chunk, as if encoded alone."""
        if self.held > WORD_BYTES:
            self.forget()
        if not chunks:
            return []
        data = b"".join(chunks)
        starts = np.concatenate(([0], np.cumsum([len(c) for c in chunks])))
        codes = np.frombuffer(data, np.uint8)
        edge = np.zeros(len(data) + 1, bool)
        if self.special is not None and not any(x in data for x in self.special):
            edge[word_places(codes)] = True
        else:
            edge[agreed_places(codes)] = True
            edge[starts[1:] - 1] = False  # a blank at the end of a chunk has no letter behind it
        edge[starts] = True
        edges = np.flatnonzero(edge)
        words = [data[a:b] for a, b in pairwise(edges.tolist())]
        if fresh := list(set(filterfalse(self.number.__contains__, words))):
            self._learn(fresh)
        row = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        size = np.diff(self.begin)[row]
        total = np.concatenate(([0], np.cumsum(size)))
        value = self.ids[np.arange(total[-1]) + np.repeat(self.begin[row] - total[:-1], size)]
        cut = total[np.searchsorted(edges, starts)]
        return [value[a:b].copy() for a, b in pairwise(cut.tolist())]


def special_texts(tokenizer_json: str) -> list[bytes] | None:
    """The added tokens of a tokenizer that cuts texts as byte-level ones do, None for another one."""
    data = json.loads(tokenizer_json)
    rule = data.get("pre_tokenizer") or {}
    usual = rule.get("type") == "ByteLevel" and rule.get("use_regex", True) and not rule.get("add_prefix_space") and not data.get("normalizer")
    return [a["content"].encode() for a in data.get("added_tokens", [])] if usual else None


def encode(docs: DataFrame, tokenizer: str | None = None, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of the whole text as the column ``ids``."""
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as f:
        made_of = f.read()
    sent = docs.sparkSession.sparkContext.broadcast((made_of, special_texts(made_of)))
    schema = T.StructType([*(f for f in docs.schema if f.name != ids), T.StructField(ids, T.ArrayType(T.IntegerType()))])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made_of, special = sent.value
        made = Tokenizer.from_str(made_of)
        made.no_truncation()
        made.no_padding()
        words = Words(lambda texts: [e.ids for e in made.encode_batch_fast(texts, add_special_tokens=False)], special)
        known: dict[bytes, np.ndarray] = {}
        held = 0
        for batch, texts in slabs(batches, text):
            cut = [pieces(t) for t in texts]
            fresh = list({p for ps in cut for p in ps if p not in known})
            for p, found in zip(fresh, words.ids_of(fresh)):
                known[p] = found
                held += 200 + len(p) + known[p].nbytes
            flat = [known[p] for ps in cut for p in ps]
            sizes = [sum(len(known[p]) for p in ps) for ps in cut]
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            values = np.concatenate(flat) if flat else np.zeros(0, np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in names[:-1]), column], names=names)
            if held > KEPT_BYTES:
                known, held = {}, 0

    return docs.mapInArrow(run, schema)


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable, else from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def token_bytes(tokenizer_json: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens, one after the other, and where each token's begin."""
    data = json.loads(tokenizer_json)
    alphabet = byte_alphabet()
    tokens = {i: t for t, i in data["model"]["vocab"].items()} | {a["id"]: a["content"] for a in data["added_tokens"]}

    def raw(token: str) -> bytes:
        return bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()

    each = [raw(tokens[i]) if i in tokens else b"" for i in range(max(tokens) + 1)]
    return np.frombuffer(b"".join(each), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in each])))


#: Ids that are decoded together.
DECODED = 250_000


def decode(coded: DataFrame, tokenizer: str | None = None, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Replace the ids by the text they stand for, special tokens included, in the column ``text``."""
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as f:
        sent = coded.sparkSession.sparkContext.broadcast(token_bytes(f.read()))
    schema = T.StructType([*(f for f in coded.schema if f.name not in (ids, text)), T.StructField(text, T.StringType())])
    names = schema.names

    def texts(column: pa.ListArray) -> Iterator[str]:
        data, begin = sent.value
        value = column.flatten().to_numpy()
        ends = np.concatenate(([0], np.cumsum([0 if n is None else n for n in pa.compute.list_value_length(column).to_pylist()])))
        value = np.where((value >= 0) & (value < len(begin) - 1), value, -1)
        start, size = begin[value], np.where(value < 0, 0, begin[value + 1] - begin[value])
        total = np.concatenate(([0], np.cumsum(size)))
        out = data[np.arange(total[-1]) + np.repeat(start - total[:-1], size)].tobytes()
        for a, b in zip(total[ends[:-1]], total[ends[1:]]):
            yield out[a:b].decode("utf-8", "replace")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            sizes = np.array([n or 0 for n in pa.compute.list_value_length(column).to_pylist()])
            at = 0
            while at < len(batch):
                n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), DECODED, "right")))
                part = batch.slice(at, n)
                own = pa.array(list(texts(column.slice(at, n))), pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in names[:-1]), own], names=names)
                at += n

    return coded.mapInArrow(run, schema)


def token_digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The contract's columns: encode, then decode the ids."""
    coded = encode(docs.select("doc_id", "text"), tokenizer).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        "ids",
    )
    return decode(coded, tokenizer).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
