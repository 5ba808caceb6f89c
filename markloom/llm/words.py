"""Words of whole texts as 64-bit hashes, for numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are looked at together.
SLAB = 1 << 20
_P = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def byte_class(text: bytes) -> np.ndarray:
    """A table of 256 that is true at the given bytes."""
    table = np.zeros(256, bool)
    table[np.frombuffer(text, np.uint8)] = True
    return table


#: Words as runs of anything but white space, and as runs of digits, a-z and non-ASCII characters.
NOT_SPACE = ~byte_class(b" \t\n\x0b\x0c\r")
LETTERS = byte_class(b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64; made once per task and grown as texts need it."""

    def __init__(self, base: int = _P):
        self.base = base
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            room = 1 << max(16, (n - 1).bit_length())
            self.up, self.down = (self._run(b, room) for b in (self.base, pow(self.base, -1, 1 << 64)))

    @staticmethod
    def _run(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


def running(codes: np.ndarray, powers: Powers) -> np.ndarray:
    """Running sums that ``sum_hashes`` takes the hash of any run from; one more than codes."""
    powers.grow(len(codes) + 1)
    total = np.zeros(len(codes) + 1, np.uint64)
    value = codes.astype(np.uint64)
    value += np.uint64(1)
    value *= powers.up[: len(codes)]
    np.cumsum(value, out=total[1:])
    return total


def sum_hashes(total: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """Hash of codes[start:end] for each pair: equal runs have equal hashes wherever they stand."""
    value = total[end]
    value -= total[start]
    value *= powers.down[start]
    value ^= (end - start).astype(np.uint64) * np.uint64(_P)
    return mix(value)


def run_hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """``sum_hashes`` of codes that are looked at once."""
    return sum_hashes(running(codes, powers), start, end, powers)


def _hashes(data: bytes, kind: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer(data.lower(), np.uint8)  # of bytes, A-Z only
    inside = np.zeros(len(codes) + 2, bool)
    np.take(kind, codes, out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    return run_hashes(codes, start, end, powers), start, end - start


def sized_words(texts: list[bytes], kind: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``word_hashes``, and the bytes of each word."""
    if sum(map(len, texts)) <= 2 * SLAB:
        hashes, start, size = _hashes(b"\n".join(texts), kind, powers)
        ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
        return hashes, np.concatenate(([0], np.searchsorted(start, ends))).astype(np.int64), size
    parts, sizes, bounds = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [0]
    for t in texts:
        n = 0
        for piece in _pieces(t, kind):
            h, _, size = _hashes(piece, kind, powers)
            parts.append(h)
            sizes.append(size)
            n += len(h)
        bounds.append(bounds[-1] + n)
    return np.concatenate(parts), np.array(bounds, np.int64), np.concatenate(sizes)


def word_hashes(texts: list[bytes], kind: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, A-Z in lower case, and where each text's words begin (one more than texts)."""
    return sized_words(texts, kind, powers)[:2]


def _pieces(text: bytes, kind: np.ndarray) -> Iterator[bytes]:
    """Cut a very long text between words."""
    at = 0
    while len(text) - at > SLAB:
        gaps = np.flatnonzero(~kind[np.frombuffer(text[at : at + SLAB].lower(), np.uint8)])
        if len(gaps):
            cut = at + int(gaps[-1]) + 1
        else:
            rest = np.flatnonzero(~kind[np.frombuffer(text[at + SLAB :].lower(), np.uint8)])
            cut = at + SLAB + int(rest[0]) + 1 if len(rest) else len(text)
        yield text[at:cut]
        at = cut
    yield text[at:]


def slabs(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLAB) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows with about ``size`` bytes of text (one row at least), and the texts, null ones empty."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        lengths = np.diff(np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)) if len(column) else np.zeros(0, int)
        at = 0
        while at < len(batch):
            n = max(1, int(np.searchsorted(np.cumsum(lengths[at : at + 65536]), size, "right")))
            part = column.slice(at, n).to_pylist()
            yield batch.slice(at, n), [x or b"" for x in part]
            at += n


def lists(flat: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat))
