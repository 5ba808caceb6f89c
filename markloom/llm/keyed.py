"""Runs of equal keys in batches that arrive sorted by key, for numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

Columns = dict[str, np.ndarray]


def arrays(batch: pa.RecordBatch) -> Columns:
    return {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(batch.schema.names)}


def joined(parts: list[Columns]) -> Columns:
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]} if len(parts) > 1 else parts[0]


def taken(c: Columns, where: np.ndarray | slice) -> Columns:
    return {k: v[where] for k, v in c.items()}


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[Columns]:
    """Blocks of rows that end where a group of equal keys ends."""
    held: list[Columns] = []
    for batch in batches:
        if not len(batch):
            continue
        c = arrays(batch)
        k = c[key]
        cut = int(np.searchsorted(k, k[-1], "left")) if k[0] != k[-1] else 0
        if held and (cut or held[-1][key][-1] != k[0]):
            if held[-1][key][-1] != k[0]:
                yield joined(held)
                held = []
        if cut:
            held.append(taken(c, slice(0, cut)))
            yield joined(held)
            held = [taken(c, slice(cut, None))]
        else:
            held.append(c)
    if held:
        yield joined(held)


def bounds(key: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, and the end."""
    return np.concatenate((np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))), [len(key)]))


def record_batch(c: Columns, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c[f.name], f.type) for f in schema], schema=schema)
