"""Packed keys: many (document, key columns) entries in one binary value.

A payload holds the documents (ascending, as differences) with their number of entries, then
each key column.  The first column may be cut to its low ``width`` bytes.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64


def pack(doc: np.ndarray, cols: list[np.ndarray], width: int = 8) -> bytes:
    """Entries that are sorted by document."""
    ids, counts = np.unique(doc, return_counts=True)
    out = [np.array([len(ids), len(doc)], dtype=np.int64).tobytes(), np.diff(ids, prepend=0).tobytes(),
           counts.astype(np.uint32).tobytes()]
    for i, c in enumerate(cols):
        out.append(c.tobytes() if i or width == 8 else c.view(np.uint8).reshape(-1, 8)[:, :width].tobytes())
    return b"".join(out)


def unpack(payload: bytes, n_cols: int, width: int = 8) -> tuple[np.ndarray, list[np.ndarray]]:
    n_ids, n = np.frombuffer(payload, dtype=np.int64, count=2).tolist()
    at = 16
    ids = np.cumsum(np.frombuffer(payload, dtype=np.int64, count=n_ids, offset=at))
    at += 8 * n_ids
    counts = np.frombuffer(payload, dtype=np.uint32, count=n_ids, offset=at)
    at += 4 * n_ids
    cols = []
    for i in range(n_cols):
        size = 8 if i else width
        raw = np.frombuffer(payload, dtype=np.uint8, count=size * n, offset=at).reshape(n, size)
        at += size * n
        wide = np.zeros((n, 8), dtype=np.uint8)
        wide[:, :size] = raw
        cols.append(wide.view(_U).ravel())
    return np.repeat(ids, counts), cols


def by_bucket(doc: np.ndarray, cols: list[np.ndarray], bucket: np.ndarray, width: int = 8) -> list[tuple[int, bytes]]:
    """One (bucket, payload) for each bucket that has entries."""
    order = np.lexsort((doc, bucket))
    doc, cols, bucket = doc[order], [c[order] for c in cols], bucket[order]
    cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    return [(int(bucket[a]), pack(doc[a:b], [c[a:b] for c in cols], width)) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]


def sorted_entries(cols: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Entries by columns, then document; repeats dropped."""
    order = np.lexsort((doc, *reversed(cols)))
    doc, cols = doc[order], [c[order] for c in cols]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in (*cols, doc)], axis=0)
    return doc[new], [c[new] for c in cols]


def group_starts(cols: list[np.ndarray]) -> np.ndarray:
    """True where the columns differ from the entry before."""
    new = np.ones(len(cols[0]), dtype=bool)
    if len(new):
        new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
    return new
