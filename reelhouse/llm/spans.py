"""Vectorised word spans and 64-bit hashes over batches of documents (numpy, inside Spark tasks).

A batch is packed into one byte array with a separator byte between documents, so no
word or n-gram crosses documents.  Work memory is bounded: documents are packed in
chunks of about ``CHUNK`` bytes, and byte-wise hash tables cover ``SECTION`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
SECTION = 1 << 18
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), dtype=_U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


_POW = _powers(_BASE, SECTION + 1)
_INV = _powers(pow(_BASE, -1, 2**64), SECTION + 1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(pattern_bytes) -> np.ndarray:
    """A 256-entry table that is true for the given byte values."""
    table = np.zeros(256, dtype=bool)
    table[list(pattern_bytes)] = True
    return table


#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing: digits, a-z, every non-ASCII byte.
ALNUM = byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: ``[^\x20\x09-\x0D]``: everything but white space.
NON_SPACE = byte_class(set(range(256)) - {0x20, *range(0x09, 0x0E)})


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads all bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))


def binary_column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The UTF-8 bytes of a string column; null becomes empty."""
    col = batch.column(batch.schema.get_field_index(name))
    return pc.fill_null(col.cast(pa.large_binary()), b"").to_pylist()


def chunks(texts: list[bytes], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes together, one document at least."""
    i, total = 0, 0
    for j, t in enumerate(texts):
        if j > i and total + len(t) > limit:
            yield i, j
            i, total = j, 0
        total += len(t)
    if i < len(texts):
        yield i, len(texts)


def pack(texts: list[bytes], sep: bytes) -> tuple[np.ndarray, np.ndarray]:
    """One byte array of all texts, ``sep`` between them, and where each text starts."""
    data = np.frombuffer(sep.join(texts), dtype=np.uint8)
    lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    starts = np.zeros(len(texts), dtype=np.int64)
    np.cumsum(lens[:-1] + len(sep), out=starts[1:])
    return data, starts


def word_spans(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of maximal runs of bytes that ``table`` accepts."""
    flags = np.zeros(len(data) + 2, dtype=np.int8)
    flags[1:-1] = table[data]
    edges = np.flatnonzero(np.diff(flags))
    return edges[::2], edges[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span ``data[start:end]`` (starts and ends ascending, may overlap).

    A polynomial modulo 2^64 over per-byte codes, taken from prefix sums section by
    section; spans longer than a section are hashed with BLAKE2b (the length decides,
    so equal spans always take the same way).
    """
    out = np.empty(len(starts), dtype=_U)
    i, n = 0, len(starts)
    while i < n:
        base = int(starts[i])
        j = int(np.searchsorted(ends, base + SECTION, "right"))
        if j <= i:
            word = data[base:int(ends[i])].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
            i += 1
            continue
        part = data[base:int(ends[j - 1])]
        prefix = np.zeros(len(part) + 1, dtype=_U)
        np.cumsum(BYTE_CODE[part] * _POW[:len(part)], out=prefix[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((prefix[e] - prefix[s]) * _INV[s] + _U(0x2545F4914F6CDD1D) * (e - s).astype(_U))
        i = j
    return out


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all ``n`` consecutive word hashes; empty when there are fewer."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, dtype=_U)
    acc = np.zeros(m, dtype=_U)
    for t in range(n):
        acc *= _U(_BASE)
        acc += words[t:t + m]
    return mix(acc + _U(n))


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's signed bigint."""
    return x.view(np.int64)
