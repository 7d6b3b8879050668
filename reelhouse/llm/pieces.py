"""Texts as sequences of distinct pieces, cut where a byte-level pre-tokenizer cuts anyway (Arrow and numpy, inside Spark tasks).

A cut stands before a single space that touches no other white space: the pre-tokenizer starts a new
pre-token there whatever surrounds it, so pieces can be encoded alone and their ids put side by side.
Python's white space holds all of the pre-tokenizer's, so a cut is never made where it would matter.

``cut`` makes shorter pieces by bytes, and more of them are equal.  It cuts before ASCII white space that follows
another character, and between a letter and an ASCII character that is none.  No pre-token goes on over
either border, none before it looks beyond it, and none after it looks back.  Letters are A-Z, a-z and U+00C0 to
U+00FF without the two signs there; a character whose last bytes could be those of Unicode white space is never cut behind.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are split together.
CHUNK = 8 << 20


def chunks(texts: pa.Array, limit: int = CHUNK) -> Iterator[pa.Array]:
    """Slices of about ``limit`` bytes, one text at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < len(texts):
        before = int(sizes[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(sizes, before + limit, "right")))
        yield texts.slice(i, j - i)
        i = j


def split(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pieces, the pieces of all texts as positions in that list, and where each text's pieces end.

    The concatenation of a text's pieces is the text; null has none.
    """
    lists = pc.split_pattern(pc.fill_null(texts, "").cast(pa.large_string()), " ")
    words = lists.flatten().dictionary_encode()
    index = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    distinct = words.dictionary.to_pylist()
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))

    opens = np.fromiter((w != "" and not w[0].isspace() for w in distinct), dtype=bool, count=len(distinct))
    closes = np.fromiter((w != "" and not w[-1].isspace() for w in distinct), dtype=bool, count=len(distinct))
    first = np.zeros(len(index), dtype=bool)
    first[np.append(0, ends)[:-1]] = True  # every text has one word at least, perhaps the empty one
    begins = first.copy()
    begins[1:] |= closes[index[:-1]] & opens[index[1:]]
    at = np.flatnonzero(begins)
    stop = np.append(at[1:], len(index))
    found = index[at]
    pieces = [" " + w for w in distinct]
    more: dict[str, int] = {}
    # first pieces of texts, which no space precedes, and words that touch white space
    for k in np.flatnonzero(first[at] | (stop - at > 1)).tolist():
        a, b = int(at[k]), int(stop[k])
        piece = " ".join([distinct[i] for i in index[a:b].tolist()])
        piece = piece if first[a] else " " + piece
        found[k] = more.setdefault(piece, len(pieces) + len(more))
    pieces.extend(more)
    return pieces, found, np.searchsorted(at, ends)


def encoded(texts: pa.Array, make: Callable[[list[str]], list[bytes]]) -> Iterator[bytes]:
    """The joined values of each text's pieces; ``make`` gets the distinct pieces of a chunk."""
    for part in chunks(texts):
        distinct, found, ends = split(part)
        value = make(distinct).__getitem__
        a = 0
        for b in ends.tolist():
            yield b"".join(map(value, found[a:b].tolist()))
            a = b


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins; one position more for the end."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if offsets is None or not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    starts = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[starts[0]:starts[-1]], starts - starts[0]


# classes of bytes; comparisons take no index of eight bytes a byte
def _white(b: np.ndarray) -> np.ndarray:
    return (b == 32) | ((b >= 9) & (b <= 13))


def _sign(b: np.ndarray) -> np.ndarray:
    return (b > 32) & (b < 127)


def _letter(b: np.ndarray) -> np.ndarray:
    return ((b | 32) >= 97) & ((b | 32) <= 122)


def _ends_dark(last: np.ndarray, before: np.ndarray) -> np.ndarray:
    """True where a character with these last two bytes is surely no white space; beyond ASCII the last byte but one decides."""
    return _sign(last) | ((last >= 0x80) & ((before & 0xFE) != 0x80) & (before != 0x9A) & (before != 0xC2))


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct short pieces, the pieces of all texts as positions among them, and where each text's pieces end.

    The concatenation of a text's pieces is the text; null and empty ones have none.
    """
    data, starts = raw(pc.fill_null(texts, ""))
    begins = np.zeros(len(data), dtype=bool)
    if len(data) > 1:
        last, before, this = data[:-1], np.append(np.uint8(0), data[:-2]), data[1:]
        letter = _letter(last) | ((before == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7))
        begins[1:] = (_white(this) & _ends_dark(last, before)) | (_sign(this) & ~_letter(this) & letter)
    begins[starts[:-1][starts[:-1] < starts[1:]]] = True
    at = np.flatnonzero(begins)
    parts = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(data))), pa.py_buffer(data)).dictionary_encode()
    return parts.dictionary, parts.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(at, starts[1:])


def borders(parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For pieces of ``cut``: 1 for white space first, 2 for surely another character first, 0 for neither; and whether
    the last character is surely no white space.  Pieces that are not empty.
    """
    data, starts = raw(parts)
    first, stop = data[starts[:-1]], starts[1:]
    before = np.where(stop - starts[:-1] > 1, data[np.maximum(stop - 2, 0)], 0)
    dark = _sign(first) | ((first >= 0xC3) & ((first < 0xE1) | (first > 0xE3)))
    return np.where(_white(first), 1, np.where(dark, 2, 0)), _ends_dark(data[stop - 1], before)
