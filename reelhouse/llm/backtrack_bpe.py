"""Exact byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

Instead of merging pairs, the encoder walks a pre-token from left to right.  An Aho-Corasick automaton
gives the longest token that starts where the last one ended.  The walk takes it if its border with the token
before is compatible, else the next shorter prefix that is a token, else goes back one token and marks the
position as one from which no encoding follows.  Every position is marked at most once, so the walk is
linear in the pre-token for a fixed vocabulary.

Two tokens are compatible when no merge crosses the border between them: undoing their merges from the latest to
the earliest, no pair across the border may have a merge that comes earlier than the one undone (for the right
token also not the same merge, as the leftmost of equal merges comes first).  Answers are kept in a table
of bounded size.  A sequence of tokens with compatible borders is the one that merging gives, and there is
only one.  Tokens that merging never makes from their own bytes take no part.

Pre-tokens of code points below U+0558 are found by the pre-tokenizer's pattern; other pieces go through the
tokenizer file's own pre-tokenizer, whose tables of letters and digits belong to another version of Unicode.
Equal pieces of a chunk of texts are encoded once; a bounded memo keeps the ids of pre-tokens between chunks.

Decoding concatenates the bytes between two offsets of one byte string for each id; bytes that are not
UTF-8 become U+FFFD as in the tokenizer's decoder.

Defined results: a null text is empty and has no ids; a null doc_id stays null; a null list of ids decodes to the
empty text, and null or unknown ids in it to nothing; rows that repeat are kept; an empty table gives no
rows; texts of any length are encoded whole; other columns of the input are ignored, whatever their names.
Tokenizer files that need something else than this method (normalisation, another pre-tokenizer, dropout, tokens made
by two merges, special tokens that take white space) raise ValueError.
"""

from __future__ import annotations

import json
import os
import re
import string
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import pieces, tables

#: The pre-tokenizer's pattern, a fixed value of the byte-level format.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Below this code point the pattern's classes are the same in all versions of Unicode that are in use.
PLAIN = "՘"
#: Borders that the compatibility table keeps.
BORDERS = 400_000
#: Pre-tokens whose ids are kept, in two generations, and the longest of them.
TOKENS, LONGEST = 600_000, 64


def byte_symbols() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for the code points from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Vocabulary:
    """What the encoder and the decoder need of a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        ok = (model.get("type") == "BPE" and spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
              and pre.get("add_prefix_space") is False and pre.get("use_regex", True) is True and not model.get("dropout")
              and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix") and not model.get("ignore_merges"))
        if not ok:
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        for t in spec.get("added_tokens", ()):
            if t.get("single_word") or t.get("lstrip") or t.get("rstrip") or any(c.isspace() for c in t["content"]) or not t["content"]:
                raise ValueError(f"{path}: added token {t['content']!r} takes more than its own text")
        self.ids: dict[str, int] = model["vocab"]
        self.merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.byte_of = {s: b for b, s in enumerate(byte_symbols())}

    def raw(self, token: str) -> bytes:
        """The bytes of a token; one with other symbols stands for its own text."""
        if all(c in self.byte_of for c in token):
            return bytes(map(self.byte_of.__getitem__, token))
        return token.encode()


class Encoder:
    """Pre-tokens to ids.  Inside, tokens are numbered by merge: bytes 0 to 255, then one a merge."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        import ahocorasick

        symbols = byte_symbols()
        number = {s: b for b, s in enumerate(symbols)}
        self.left, self.right = list(range(256)), list(range(256))
        self.merge: dict[tuple[int, int], int] = {}
        for a, b in vocabulary.merges:
            if a + b in number:
                raise ValueError(f"two merges make the token {a + b!r}")
            at = number[a + b] = len(self.left)
            self.left.append(number[a])
            self.right.append(number[b])
            self.merge[number[a], number[b]] = at
        names = list(number)
        self.out = [vocabulary.ids[s] if s in vocabulary.ids else -1 for s in names]
        text = [vocabulary.raw(s).decode("latin-1") for s in names]
        self.size = [len(s) for s in text]

        # a token counts when merging makes it of its own bytes: no merge before its last one crosses its halves
        alive = [True] * len(names)
        for t in range(256, len(names)):
            a, b = self.left[t], self.right[t]
            alive[t] = alive[a] and alive[b] and self._apart(a, b, t)
        self.known = {text[t]: t for t in range(len(names)) if alive[t]}
        self.shorter = [-1] * len(names)
        for t in self.known.values():
            s = text[t]
            self.shorter[t] = next((self.known[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in self.known), -1)
        self.matcher = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for s, t in self.known.items():
            self.matcher.add_word(s, t)
        self.matcher.make_automaton()
        self.borders: dict[int, bool] = {}

    def _apart(self, a: int, b: int, limit: int) -> bool:
        """True if no merge that comes before ``limit`` crosses the border between tokens ``a`` and ``b``."""
        while True:
            if self.merge.get((a, b), limit) < limit:
                return False
            if a < 256 and b < 256:
                return True
            if a > b:
                limit, a = a, self.right[a]
            else:
                limit, b = b + 1, self.left[b]

    def _compatible(self, a: int, b: int) -> bool:
        key = a * len(self.left) + b
        known = self.borders.get(key)
        if known is None:
            if len(self.borders) >= BORDERS:
                self.borders.clear()
            known = self.borders[key] = self._apart(a, b, len(self.left))
        return known

    def pre_token(self, raw: bytes) -> list[int]:
        """The ids of one pre-token."""
        s = raw.decode("latin-1")  # one character a byte
        whole = self.known.get(s)
        if whole is not None:
            return [self.out[whole]]
        taken: list[int] = []
        pos = 0
        for end, t in self.matcher.iter_long(s):
            if taken and not self._compatible(taken[-1], t):
                break
            taken.append(t)
            pos = end + 1
        if pos < len(s):
            self._backtrack(s, taken, pos, t)
        return [self.out[t] for t in taken]

    def _backtrack(self, s: str, taken: list[int], pos: int, t: int) -> None:
        """Go on from ``taken``, which ends at ``pos`` and whose next longest token is ``t``."""
        size, shorter, n = self.size, self.shorter, len(s)
        dead = bytearray(n + 1)
        while pos < n:
            end = pos + size[t]
            if not dead[end] and (not taken or self._compatible(taken[-1], t)):
                taken.append(t)
                pos = end
                t = next(self.matcher.iter_long(s, pos))[1] if pos < n else -1
            elif shorter[t] >= 0:
                t = shorter[t]
            else:
                dead[pos] = 1
                t = taken.pop()
                pos -= size[t]


class TextEncoder:
    """Arrow strings to ids as little-endian 32-bit numbers."""

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import pre_tokenizers

        vocabulary = Vocabulary(path)
        self.encoder = Encoder(vocabulary)
        self.find = regex.compile(PRE_TOKEN).findall
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.special = vocabulary.special
        marks = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, marks)) + ")") if marks else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _pre_tokens(self, text: str) -> list[str]:
        plain = text.isascii() or max(text, default="") < PLAIN
        body = text.rstrip(string.punctuation)
        if plain and (body[1:] if body[:1] == " " else body).isalpha():
            return [body, text[len(body):]] if len(body) < len(text) else [body]
        return self.find(text) if plain else [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def _token(self, token: str) -> bytes:
        ids = self.old.get(token)
        if ids is None:
            found = self.encoder.pre_token(token.encode())
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(token) <= LONGEST:
            if len(self.young) >= TOKENS // 2:
                self.young, self.old = {}, self.young
            self.young[token] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        out: list[bytes] = []
        for i, part in enumerate(self.cut.split(piece) if self.cut else (piece,)):
            if i % 2:
                out.append(struct.pack("<I", self.special[part]))
            else:
                out.extend([self.young.get(t) or self._token(t) for t in self._pre_tokens(part)])
        return b"".join(out)

    def __call__(self, texts: pa.Array) -> Iterator[bytes]:
        return pieces.encoded(texts, lambda distinct: [self._piece(p) for p in distinct])


class Decoder:
    """Ids to text: the bytes of id ``i`` lie between two offsets of one byte string."""

    def __init__(self, path: str) -> None:
        vocabulary = Vocabulary(path)
        known = {i: vocabulary.raw(t) for t, i in vocabulary.ids.items()} | {i: t.encode() for t, i in vocabulary.special.items()}
        parts = [known.get(i, b"") for i in range(max(known, default=-1) + 1)]
        self.offsets = np.cumsum([0, *map(len, parts)])
        self.data = np.frombuffer(b"".join(parts), dtype=np.uint8)

    def __call__(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, and where the bytes of each id end."""
        ids = np.where((ids >= 0) & (ids < len(self.offsets) - 1), ids, -1)
        start = np.where(ids >= 0, self.offsets[ids], 0)
        size = np.where(ids >= 0, self.offsets[ids + 1] - start, 0)
        ends = np.cumsum(size)
        at = np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
        return self.data[at], ends


_TOOLS: dict[tuple, object] = {}


def _tool(kind, path: str):
    """One encoder or decoder a worker and file."""
    if (kind, path) not in _TOOLS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _TOOLS[kind, path] = kind(path)
    return _TOOLS[kind, path]


def _encoded(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    """Batches (doc_id, ids) of batches (doc_id, text), about one chunk of text each."""
    encoder = _tool(TextEncoder, tokenizer)
    for batch in batches:
        at = 0
        for part in pieces.chunks(batch.column(1)):
            made = list(encoder(part))
            ends = np.cumsum([0, *(len(b) // 4 for b in made)])
            ids = pa.array(np.frombuffer(b"".join(made), dtype="<u4").astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, len(part)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)], names=["doc_id", "ids"])
            at += len(part)


def _decoded(batches: Iterator[pa.RecordBatch], tokenizer: str, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches (doc_id, ids, text) of batches (doc_id, ids)."""
    decoder = _tool(Decoder, tokenizer)
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            part = batch.slice(i, rows)
            lists = part.column(1)
            ids = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            data, ends = decoder(ids)
            cuts = np.append(0, ends)[np.append(0, np.cumsum(sizes))].tolist()
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))


def _kind(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """(doc_id, ids) for each row; ``tokenizer`` is the path of a ``tokenizers`` file, present on every executor."""
    Encoder(Vocabulary(tokenizer))  # an unfit file is an error of the caller, not of a task
    tables.ship(docs.sparkSession)
    return _texts(docs, text).mapInArrow(lambda batches: _encoded(batches, tokenizer), f"doc_id {_kind(docs)}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, text) of rows (doc_id, ids)."""
    tables.ship(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(
        lambda batches: _decoded(batches, tokenizer), f"doc_id {_kind(encoded)}, ids array<int>, text string")


def round_trip(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """(doc_id, ids, text): ``decode(encode(docs))`` in one worker a task."""
    Encoder(Vocabulary(tokenizer))
    tables.ship(docs.sparkSession)
    return _texts(docs, text).mapInArrow(
        lambda batches: _decoded(_encoded(batches, tokenizer), tokenizer), f"doc_id {_kind(docs)}, ids array<int>, text string")


def report(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Encode, decode what was encoded, and describe both: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    found = round_trip(docs, tokenizer, text)
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                        F.sha2("text", 256).alias("decoded_sha256"))
