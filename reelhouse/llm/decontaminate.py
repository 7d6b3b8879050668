"""Benchmark decontamination: a broadcast hash set of benchmark word windows against all documents.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  A window is
``n`` consecutive words of an item; an item of fewer words, but not none, is one window.
Every window of every document is hashed and looked up in the broadcast set, each hit is
verified word by word against the item, and the hit spans or whole documents can be removed.

The benchmark is broadcast in blocks of at most ``block_bytes`` of text, each scanned
against all rows, so a broadcast never grows beyond that bound.  One block is one pass
with no shuffle; each further block is another pass that adds its hits to the row's.

Defined results: null and empty texts have no words, no hits and are clean; null items and
items without words have no windows; repeated rows are judged one by one; extra columns of
the input are kept unless a result column has the same name, which then replaces it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.llm import spans, tables

_NEW = ("n_words", "n_hit", "hit_items", "hit_spans")
RESULT = "n_words long, n_hit long, hit_items array<string>, hit_spans array<struct<start:int,end:int>>"
_BLOOM_BITS = 20


class Windows:
    """Windows of one block of items: by word count, hash -> exact word sequence -> item indexes."""

    def __init__(self, items: list[tuple[str, bytes]], n: int) -> None:
        self.ids = [item for item, _ in items]
        self.exact: dict[bytes, set[int]] = {}
        self.lengths: list[tuple[int, np.ndarray, np.ndarray]] = []
        by_length: dict[int, list[np.ndarray]] = {}
        for k, (_, text) in enumerate(items):
            data = spans.LOWER[np.frombuffer(text, dtype=np.uint8)]
            s, e = spans.word_spans(data, spans.ALNUM)
            if not len(s):
                continue
            size = min(n, len(s))
            words = [data[a:b].tobytes() for a, b in zip(s, e)]
            for j in range(len(words) - size + 1):
                self.exact.setdefault(b" ".join(words[j:j + size]), set()).add(k)
            by_length.setdefault(size, []).append(spans.gram_hashes(spans.span_hashes(data, s, e), size))
        for size, found in sorted(by_length.items()):
            hashes = np.unique(np.concatenate(found))
            bloom = np.zeros(1 << _BLOOM_BITS, dtype=bool)
            bloom[(hashes & np.uint64((1 << _BLOOM_BITS) - 1)).astype(np.int64)] = True
            self.lengths.append((size, hashes, bloom))

    def scan(self, texts: list[bytes], before: list) -> Iterator[tuple[int, int, list, list]]:
        """Per text: words, hit words, hit items, hit spans (byte offsets), joined with earlier blocks' hits."""
        data, first = spans.pack(texts, b"\x00")
        data = spans.LOWER[data]
        s, e = spans.word_spans(data, spans.ALNUM)
        hashes = spans.span_hashes(data, s, e)
        doc = np.searchsorted(first, s, "right") - 1
        n_words = np.bincount(doc, minlength=len(texts))
        hit = np.zeros(len(s) + 1, dtype=np.int64)
        found: dict[int, set[str]] = {}
        for d, earlier in enumerate(before):
            if earlier:
                found[d] = set(earlier[0])
                for a, b in earlier[1]:
                    hit[np.searchsorted(s, first[d] + a)] += 1
                    hit[np.searchsorted(s, first[d] + b)] -= 1
        for size, known, bloom in self.lengths:
            grams = spans.gram_hashes(hashes, size)
            at = np.flatnonzero(bloom[(grams & np.uint64(len(bloom) - 1)).astype(np.int64)])
            at = at[doc[at] == doc[at + size - 1]]
            near = np.searchsorted(known, grams[at])
            at = at[known[np.minimum(near, len(known) - 1)] == grams[at]]
            for k in at.tolist():
                items = self.exact.get(b" ".join(data[s[j]:e[j]].tobytes() for j in range(k, k + size)))
                if items:
                    hit[k] += 1
                    hit[k + size] -= 1
                    found.setdefault(int(doc[k]), set()).update(self.ids[i] for i in items)
        covered = np.cumsum(hit[:-1]) > 0
        n_hit = np.bincount(doc[covered], minlength=len(texts))
        for d in range(len(texts)):
            runs: list[tuple[int, int]] = []
            if d in found:
                lo, hi = np.searchsorted(doc, [d, d + 1])
                flags = np.zeros(hi - lo + 2, dtype=np.int8)
                flags[1:-1] = covered[lo:hi]
                edges = np.flatnonzero(np.diff(flags)) + lo
                runs = [(int(s[a] - first[d]), int(e[b - 1] - first[d])) for a, b in zip(edges[::2], edges[1::2])]
            yield int(n_words[d]), int(n_hit[d]), sorted(found.get(d, ())), runs


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of at most ``block_bytes`` of text (one item at least), streamed to the driver."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.coalesce("text", F.lit("")).cast("binary"))
    for item, text in rows.toLocalIterator():
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((item if item is not None else "", bytes(text)))
        size += len(text)
    yield block


def _scanned(docs: DataFrame, windows, text: str, again: bool) -> DataFrame:
    kept = [f for f in docs.schema.fields if f.name not in _NEW]
    out_type = pa.schema([
        ("n_words", pa.int64()), ("n_hit", pa.int64()), ("hit_items", pa.list_(pa.string())),
        ("hit_spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = spans.binary_column(batch, text)
            before = [None] * len(texts)
            if again:
                old = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("hit_items", "hit_spans")]
                before = [(i, [(x["start"], x["end"]) for x in r]) if i else None for i, r in zip(*old)]
            for i, j in spans.chunks(texts):
                found = list(windows.value.scan(texts[i:j], before[i:j]))
                cols = [[r[0] for r in found], [r[1] for r in found], [r[2] for r in found],
                        [[{"start": a, "end": b} for a, b in r[3]] for r in found]]
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(f.name)) for f in kept]
                    + [pa.array(c, type=t.type) for c, t in zip(cols, out_type)],
                    names=[f.name for f in kept] + out_type.names)

    return docs.mapInArrow(scan, T.StructType([*kept, *T.StructType.fromDDL(RESULT).fields]))


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = 13, text: str = "text",
                       block_bytes: int = 2 << 20) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hit_items`` (sorted item ids) and ``hit_spans`` (byte offsets)."""
    tables.ship(docs.sparkSession)
    broadcast = docs.sparkSession.sparkContext.broadcast
    out, again = docs.drop(*_NEW), False
    for block in _blocks(benchmark, block_bytes):
        if again:
            out = tables.written(out, "decontaminate-block")
        out, again = _scanned(out, broadcast(Windows(block, n)), text, again), True
    return out


def is_contaminated() -> F.Column:
    """Hits, and at least one word in twenty is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_documents(docs: DataFrame, benchmark: DataFrame, n: int = 13, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns."""
    found = find_contamination(tables.carried(docs, text), benchmark, n, text)
    return found.where(~is_contaminated()).select(f"{tables.ROW}.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 13, text: str = "text") -> DataFrame:
    """All rows of ``docs``; hit spans are cut out of the text (a null text stays null)."""
    found = find_contamination(docs, benchmark, n, text)
    data = F.col(text).cast("binary")
    kept = F.aggregate(
        "hit_spans", F.struct(F.lit(b"").alias("out"), F.lit(0).alias("at")),
        lambda acc, x: F.struct(F.concat(acc.out, F.substring(data, acc.at + 1, x.start - acc.at)).alias("out"),
                                x.end.alias("at")),
        lambda acc: F.concat(acc.out, F.substring(data, acc.at + 1, F.octet_length(text))))
    cut = F.when(F.size("hit_spans") > 0, kept.cast("string")).otherwise(F.col(text))
    return found.withColumn(text, cut).select(*docs.columns)


def report(docs: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    """One row per document: counts, a digest of the hit items, and the verdict."""
    found = find_contamination(docs.select("doc_id", "text"), benchmark, n)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), is_contaminated().alias("contaminated"))
