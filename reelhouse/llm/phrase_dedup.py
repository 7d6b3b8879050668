"""Suffix-array style substring dedup by prefix-free parsing, without sorting every suffix of the corpus.

A byte goes when a ``length``-byte string that covers it also starts in a document with a
smaller doc_id (strings are judged on the input; matches never cross documents).

Parsing.  A rolling hash of every ``trigger`` bytes is taken; in each window of ``length``
bytes the trigger with the smallest hash cuts the text (the leftmost on ties).  So every
window has a trigger, chosen by the window's bytes alone, and equal windows anywhere in the
corpus have the same trigger at the same offset.  The windows of one trigger occurrence form
a *phrase*: the run of window starts that choose it, with the bytes they cover.

Corpus order.  Only the order of the first ``length`` bytes of a suffix matters here, so
dictionary and parse are sorted to that depth, and only where it can decide something:

1. triggers: sorted by hash; those found in two documents or more are shared.  Windows of
   other triggers occur once, and leave the order here;
2. phrases of shared triggers: sorted by (trigger, phrase).  A phrase that a smaller document
   has too is a repeat as a whole; highly repetitive text costs one row a phrase, not a byte;
3. suffixes: a suffix's first ``length`` bytes hold the trigger with 17 bytes on its left or on
   its right.  Where two documents' different phrases share such a half, the suffixes with it are
   sorted by their first ``length`` bytes, and equal neighbours with a smaller document repeat.

Each step is one shuffle of packed keys (numpy arrays in binary rows, by key bucket).  Equal
keys of one batch of documents are merged before it: all but the smallest document know
their answer at once, so a passage that a third of all documents share costs one entry a
batch.  Texts are shuffled once, by doc_id, and joined with the answers.

Trigger keys (48 bits) only nominate; phrases are compared by 110-bit and suffixes by 80-bit
hashes, not byte by byte.

Defined results: null text is empty; texts shorter than ``length`` stay whole; rows that repeat
a doc_id are one document by name and never remove each other's bytes; a null doc_id counts as
larger than all others; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import spans, tables
from reelhouse.llm.packed import by_bucket, group_starts, sorted_entries, unpack

_U = np.uint64
_SECTION = spans.SECTION
_POS_BITS = 18
_POS = _U((1 << _POS_BITS) - 1)
_FLUSH = 32 << 20
_CODE2 = spans.mix(np.arange(1, 257, dtype=_U) * _U(0xC2B2AE3D27D4EB4F))
_LAST = np.int64(2**63 - 1)


@dataclass
class Phrases:
    """The phrases of some documents: parallel arrays, and hashes of any byte range of the section."""

    doc: np.ndarray       # index of the document in its batch
    start: np.ndarray     # first window start, in the document
    windows: np.ndarray   # number of window starts
    trigger: np.ndarray   # 48-bit hash of the trigger
    key: np.ndarray       # hash of trigger offset and phrase bytes; its low two bits are free for ``halves``
    halves: np.ndarray    # 32-bit hashes of the trigger with what is left, and right, of it (0: no window needs it)
    lo: np.ndarray        # first window start, in the section
    late: np.ndarray      # how many of the window starts hold the left half (they come first)
    data: np.ndarray


def _pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(document, offset, bytes) pieces packed into sections; long texts are cut with ``length - 1`` bytes overlap."""
    step = _SECTION - length
    out, size = [], 0
    for d, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), step):
            piece = text[at:at + step + length - 1] if len(text) > step else text
            if size + len(piece) > _SECTION and out:
                yield out
                out, size = [], 0
            out.append((d, at, piece))
            size += len(piece)
    if out:
        yield out


def _prefix(data: np.ndarray, code: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(code[data] * spans._POW[:len(data)], out=out[1:])
    return out


def _range_hash(prefix: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return spans.mix((prefix[hi] - prefix[lo]) * spans._INV[lo] + _U(0x2545F4914F6CDD1D) * (hi - lo).astype(_U))


def phrases(texts: list[bytes], length: int, trigger: int) -> Iterator[Phrases]:
    """The phrases of all texts, section by section."""
    for section in _pieces(texts, length):
        data = np.frombuffer(b"".join(p for _, _, p in section), dtype=np.uint8)
        n = len(data) - length + 1
        if n <= 0:
            continue
        lens = np.array([len(p) for _, _, p in section])
        first = np.append(0, np.cumsum(lens)[:-1])
        prefix = _prefix(data, spans.BYTE_CODE)
        at = np.arange(len(data) - trigger + 1)
        hashes = _range_hash(prefix, at, at + trigger)
        low = (hashes & ~_POS) | at.astype(_U)
        width, span = length - trigger + 1, 1
        while span < width:  # sliding minimum by doubling
            step = min(span, width - span)
            low = np.minimum(low[:len(low) - step], low[step:])
            span += step
        chosen = (low[:n] & _POS).astype(np.int64)
        inside = np.zeros(len(data) + 1, dtype=np.int8)
        ok = lens >= length
        inside[first[ok]] += 1
        np.add.at(inside, (first + lens - length + 1)[ok], -1)
        valid = np.cumsum(inside[:n]) > 0
        new = np.empty(n, dtype=bool)
        new[0] = True
        new[1:] = (chosen[1:] != chosen[:-1]) | (valid[1:] != valid[:-1])
        edge = np.append(np.flatnonzero(new), n)
        lo, hi = edge[:-1], edge[1:]
        keep = valid[lo]
        lo, hi = lo[keep], hi[keep]
        if not len(lo):
            continue
        a = chosen[lo]
        piece = np.searchsorted(first, lo, "right") - 1
        docs = np.array([d for d, _, _ in section])
        bases = np.array([b for _, b, _ in section])
        mark = hashes[a] >> _U(16)
        key = spans.mix(_range_hash(prefix, lo, hi + length - 1) + _U(0x9E3779B97F4A7C15) * (a - lo).astype(_U) + mark)
        # a window that starts ``half`` or more before the trigger holds its left half, any other its right half
        half = (length - trigger) // 2
        early = np.clip(a - half + 1 - lo, 0, hi - lo)
        left = _range_hash(prefix, np.maximum(a - half, 0), a + trigger) | _U(1)
        right = _range_hash(prefix, a, np.minimum(a + length - half, len(data))) | _U(1)
        halves = np.where(early > 0, left << _U(32), _U(0)) | np.where(early < hi - lo, right & _U(0xFFFFFFFF), _U(0))
        yield Phrases(docs[piece], lo - first[piece] + bases[piece], hi - lo, mark, key & ~_U(3), halves, lo, early, data)


def suffixes(p: Phrases, left: np.ndarray, right: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, window start, two hashes of the first ``length`` bytes) of phrases' suffixes.

    ``left`` chooses phrases whose suffixes with the left half are wanted, ``right`` those with the right half.
    """
    which = np.flatnonzero(left | right)
    skip = np.where(left[which], 0, p.late[which])
    n = np.where(right[which], p.windows[which], p.late[which]) - skip
    shift = np.arange(n.sum()) - np.repeat(np.append(0, np.cumsum(n)[:-1]), n) + np.repeat(skip, n)
    lo = np.repeat(p.lo[which], n) + shift
    one = _range_hash(_prefix(p.data, spans.BYTE_CODE), lo, lo + length)
    two = _range_hash(_prefix(p.data, _CODE2), lo, lo + length)
    return np.repeat(p.doc[which], n), np.repeat(p.start[which], n) + shift, one, two


# Rows between the passes: packed keys for a bucket, or answers for a document.

_ROW = "bucket int, doc_id long, payload binary, yes binary, open binary"
_ROW_NAMES = ["bucket", "doc_id", "payload", "yes", "open"]
_ROW_TYPES = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(_ROW_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(cols, _ROW_TYPES)], names=_ROW_NAMES)


def _answers(doc: np.ndarray, yes: np.ndarray, open_: np.ndarray | None = None) -> dict[int, list[bytes]]:
    """Per document the concatenated keys; ``yes`` and ``open_`` are (document, key) pairs."""
    out: dict[int, list[bytes]] = {}
    for k, pairs in enumerate((yes, open_)):
        if pairs is None or not len(pairs[0]):
            continue
        order = np.argsort(pairs[0], kind="stable")
        ids, keys = pairs[0][order], pairs[1][order]
        cut = np.append(np.flatnonzero(np.diff(ids, prepend=ids[0] - 1)), len(ids))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            out.setdefault(int(ids[a]), [b"", b""])[k] = keys[a:b].tobytes()
    return out


def _answer_rows(n_buckets: int, answers: dict[int, list[bytes]]) -> list[tuple]:
    return [(d % n_buckets, d, None, y or None, o or None) for d, (y, o) in answers.items()]


def _local(doc: np.ndarray, cols: list[np.ndarray], answer: Callable, n_buckets: int, width: int, shared: bool,
           route: int) -> list[tuple]:
    """Merge one batch's entries: direct answers, and one entry a key (its smallest document) for its bucket.

    ``shared``: a key of two documents is answered for both; else for the larger one only.  ``route`` is the
    column that chooses the bucket, ``width`` the bytes of the first column that travel.
    """
    doc, cols = sorted_entries(cols, doc)
    new = group_starts(cols)
    several = ~new
    if shared:
        several = several | np.append(~new[1:], False)
    rows = _answer_rows(n_buckets, _answers(doc, (doc[several], answer([c[several] for c in cols]))))
    doc, cols = doc[new], [c[new] for c in cols]
    bucket = (spans.mix(cols[route] + _U(1)) % _U(n_buckets)).astype(np.int64)
    rows += [(b, None, payload, None, None) for b, payload in by_bucket(doc, cols, bucket, width)]
    return rows


def _doc_ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(batch.schema.get_field_index("doc_id")).fill_null(int(_LAST)).to_numpy(zero_copy_only=False).astype(np.int64)


class _Answers:
    """The answers that the documents of a batch got in one column, looked up by (document index, key)."""

    def __init__(self, batch: pa.RecordBatch, column: str) -> None:
        docs, keys = [np.empty(0, np.int64)], [np.empty(0, _U)]
        for i, parts in enumerate(batch.column(batch.schema.get_field_index(column)).to_pylist()):
            for part in parts or ():
                keys.append(np.frombuffer(part, dtype=_U))
                docs.append(np.full(len(keys[-1]), i))
        self.docs = np.unique(np.concatenate(docs))
        self.known = np.sort(self._mixed(np.concatenate(docs), np.concatenate(keys)))

    @staticmethod
    def _mixed(doc: np.ndarray, keys: np.ndarray) -> np.ndarray:
        return spans.mix(keys + _U(0x9E3779B97F4A7C15) * (doc.astype(_U) + _U(1)))

    def has(self, doc: np.ndarray, keys: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(doc), dtype=bool)
        asked = self._mixed(doc, keys)
        at = np.searchsorted(self.known, asked)
        return self.known[np.minimum(at, len(self.known) - 1)] == asked


def _open_halves(p: Phrases, open_: _Answers) -> tuple[np.ndarray, np.ndarray]:
    one, two, both = (open_.has(p.doc, p.key | _U(bits)) for bits in (1, 2, 3))
    return one | both, two | both


def _emit(select: Callable, answer: Callable, n_buckets: int, width: int, shared: bool, route: int = 0):
    """A mapInArrow function: ``select(batch)`` yields (document index, key columns) pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, cols, size = [], [], 0

        def flush():
            return _rows(_local(np.concatenate(docs), [np.concatenate(c) for c in zip(*cols)], answer, n_buckets, width, shared, route))

        for batch in batches:
            ids = _doc_ids(batch)
            for doc, found, n_bytes in select(batch):
                if len(doc):
                    docs.append(ids[doc])
                    cols.append(found)
                size += n_bytes
                if size >= _FLUSH and docs:
                    yield flush()
                    docs, cols, size = [], [], 0
        if docs:
            yield flush()
    return run


def _settle(n_cols: int, width: int, judge: Callable):
    """An applyInArrow function over one bucket: ``judge(doc, cols)`` gives the answers to entries sorted by key and document."""
    def run(group: pa.Table) -> pa.Table:
        payloads = [x for x in group.column("payload").to_pylist() if x]
        rows = [(None, d, None, y, o) for d, y, o in zip(*(group.column(c).to_pylist() for c in ("doc_id", "yes", "open")))
                if d is not None]
        if payloads:
            parts = [unpack(x, n_cols, width) for x in payloads]
            doc, cols = sorted_entries([np.concatenate(c) for c in zip(*(c for _, c in parts))], np.concatenate([d for d, _ in parts]))
            rows += [(None, *x[1:]) for x in _answer_rows(1, judge(doc, cols))]
        return pa.Table.from_batches([_rows(rows)]).select(["doc_id", "yes", "open"])
    return run


def _answered(rows: DataFrame, n_cols: int, width: int, judge: Callable, names: tuple[str, str]) -> DataFrame:
    found = rows.groupBy("bucket").applyInArrow(_settle(n_cols, width, judge), "doc_id long, yes binary, open binary")
    return found.groupBy("doc_id").agg(F.collect_list("yes").alias(names[0]), F.collect_list("open").alias(names[1]))


def _shared_triggers(doc: np.ndarray, cols: list[np.ndarray]) -> dict:
    new = group_starts(cols)
    several = ~new | np.append(~new[1:], False)
    return _answers(doc, (doc[several], cols[0][several]))


def _repeated_phrases(doc: np.ndarray, cols: list[np.ndarray]) -> dict:
    """Repeats of a smaller document's phrase; and first phrases that share a half with another document's.

    The low bits of an open phrase's key say which: 1 the left half, 2 the right half.
    """
    new = group_starts(cols[:2])
    trigger, key, halves, first = cols[0][new], cols[1][new], cols[2][new], doc[new]
    flags = np.zeros(len(key), dtype=_U)
    for bit, half in ((1, halves >> _U(32)), (2, halves & _U(0xFFFFFFFF))):
        order = np.lexsort((first, half, trigger))
        group = group_starts([trigger[order], half[order]])
        number = np.cumsum(group) - 1
        other = group_starts([trigger[order], half[order], first[order]])
        shared = (np.bincount(number, weights=other)[number] > 1) & (half[order] > 0)
        flags[order[shared]] |= _U(bit)
    open_ = flags > 0
    return _answers(doc, (doc[~new], cols[1][~new]), (first[open_], key[open_] | flags[open_]))


def _repeated_suffixes(doc: np.ndarray, cols: list[np.ndarray]) -> dict:
    later = ~group_starts(cols)
    return _answers(doc, (doc[later], cols[1][later]))


def _cut(docs: DataFrame, length: int, trigger: int, text: str):
    """The last pass: bytes of repeats are marked, cut out and described."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = spans.binary_column(batch, text)
            ids = batch.column(batch.schema.get_field_index("row_id"))
            whole, open_, late = (_Answers(batch, c) for c in ("phrase_yes", "phrase_open", "suffix_yes"))
            marks: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

            def mark(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
                cut = np.append(np.flatnonzero(np.diff(doc, prepend=-1)), len(doc))
                for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
                    marks.setdefault(int(doc[a]), []).append((lo[a:b], hi[a:b]))

            todo = np.union1d(whole.docs, late.docs)
            for p in phrases([texts[i] for i in todo.tolist()], length, trigger) if len(todo) else ():
                p.doc = todo[p.doc]
                yes = whole.has(p.doc, p.key)
                mark(p.doc[yes], p.start[yes], p.start[yes] + p.windows[yes] + length - 1)
                left, right = _open_halves(p, open_)
                if left.any() or right.any():
                    doc, start, one, _ = suffixes(p, left, right, length)
                    hit = late.has(doc, one)
                    mark(doc[hit], start[hit], start[hit] + length)
            rows = []
            for d, body in enumerate(texts):
                edges = np.empty(0, dtype=np.int64)
                if d in marks:
                    step = np.zeros(len(body) + 1, dtype=np.int32)
                    for lo, hi in marks[d]:
                        np.add.at(step, lo, 1)
                        np.add.at(step, hi, -1)
                    gone = np.zeros(len(body) + 2, dtype=np.int8)
                    gone[1:-1] = np.cumsum(step[:-1]) > 0
                    edges = np.flatnonzero(np.diff(gone))
                spans_ = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
                at, kept = 0, []
                for a, b in spans_:
                    kept.append(body[at:a])
                    at = b
                left = b"".join([*kept, body[at:]]) if spans_ else body
                rows.append((len(body), len(body) - len(left), len(spans_), hashlib.sha256(left).hexdigest(),
                             [{"start": a, "end": b} for a, b in spans_]))
            cols = list(zip(*rows)) if rows else [[]] * 5
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(list(c), pa.int64()) for c in cols[:3]), pa.array(list(cols[3]), pa.string()),
                 pa.array(list(cols[4]), span)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed_spans"])
    return run


def repeated_bytes(docs: DataFrame, length: int = 50, trigger: int = 16, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and removed_spans (byte offsets)."""
    spark = docs.sparkSession
    tables.ship(spark)
    # a bucket answers each document in one row: the same least number keeps these rows in proportion
    n_buckets = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    null_id = F.lit(int(_LAST)).cast("long")
    docs = docs.select(F.coalesce("doc_id", null_id).alias("doc_id"), F.col("doc_id").alias("row_id"), F.col(text).alias(text))

    def triggers(batch):
        texts = spans.binary_column(batch, text)
        for p in phrases(texts, length, trigger):
            yield p.doc, [p.trigger], len(p.data)

    def shared_phrases(batch):
        shared = _Answers(batch, "trigger_yes")
        for p in phrases(spans.binary_column(batch, text), length, trigger):
            at = np.flatnonzero(shared.has(p.doc, p.trigger))
            yield p.doc[at], [p.trigger[at], p.key[at], p.halves[at]], len(p.data)

    def open_suffixes(batch):
        open_ = _Answers(batch, "phrase_open")
        for p in phrases(spans.binary_column(batch, text), length, trigger):
            left, right = _open_halves(p, open_)
            if left.any() or right.any():
                doc, _, one, two = suffixes(p, left, right, length)
                yield doc, [two & _U(0xFFFF), one], len(p.data)

    by_doc = docs.repartition("doc_id")
    rows = docs.mapInArrow(_emit(triggers, lambda c: c[0], n_buckets, 6, True), _ROW)
    flagged = _answered(rows, 1, 6, _shared_triggers, ("trigger_yes", "_"))
    rows = by_doc.join(flagged.drop("_").hint("shuffle_hash"), "doc_id").mapInArrow(
        _emit(shared_phrases, lambda c: c[1], n_buckets, 6, False), _ROW)
    judged = _answered(rows, 3, 6, _repeated_phrases, ("phrase_yes", "phrase_open"))
    rows = by_doc.join(judged.where(F.size("phrase_open") > 0).drop("phrase_yes").hint("shuffle_hash"), "doc_id").mapInArrow(
        _emit(open_suffixes, lambda c: c[1], n_buckets, 2, False, route=1), _ROW)
    late = _answered(rows, 2, 2, _repeated_suffixes, ("suffix_yes", "_"))
    all_ = (by_doc.join(judged.hint("shuffle_hash"), "doc_id", "left")
            .join(late.drop("_").hint("shuffle_hash"), "doc_id", "left"))
    return all_.mapInArrow(
        _cut(docs, length, trigger, text),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "removed_spans array<struct<start:int,end:int>>")


def report_of(docs: DataFrame, length: int, trigger: int) -> DataFrame:
    """Counts and a digest of what stays, per row."""
    return repeated_bytes(docs, length, trigger).drop("removed_spans")


def report(docs: DataFrame) -> DataFrame:
    return report_of(docs, length=50, trigger=16)


def remove_repeats(docs: DataFrame, length: int = 50, text: str = "text") -> DataFrame:
    """(doc_id, text) of ``docs`` with the repeated bytes cut out; invalid UTF-8 at a cut becomes U+FFFD.

    Rows that repeat a doc_id must have the same text here, as they are joined by name.
    """
    found = repeated_bytes(docs, length, text=text).select("doc_id", "removed_spans").dropDuplicates(["doc_id"])
    data = F.col(text).cast("binary")
    kept = F.aggregate(
        "removed_spans", F.struct(F.lit(b"").alias("out"), F.lit(0).alias("at")),
        lambda acc, x: F.struct(F.concat(acc.out, F.substring(data, acc.at + 1, x.start - acc.at)).alias("out"),
                                x.end.alias("at")),
        lambda acc: F.concat(acc.out, F.substring(data, acc.at + 1, F.octet_length(text))))
    joined = docs.select("doc_id", text).join(found, "doc_id", "left")
    return joined.select("doc_id", F.when(F.size("removed_spans") > 0, F.decode(kept, "UTF-8")).otherwise(F.col(text)).alias(text))
