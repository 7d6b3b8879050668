"""Token ids with Elias-Fano document boundaries: encode, write, read back.

A run of the writer makes a folder of files ``ids-<partition>-<file>.eft``, in ascending
doc_id order over (partition, file).  All numbers are little-endian; a file holds whole documents:

====================  =======================================================================
header                ``EFT1``, then 8 unsigned 64-bit numbers: documents, ids, bytes an id
                      (2 or 4), low bits, partition, file number, ids of this partition
                      before the file, bytes of the high part
document ids          documents x signed 64-bit (null is the largest value)
low part              documents x ``low bits``, packed
high part             unary codes of the high halves of the boundaries
samples               for each 256th document the bit position of its boundary (32-bit)
ids                   the concatenated ids
====================  =======================================================================

Document i ends at boundary b(i) (the ids up to and with its end id).  Elias-Fano stores
b(i) in about 2 + log2(ids / documents) bits: ``low bits`` of it verbatim, the rest as the
position of the i-th one in the high part; ``select`` starts from the nearest sample, so no
table of 64-bit offsets exists on disk or in memory beyond one file.

A task writes its files under a name of its own attempt and renames them when complete.  The
content depends on the partition's rows alone, so a retry or a second attempt writes the same.

Encoding.  Texts are encoded with the ``tokenizers`` library.  They are cut where a byte-level pre-tokenizer cuts
whatever stands there (``pieces.cut``), so a text's ids are those of its pieces.  The distinct pieces of a chunk are
found in Arrow; those that a bounded memo does not hold go through the tokenizer once, many in a row as one text, and
the ids of a row are parted by the bytes that they stand for.  Pieces whose borders are not known to part in a row, and
rows that do not part, are encoded alone, as are all pieces where the model is no plain byte-level BPE.  A run of white space
(Unicode, no-break spaces among it) stays inside one piece; texts that
hold an added token of the tokenizer are encoded whole, and so is every text of a tokenizer whose
pre-tokenizer is not exactly the byte-level one with its own pattern.

Text that spells a special token (``<|endoftext|>``) is that token if ``literal_specials`` is false,
as ``Tokenizer.from_file`` alone has it, and plain text if it is true.

Defined results: null texts are empty and have just the end id; a null doc_id sorts last;
repeated rows are written one by one; other columns of the input are ignored; an empty input
makes an empty result.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import pieces, tables

MAGIC = b"EFT1"
SAMPLE = 256
_HEADER = struct.Struct("<4s8Q")
_NULL_ID = 2**63 - 1
#: Bytes of pieces that are encoded as one text.
ROW_BYTES = 1 << 15


class EliasFano:
    """A non-decreasing sequence of ``n`` numbers below or equal ``top``."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(1, n)).bit_length() - 1)
        values = values.astype(np.uint64)
        low = b""
        if low_bits:
            bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
            low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        flags[ones] = 1
        return cls(n, low_bits, low, np.packbits(flags, bitorder="little").tobytes(), ones[::SAMPLE].astype(np.uint32))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), dtype=np.int64)
        at = i[:, None] * self.low_bits + np.arange(self.low_bits)
        raw = np.frombuffer(self.low, dtype=np.uint8)
        bits = (raw[at >> 3] >> (at & 7)) & 1
        return (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)

    def select(self, i: int) -> int:
        """The i-th number, from the sample before it."""
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte = at >> 3
        word = self.high[byte] >> (at & 7)
        at_bit = at
        while True:
            ones = word.bit_count()
            if ones > left:
                break
            left -= ones
            byte += 1
            at_bit = byte << 3
            word = self.high[byte]
        while True:
            if word & 1:
                if left == 0:
                    break
                left -= 1
            word >>= 1
            at_bit += 1
        return ((at_bit - i) << self.low_bits) | int(self._low(np.array([i]))[0])

    def all(self) -> np.ndarray:
        """All numbers in order."""
        flags = np.unpackbits(np.frombuffer(self.high, dtype=np.uint8), bitorder="little")
        i = np.arange(self.n)
        return ((np.flatnonzero(flags)[:self.n] - i) << self.low_bits) | self._low(i)


def file_bytes(doc_ids: np.ndarray, ends: np.ndarray, ids: bytes, width: int, partition: int, number: int, before: int) -> bytes:
    ef = EliasFano.of(ends)
    header = _HEADER.pack(MAGIC, len(doc_ids), len(ids) // width, width, ef.low_bits, partition, number, before, len(ef.high))
    return b"".join([header, doc_ids.astype("<i8").tobytes(), ef.low, ef.high, ef.samples.astype("<u4").tobytes(), ids])


class TokenFile:
    """One file read back: documents, their boundaries and ids."""

    def __init__(self, data: bytes) -> None:
        magic, n, self.n_ids, self.width, low_bits, self.partition, self.number, self.before, high = _HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = _HEADER.size
        self.doc_ids = np.frombuffer(data, dtype="<i8", count=n, offset=at)
        at += 8 * n
        low_size, n_samples = (n * low_bits + 7) // 8, -(-n // SAMPLE)
        low, high_part = data[at:at + low_size], data[at + low_size:at + low_size + high]
        at += low_size + high
        samples = np.frombuffer(data, dtype="<u4", count=n_samples, offset=at)
        at += 4 * n_samples
        self.ends = EliasFano(n, low_bits, low, high_part, samples)
        self.ids = np.frombuffer(data, dtype=f"<u{self.width}", count=self.n_ids, offset=at)

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document of the file, with its end id."""
        return self.ids[self.ends.select(i - 1) if i else 0:self.ends.select(i)]


class Encoder:
    """Texts to packed ids, with a bounded memo of pieces."""

    def __init__(self, path: str, end_id: int, literal_specials: bool = True, memo: int = 600_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal_specials
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.width = 2 if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.end = self._packed([end_id])
        # pieces may be encoded apart by a byte-level tokenizer that cuts words itself and changes nothing else
        spec = json.loads(self.tokenizer.to_str())
        self.direct = spec["normalizer"] is None and _cuts_words(spec["pre_tokenizer"])
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.sizes = _token_sizes(spec["model"], end_id, self.added)
        # piece to number; the ids of piece k lie between starts[k] and starts[k + 1]
        self.memo, self.limit = {}, memo
        self.ids, self.starts = np.zeros(0, dtype=self.dtype), np.zeros(1, dtype=np.int64)

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _encoded(self, texts: list[str]) -> Iterator[np.ndarray]:
        for i in range(0, len(texts), 1000):
            for e in self.tokenizer.encode_batch_fast(texts[i:i + 1000], add_special_tokens=False):
                yield np.array(e.ids, dtype=self.dtype)

    def _row(self, parts: pa.Array, sep: str) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of pieces that are encoded in rows, each followed by ``sep``, and where each piece's ids begin and
        end; None where the ids do not part there."""
        sizes = pc.binary_length(parts).to_numpy(zero_copy_only=False).astype(np.int64) + len(sep)
        stops = np.cumsum(sizes)
        rows = np.append(np.flatnonzero(np.diff(stops // ROW_BYTES)) + 1, len(parts))
        whole = pc.binary_join_element_wise(parts, *pa.array(["", sep], pa.large_string())) if sep else parts
        data, at = pieces.raw(whole)
        cuts = at[np.append(0, rows)].tolist()
        texts = [data[a:b].tobytes().decode() for a, b in zip(cuts[:-1], cuts[1:]) if a < b]
        found = [e for i in range(0, len(texts), 16) for e in self._encoded(texts[i:i + 16])]
        ids = np.concatenate(found)
        ends = np.cumsum(self.sizes[ids])
        bounds = np.append(0, np.searchsorted(ends, stops) + 1)
        if bounds[-1] != len(ids) or (ends[bounds[1:] - 1] != stops).any():
            return None
        if not sep:
            return ids, np.stack([bounds[:-1], bounds[1:]])
        tails = np.searchsorted(ends, stops - len(sep)) + 1
        return (ids, np.stack([bounds[:-1], tails])) if (ends[tails - 1] == stops - len(sep)).all() else None

    def _new(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct pieces side by side, and how many each has."""
        first, dark = pieces.borders(parts)
        alone = np.ones(len(parts), dtype=bool)
        begin, size, flat, base = np.zeros(len(parts), dtype=np.int64), np.zeros(len(parts), dtype=np.int64), [], 0
        # a piece that begins with white space may follow another one at once, one that does not after a line feed
        for kind, sep in ((1, ""), (2, "\n")) if self.sizes is not None else ():
            some = np.flatnonzero((first == kind) & dark)
            row = self._row(parts.take(pa.array(some)), sep) if len(some) else None
            if row is not None:
                alone[some] = False
                begin[some], size[some] = row[1][0] + base, row[1][1] - row[1][0]
                flat.append(row[0])
                base += len(row[0])
        some = np.flatnonzero(alone)
        for k, ids in zip(some.tolist(), self._encoded(parts.take(pa.array(some)).to_pylist())):
            begin[k], size[k] = base, len(ids)
            flat.append(ids)
            base += len(ids)
        return _gathered(np.concatenate(flat), begin, size), size

    def _known(self, distinct: pa.Array) -> np.ndarray:
        """The numbers of distinct pieces; those that the memo lacks are encoded."""
        names = distinct.to_pylist()
        numbers = np.fromiter(map(self.memo.get, names, repeat(-1)), dtype=np.int64, count=len(names))
        new = np.flatnonzero(numbers < 0)
        # long pieces are not found again: their ids go when the memo begins again with the pieces of this chunk
        if len(self.memo) + len(new) > self.limit or len(self.ids) > 16 * self.limit:
            self.memo, old = {}, np.flatnonzero(numbers >= 0)
            begin = self.starts[numbers[old]]
            size = self.starts[numbers[old] + 1] - begin
            self.ids, self.starts = _gathered(self.ids, begin, size), np.append(0, np.cumsum(size))
            numbers[old] = np.arange(len(old))
            self.memo.update((names[i], k) for k, i in enumerate(old.tolist()) if len(names[i]) <= 64)
        if len(new):
            ids, size = self._new(distinct.take(pa.array(new)))
            numbers[new] = np.arange(len(new)) + len(self.starts) - 1
            self.ids = np.concatenate([self.ids, ids])
            self.starts = np.append(self.starts, self.starts[-1] + np.cumsum(size))
            self.memo.update((names[i], k) for i, k in zip(new.tolist(), numbers[new].tolist()) if len(names[i]) <= 64)
        return numbers

    def encode(self, texts) -> Iterator[bytes]:
        """The ids of each text and the end id; null is empty."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not self.direct:
            for part in pieces.chunks(texts):
                yield from (ids.tobytes() + self.end for ids in self._encoded(pc.fill_null(part, "").to_pylist()))
            return
        for part in pieces.chunks(texts):
            whole = pa.array(np.zeros(len(part), dtype=bool))
            for mark in self.added:
                whole = pc.or_(whole, pc.fill_null(pc.match_substring(part, mark), False))
            distinct, found, ends = pieces.cut(pc.if_else(whole, "", part))
            numbers = self._known(distinct)[found]
            begin = self.starts[numbers]
            size = self.starts[numbers + 1] - begin
            ids = _gathered(self.ids, begin, size).tobytes()
            stops = (np.append(0, np.cumsum(size))[ends] * self.width).tolist()
            for i, (a, b, alone) in enumerate(zip([0, *stops], stops, whole.to_pylist())):
                yield (next(self._encoded([part[i].as_py()])).tobytes() if alone else ids[a:b]) + self.end


def _gathered(ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Slices of ``ids`` side by side."""
    ends = np.cumsum(size)
    at = np.repeat(begin - (ends - size), size)
    at += np.arange(len(at))
    return ids[at]


def _token_sizes(model: dict, end_id: int, added: list[str]) -> np.ndarray | None:
    """The bytes that each id of a plain byte-level BPE model stands for; None for other models."""
    plain = (model.get("type") == "BPE" and not model.get("dropout") and not model.get("unk_token") and not model.get("byte_fallback")
             and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
             and not any(c.isspace() for mark in added for c in mark))
    if not plain:
        return None
    sizes = np.zeros(max([end_id, *model["vocab"].values()]) + 1, dtype=np.int64)
    for token, i in model["vocab"].items():
        sizes[i] = len(token)  # one character a byte
    return sizes


def _cuts_words(pre_tokenizer: dict | None) -> bool:
    """True for exactly the byte-level pre-tokenizer with its own pattern and without a space put before the text."""
    spec = dict(pre_tokenizer or {})
    spec.pop("trim_offsets", None)  # says where a token's text lies, not what it is
    return spec == {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


_ENCODERS: dict[tuple, Encoder] = {}


def _open(folder: str):
    """File system and path of a folder: local, or any that Arrow can open."""
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder if not folder.startswith("file:/") or folder.startswith("file://") else "file://" + folder[5:])
    return pafs.LocalFileSystem(), folder


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, text: str = "text",
                 file_ids: int = 4 << 20, literal_specials: bool = True) -> DataFrame:
    """Write all documents to ``folder``; the result lists the files (partition, file, before, documents, ids).

    ``tokenizer`` is the path of a ``tokenizers`` file, present on every executor.
    """
    tables.ship(docs.sparkSession)
    rows = docs.select(F.coalesce("doc_id", F.lit(_NULL_ID)).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (tokenizer, end_id, literal_specials)
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(tokenizer, end_id, literal_specials=literal_specials)
        encoder = _ENCODERS[key]
        context = TaskContext.get()
        partition, attempt = context.partitionId(), context.taskAttemptId()
        fs, root = _open(folder)
        fs.create_dir(root, recursive=True)
        made: list[tuple[int, int, int, int, int]] = []
        doc_ids: list[int] = []
        ids: list[bytes] = []
        size, before = 0, 0

        def close() -> None:
            nonlocal doc_ids, ids, size, before
            ends = np.cumsum(np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // encoder.width)
            name = f"{root}/ids-{partition:06d}-{len(made):06d}.eft"
            with fs.open_output_stream(f"{name}.{attempt}.part") as out:
                out.write(file_bytes(np.array(doc_ids, dtype=np.int64), ends, b"".join(ids), encoder.width, partition, len(made), before))
            fs.move(f"{name}.{attempt}.part", name)
            made.append((partition, len(made), before, len(doc_ids), size))
            before += size
            doc_ids, ids, size = [], [], 0

        for batch in batches:
            for d, packed in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                doc_ids.append(d)
                ids.append(packed)
                size += len(packed) // encoder.width
                if size >= file_ids:
                    close()
        if doc_ids:
            close()
        cols = list(zip(*made)) if made else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols],
                                         names=["partition", "file", "before", "documents", "ids"])

    return rows.mapInArrow(run, "partition long, file long, before long, documents long, ids long")


def read_tokens(spark, folder: str) -> DataFrame:
    """The files' documents: partition, doc_id, start in the partition, n_tokens, crc32 of the ids as 32-bit numbers."""
    tables.ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                f = TokenFile(data.as_py())
                ends = f.ends.all()
                starts = np.append(0, ends)[:-1]
                crcs = [zlib.crc32(f.ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ends), f.partition, dtype=np.int64)),
                     pa.array(f.doc_ids, pa.int64(), mask=f.doc_ids == _NULL_ID),
                     pa.array(starts + f.before, pa.int64()), pa.array(ends - starts, pa.int64()), pa.array(crcs, pa.int64())],
                    names=["partition", "doc_id", "start", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.eft").load(folder).select("content")
    return files.mapInArrow(run, "partition long, doc_id long, start long, n_tokens long, ids_crc32 long")


def report(docs: DataFrame, tokenizer: str, end_id: int = 0, literal_specials: bool = True) -> DataFrame:
    """Write the documents, read the files back, and describe each document from what was read."""
    spark = docs.sparkSession
    folder = tables.new_path(spark, "tokens")
    totals = write_tokens(docs, folder, tokenizer, end_id, literal_specials=literal_specials).groupBy("partition").agg(F.sum("ids").alias("n")).collect()
    if not totals:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    bases, total = [], 0  # one number a partition of the writer
    for r in sorted(totals, key=lambda r: r.partition):
        bases.append((r.partition, total))
        total += r.n
    base = spark.createDataFrame(bases, "partition long, base long")
    found = read_tokens(spark, folder).join(F.broadcast(base), "partition")
    return found.select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
