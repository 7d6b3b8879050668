"""N-gram Jaccard self-join with PartEnum signatures (Arasu, Ganti, Kaushik, VLDB 2006).

A document's set holds the 64-bit hashes of its distinct ``n``-word shingles (fewer words:
the whole sequence is the one shingle; none: empty, linked with nothing).  Two documents
link when ``100 * intersection >= percent * union``.

Signatures.  Sizes are cut into bands such that linked sets lie in the same or in
neighbouring bands; a set signs for its own band and, if large enough, for the next.  In a
band with sizes up to r linked sets differ in at most k = floor(2 r (1-t) / (1+t)) shingles.
The shingle domain is hashed into n1 first-level partitions of n2 second-level cells; with
n1 > k / 2 some first-level partition differs in one shingle at most, so some choice of
n2 - 1 of its cells is equal: a signature is the content of such a choice, n1 * n2 in all.  (In
general, with n1 > k / (j + 1) a choice of n2 - j cells is equal.)
A choice of cells that holds nothing would be shared by unrelated sets.  So n1 has ``spare``
extra partitions: a set with at most ``spare`` partitions that have an empty choice shares a
non-empty one with each of its links, and drops the empty ones; only other sets sign them.

Candidates are linear in the signatures: every holder of a signature gets an edge to the
smallest holder, and connected components of these edges hold all links.  Signatures travel
packed (five bytes each, in binary rows by bucket).  A bucket gives each of its documents one root, the
smallest document connected to it there; these are packed by document, and what all buckets have for the
documents of one part is merged to a forest before edges are made, so their number does not follow that of the buckets.  A passage that very many documents share would tie unrelated ones into a large
component; so shingles that are frequent are left out of the domain (any domain gives all links).
They are counted over all documents, by packed cells of the shingle domain, by buckets.

Components of over one block are made finer before they are verified, since verification moves each text once a block.
A set shares at least ``percent`` in 100 of its shingles with each of its links, and these are in its component; so a member with
more shingles than the rest that no other member holds has no link and goes.  Those that stay sign again within
their component, by a scheme whose signatures cover more shingles, as long as that halves the rows that verification moves.

Components are verified exactly, in blocks of bounded size (block pairs are separate tasks; only
a spanning forest of the true links leaves a task), and true links are joined to components
again.  Equal sets are one node throughout, so copies cost one row each.

Defined results: null text is empty; ``doc_id`` is the document's name, so rows that repeat
it are one node (each row is returned); a null doc_id is linked with nothing and has a null
component; other columns of the input are ignored.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import spans, tables
from reelhouse.llm.components import components
from reelhouse.llm.packed import by_bucket, group_starts, sorted_entries, unpack

_U = np.uint64
_FLUSH = 1 << 20  # signatures
_CELLS = 24  # bits of a shingle, after those of its bucket, that the counts tell apart
#: Bytes of text whose signatures fill one bucket.
BUCKET_BYTES = 64 << 20
#: Bytes of text whose shingles fill one bucket.
SHINGLE_BYTES = 16 << 20


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, first = spans.pack(texts, b" ")
    data = spans.LOWER[data]
    s, e = spans.word_spans(data, spans.NON_SPACE)
    words = spans.span_hashes(data, s, e)
    cut = np.append(np.searchsorted(s, first), len(s))
    grams = spans.gram_hashes(words, n)
    out = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        else:
            out.append(spans.gram_hashes(words[a:b], b - a) if b > a else np.empty(0, dtype=_U))
    return out


class Bands:
    """Size bands and the signature parameters of each, for a similarity of ``percent`` in 100."""

    def __init__(self, percent: int, strong: bool = False) -> None:
        self.percent, self.strong = percent, strong
        self.tops = [0]

    def of(self, sizes: np.ndarray) -> np.ndarray:
        while self.tops[-1] < sizes.max(initial=0):
            top = self.tops[-1]
            self.tops.append(max(top + 1, -(-top * 100 // self.percent)))
        return np.searchsorted(self.tops, sizes)

    def top(self, band: int) -> int:
        while len(self.tops) <= band:
            self.tops.append(max(self.tops[-1] + 1, -(-self.tops[-1] * 100 // self.percent)))
        return self.tops[band]

    def least_for(self, band: int) -> int:
        """The smallest set that can link with one of this band."""
        return -(-(self.top(band - 1) + 1) * self.percent // 100)

    @functools.cache  # noqa: B019 - one object per task
    def parameters(self, band: int) -> tuple[int, int, int, int]:
        """n1, n2, cells that a choice leaves out, spare."""
        k = 2 * self.top(band) * (100 - self.percent) // (100 + self.percent)
        if k == 0:
            return 1, 1, 0, 0
        n2, out = (4, 2) if self.strong and k > 3 else (3, 1) if k < 16 else (2, 1)
        n1 = k // (out + 1) + 1
        # a set may have a third of its shingles left out of the domain
        empty = math.comb(n2, out) * (1 - (n2 - out) / (n1 * n2)) ** (0.67 * self.least_for(band))
        spare = 0 if n1 * empty < 0.02 else 1 + math.ceil(2 * n1 * empty)
        return n1 + spare, n2, out, spare


def _signed(sets: list[np.ndarray], sizes: np.ndarray, bands: Bands, seed: int, empties: bool):
    """Non-empty signatures of ``sets``, in bands by ``sizes``: (index, signature), and who lacks non-empty ones.

    With ``empties`` those who lack them sign empty choices too.
    """
    own = bands.of(sizes)
    lens = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    owners, found, lack = [np.empty(0, np.int64)], [np.empty(0, _U)], np.zeros(len(sets), dtype=bool)
    for step in (0, 1):
        jobs: dict[int, list[int]] = {}
        for i, (size, band) in enumerate(zip(sizes.tolist(), (own + step).tolist())):
            if size and (step == 0 or size >= bands.least_for(band)):
                jobs.setdefault(band, []).append(i)
        for band, members in jobs.items():
            n1, n2, out, spare = bands.parameters(band)
            who = np.repeat(np.arange(len(members)), lens[members])
            h = np.concatenate([sets[i] for i in members])
            at = spans.mix(h + _U((band * 0x9E3779B97F4A7C15 + seed) & (2**64 - 1)))
            cell = (who * n1 + ((at >> _U(32)) % _U(n1)).astype(np.int64)) * n2 + ((at & _U(0xFFFFFFFF)) % _U(n2)).astype(np.int64)
            sums = np.zeros(len(members) * n1 * n2, dtype=_U)
            np.add.at(sums, cell, spans.mix(h ^ _U(0xA0761D6478BD642F)))
            counts = np.bincount(cell, minlength=len(sums)).reshape(-1, n2)
            sums = sums.reshape(-1, n2)
            choices = list(itertools.combinations(range(n2), n2 - out))
            sums = np.stack([sums[:, c].sum(axis=1, dtype=_U) for c in choices], axis=1)
            counts = np.stack([counts[:, c].sum(axis=1) for c in choices], axis=1)
            place = np.tile(np.arange(n1 * len(choices), dtype=_U), len(members)).reshape(-1, len(choices))
            sig = spans.mix(sums + spans.mix(place + _U(((band + 1) << 32) + seed)))
            lacking = (counts == 0).any(axis=1).reshape(len(members), n1).sum(axis=1) > spare
            lack[np.asarray(members)[lacking]] = True
            keep = ((counts > 0) | (empties & np.repeat(lacking, n1))[:, None]).ravel()
            owners.append(np.repeat(np.asarray(members), n1 * len(choices))[keep])
            found.append(sig.ravel()[keep])
    return np.concatenate(owners), np.concatenate(found), lack


def _uncommon(sets: list[np.ndarray], common: np.ndarray, bits: int) -> list[np.ndarray]:
    """The sets without the shingles whose first ``bits`` bits are in ``common`` (sorted)."""
    if not len(common):
        return sets
    heads = [s >> _U(64 - bits) for s in sets]
    return [s[common[np.minimum(np.searchsorted(common, c), len(common) - 1)] != c] for s, c in zip(sets, heads)]


def signatures(sets: list[np.ndarray], bands: Bands, common: np.ndarray | None = None, bits: int = 64,
               seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(index of the set, signature) rows of all non-empty sets; each ``seed`` hashes into other partitions and cells.

    ``common`` (sorted) are the first ``bits`` bits of shingles left out of the domain: what is left of two sets differs no more
    than the sets do, so bands and partitions stay as they are.  Sets that then lack non-empty
    signatures sign the full domain as well, where such sets meet each other.
    """
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    if common is None or not len(common):
        owner, sig, _ = _signed(sets, sizes, bands, 2 * seed, True)
        return owner, sig
    owner, sig, lack = _signed(_uncommon(sets, common, bits), sizes, bands, 2 * seed + 1, False)
    again = np.flatnonzero(lack)
    if not len(again):
        return owner, sig
    more, full, _ = _signed([sets[i] for i in again.tolist()], sizes[again], bands, 2 * seed, True)
    return np.concatenate([owner, again[more]]), np.concatenate([sig, full])


def _digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of each set."""
    one = [spans.mix(s).sum(dtype=_U) for s in sets]
    two = [spans.mix(s ^ _U(0xE7037ED1A0B428DB)).sum(dtype=_U) for s in sets]
    return tuple(spans.signed(spans.mix(np.array(x, dtype=_U).reshape(-1))) for x in (one, two))


def _profiles(n: int, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(batch.schema.get_field_index("doc_id")), spans.binary_column(batch, text)
            for i, j in spans.chunks(texts):
                sets = shingle_sets(texts[i:j], n)
                one, two = _digests(sets)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()), pa.array(one), pa.array(two),
                     pa.array([len(t) for t in texts[i:j]], pa.int64())],
                    names=["doc_id", "n_shingles", "d1", "d2", "bytes"])
    return run


def _packed_counts(cells: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """(bucket, weight, cells) of the cells of some documents: a cell's count is the sum of its weights, powers of two."""
    values, counts = np.unique(cells, return_counts=True)
    for p in range(int(counts.max(initial=0)).bit_length()):
        held = values[(counts >> p) & 1 == 1]
        bucket = (held >> _U(_CELLS)).astype(np.int64)
        low = held.view(np.uint8).reshape(-1, 8)[:, :_CELLS // 8]
        cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            yield int(bucket[a]), 1 << p, low[a:b].tobytes()


def _cell_rows(n: int, text: str, bits: int):
    """Packed counts of the first ``bits`` bits of all shingles, by bucket; equal sets of a chunk count once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            rows = list(_packed_counts(np.concatenate(held)))
            return pa.RecordBatch.from_arrays(
                [pa.array([b for b, _, _ in rows], pa.int32()), pa.array([w for _, w, _ in rows], pa.int64()),
                 pa.array([p for _, _, p in rows], pa.binary())], names=["bucket", "weight", "payload"])

        for batch in batches:
            texts = spans.binary_column(batch, text)
            for i, j in spans.chunks(texts):
                sets = shingle_sets(texts[i:j], n)
                _, once = np.unique(_digests(sets)[0], return_index=True)
                for k in once.tolist():
                    held.append(sets[k] >> _U(64 - bits))
                    size += len(sets[k])
                if size >= 4 * _FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()
    return run


def _frequent_cells(least: int):
    """The cells of a bucket that ``least`` or more documents hold."""
    def run(group: pa.Table) -> pa.Table:
        parts, width = group.column("payload").to_pylist(), _CELLS // 8
        cells = np.zeros((sum(map(len, parts)) // width, 4), dtype=np.uint8)
        cells[:, :width] = np.frombuffer(b"".join(parts), dtype=np.uint8).reshape(-1, width)
        cells = cells.view(np.uint32).ravel()
        weights = np.repeat(group.column("weight").to_numpy(), [len(p) // width for p in parts])
        order = np.argsort(cells, kind="stable")
        cells, weights = cells[order], weights[order]
        starts = np.flatnonzero(group_starts([cells]))
        found = cells[starts[np.add.reduceat(weights, starts) >= least]].astype(np.int64) if len(starts) else starts
        return pa.table({"cell": pa.array((group.column("bucket")[0].as_py() << _CELLS) + found, pa.int64())})
    return run


def _cell_bits(n_bytes: int, shuffle_partitions: int) -> int:
    """Bits of the cells for ``n_bytes`` of text: enough for buckets of ``BUCKET_BYTES`` and one a shuffle partition."""
    return _CELLS + max(2, -(-n_bytes // BUCKET_BYTES), shuffle_partitions).bit_length()


def common_shingles(docs: DataFrame, n_docs: int, n: int, text: str, per: int, least: int, bits: int) -> np.ndarray:
    """The first ``bits`` bits of shingles that ``least`` of ``per`` documents hold, and ``least`` documents at least.

    All documents are counted.  Shingles of equal first bits count together; there are far more such cells than
    shingles of one document in ``per``.  At most ``per * mean set size / least`` values.  They steer the cost of the
    join, never its result.
    """
    floor = max(least, -(-least * n_docs // per))
    rows = docs.mapInArrow(_cell_rows(n, text, bits), "bucket int, weight long, payload binary")
    counted = rows.groupBy("bucket").applyInArrow(_frequent_cells(floor), "cell long")
    return np.sort(counted.toPandas()["cell"].to_numpy(np.int64).view(_U))


def _signature_rows(n: int, percent: int, text: str, n_buckets: int, strong: bool, common, bits: int, seed: int):
    """Packed (signature, document) entries by bucket; with a ``cand`` column signatures are apart by component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent, strong)
        docs, sigs, size = [], [], 0

        def flush() -> pa.RecordBatch:
            doc, (sig,) = np.concatenate(docs), [np.concatenate(sigs)]
            rows = by_bucket(doc, [sig], (sig >> _U(40)).astype(np.int64) % n_buckets, 5)
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([p for _, p in rows], pa.binary())],
                                              names=["bucket", "payload"])

        for batch in batches:
            ids, texts = batch.column(batch.schema.get_field_index("doc_id")).to_numpy(zero_copy_only=False), spans.binary_column(batch, text)
            cand = batch.column(batch.schema.get_field_index("cand")).to_numpy(zero_copy_only=False) if strong else np.zeros(len(ids), np.int64)
            for i, j in spans.chunks(texts):
                sets = shingle_sets(texts[i:j], n)
                nodes, _ = _digests(sets)
                order = np.argsort(ids[i:j], kind="stable")
                _, once = np.unique(nodes[order], return_index=True)  # equal sets sign once, by their smallest document
                once = order[once]
                owner, sig = signatures([sets[k] for k in once.tolist()], bands, common.value, bits, seed)
                who = once[owner]
                if strong:
                    sig = spans.mix(sig ^ cand[i:j][who].astype(np.int64).view(_U))
                docs.append(ids[i:j][who])
                sigs.append(sig)
                size += len(sig)
                if size >= _FLUSH:
                    yield flush()
                    docs, sigs, size = [], [], 0
        if docs:
            yield flush()
    return run


def _roots(doc: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct documents of edges, and the smallest document that each is connected to."""
    nodes, at = np.unique(np.concatenate([doc, root]), return_inverse=True)
    u, v = at[:len(doc)], at[len(doc):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        for side in (u, v):
            np.minimum.at(new, label[side], low)
            np.minimum.at(new, side, low)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _bucket_edges(n_parts: int):
    """For each document of a bucket the smallest one that shared signatures connect it to, packed by document."""
    def run(group: pa.Table) -> pa.Table:
        parts = [unpack(p, 1, 5) for p in group.column("payload").to_pylist()]
        doc, (sig,) = sorted_entries([np.concatenate([c[0] for _, c in parts])], np.concatenate([d for d, _ in parts]))
        new = group_starts([sig])
        doc, root = _roots(doc[~new], doc[new][np.cumsum(new) - 1][~new])
        doc, root = doc[doc != root], root[doc != root]
        rows = by_bucket(doc, [root.view(_U)], (spans.mix(doc.view(_U)) % _U(n_parts)).astype(np.int64))
        return pa.table({"part": pa.array([k for k, _ in rows], pa.int32()), "payload": pa.array([p for _, p in rows], pa.binary())})
    return run


def _document_edges(group: pa.Table) -> pa.Table:
    """A spanning forest of the edges that all buckets have for the documents of one part."""
    parts = [unpack(p, 1) for p in group.column("payload").to_pylist()]
    doc, root = np.concatenate([d for d, _ in parts]), np.concatenate([c[0] for _, c in parts]).view(np.int64)
    nodes, least = _roots(doc, root)
    own = nodes != least
    return pa.table({"node": pa.array(nodes[own], pa.int64()), "root": pa.array(least[own], pa.int64())})


def _candidates(docs: DataFrame, n: int, percent: int, text: str, strong: bool, common, n_bytes: int, bits: int = 64,
                seed: int = 0) -> DataFrame:
    """(node, component) of documents that share signatures, directly or through others.

    Buckets of signatures are many enough for ``n_bytes`` of text: signatures take about half as much.
    Parts of documents follow the bytes alone, so the number of edges does not depend on that of the buckets.
    """
    n_parts = max(1, -(-n_bytes // BUCKET_BYTES))
    n_buckets = max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_parts)
    rows = docs.mapInArrow(_signature_rows(n, percent, text, n_buckets, strong, common, bits, seed), "bucket int, payload binary")
    roots = rows.groupBy("bucket").applyInArrow(_bucket_edges(n_parts), "part int, payload binary")
    return components(roots.groupBy("part").applyInArrow(_document_edges, "node long, root long"), "node", "root")


def _shingle_rows(n: int, text: str, n_buckets: int, common, bits: int):
    """Packed (shingle, document) entries by bucket, without frequent shingles; shingles are apart by component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, cells, size = [], [], 0

        def flush() -> pa.RecordBatch:
            doc, cell = np.concatenate(docs), np.concatenate(cells)
            rows = by_bucket(doc, [cell], (cell >> _U(40)).astype(np.int64) % n_buckets, 4)
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([p for _, p in rows], pa.binary())],
                                              names=["bucket", "payload"])

        for batch in batches:
            ids, cand, d1, d2 = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64)
                                 for c in ("doc_id", "cand", "d1", "d2"))
            texts = spans.binary_column(batch, text)
            for i, j in spans.chunks(texts):
                sets = shingle_sets(texts[i:j], n)
                one, two = _digests(sets)
                sets = _uncommon(sets, common.value, bits)
                for k in np.flatnonzero((one == d1[i:j]) & (two == d2[i:j])).tolist():
                    docs.append(np.full(len(sets[k]), ids[i + k]))
                    cells.append(spans.mix(sets[k] ^ cand[i + k:i + k + 1].view(_U)))
                    size += len(sets[k])
                if size >= _FLUSH:
                    yield flush()
                    docs, cells, size = [], [], 0
        if size:
            yield flush()
    return run


def _lone_counts(n_parts: int):
    """How many shingles of a bucket each document holds alone, packed by document."""
    def run(group: pa.Table) -> pa.Table:
        parts = [unpack(p, 1, 4) for p in group.column("payload").to_pylist()]
        doc, (cell,) = sorted_entries([np.concatenate([c[0] for _, c in parts])], np.concatenate([d for d, _ in parts]))
        new = group_starts([cell])
        doc, counts = np.unique(doc[new & np.append(new[1:], True)], return_counts=True)
        rows = by_bucket(doc, [counts.astype(_U)], (spans.mix(doc.view(_U)) % _U(n_parts)).astype(np.int64), 4)
        return pa.table({"part": pa.array([k for k, _ in rows], pa.int32()), "payload": pa.array([p for _, p in rows], pa.binary())})
    return run


def _lone_sums(group: pa.Table) -> pa.Table:
    """The counts that all buckets have for the documents of one part."""
    parts = [unpack(p, 1, 4) for p in group.column("payload").to_pylist()]
    doc, at = np.unique(np.concatenate([d for d, _ in parts]), return_inverse=True)
    sums = np.zeros(len(doc), dtype=np.int64)
    np.add.at(sums, at, np.concatenate([c[0] for _, c in parts]).astype(np.int64))
    return pa.table({"doc_id": pa.array(doc, pa.int64()), "lone": pa.array(sums, pa.int64())})


def _linkable(texts: DataFrame, members: DataFrame, n: int, percent: int, text: str, common, n_bytes: int, bits: int) -> DataFrame:
    """The rows of ``members`` that can have a link: others of the component hold ``percent`` in 100 of their shingles.

    Frequent shingles, and those of equal hashes, count as held by others, and a repeated doc_id stays.
    """
    n_buckets, n_parts = (max(2, -(-n_bytes // b)) for b in (SHINGLE_BYTES, BUCKET_BYTES))
    rows = texts.mapInArrow(_shingle_rows(n, text, n_buckets, common, bits), "bucket int, payload binary")
    counts = rows.groupBy("bucket").applyInArrow(_lone_counts(n_parts), "part int, payload binary")
    lone = counts.groupBy("part").applyInArrow(_lone_sums, "doc_id long, lone long")
    shared = F.col("n_shingles") - F.coalesce("lone", F.lit(0))
    return members.join(lone, "doc_id", "left").where((F.col("k") > 1) | (100 * shared >= percent * F.col("n_shingles"))).drop("lone")


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the true links between members of ``left`` and of ``right`` (indexes into ``sets``)."""
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    values, inverse = np.unique(np.concatenate([sets[i] for i in right.tolist()]), return_inverse=True)
    holder = np.repeat(right, sizes[right])
    order = np.argsort(inverse, kind="stable")
    holder, cut = holder[order], np.append(0, np.cumsum(np.bincount(inverse, minlength=len(values))))
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i in left.tolist():
        at = np.searchsorted(values, sets[i])
        at = at[values[np.minimum(at, len(values) - 1)] == sets[i][:len(at)]] if len(values) else at[:0]
        lo, n = cut[at], cut[at + 1] - cut[at]
        take = np.repeat(lo - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum()) if len(at) else at
        both = np.bincount(holder[take], minlength=len(sets))
        link = np.flatnonzero((both > 0) & (100 * both >= percent * (sizes[i] + sizes - both)))
        for j in link.tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
                out.append((i, j))
    return out


def _verify(n: int, percent: int, text: str):
    def run(group: pa.Table) -> pa.Table:
        out: list[tuple[int, int]] = []
        if group.num_rows:
            get = lambda c: group.column(c).to_numpy()
            texts = [t for batch in group.to_batches() for t in spans.binary_column(batch, text)]
            sets = [s for i, j in spans.chunks(texts) for s in shingle_sets(texts[i:j], n)]
            one, two = _digests(sets)
            right_text = (one == get("d1")) & (two == get("d2"))
            ids, side, bi, bj = get("doc_id"), get("block"), get("bi"), get("bj")
            left = np.flatnonzero(right_text & (side == bi))
            right = np.flatnonzero(right_text & (side == bj))
            if len(left) and len(right):
                out = [(int(ids[a]), int(ids[b])) for a, b in linked(sets, left, right, percent)]
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})
    return run


def _blocks(members: DataFrame, block_rows: int, block_shingles: int, block_bytes: int) -> DataFrame:
    """(cand, size, blocks) of the components with two or more members; a repeated doc_id counts as often as it has rows."""
    total = lambda c: F.sum(F.col(c) * F.col("k")).alias(c)
    sizes = members.groupBy("cand").agg(F.count(F.lit(1)).alias("size"), F.sum("k").alias("rows"), total("n_shingles"), total("bytes"))
    blocks = F.greatest(F.ceil(F.col("rows") / block_rows), F.ceil(F.col("n_shingles") / block_shingles),
                        F.ceil(F.col("bytes") / block_bytes)).cast("int")
    return sizes.where("size > 1").select("cand", "size", blocks.alias("blocks"))


def _units(texts: DataFrame, text: str) -> DataFrame:
    """The rows that verification moves: each text once for every pair of blocks that its own block is in."""
    placed = texts.withColumn("block", F.pmod(F.xxhash64("d2", "d1"), F.col("blocks")).cast("int"))
    units = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return units.select("doc_id", text, "d1", "d2", "cand", "block",
                        F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"))


def _finer(texts: DataFrame, members: DataFrame, n: int, percent: int, text: str, limits: tuple, common, bits: int) -> DataFrame:
    """(doc_id, d1, d2, cand, blocks) of ``members``, all of components of over one block, in finer components.

    Who has no component any more has no link.  Rounds end where they no longer halve the rows that verification moves.
    """
    placed, settled, before = members, [], math.inf
    for seed in itertools.count():
        left = placed.where("blocks > 1")
        moved, n_bytes = left.agg(F.coalesce(F.sum(F.col("k") * F.col("blocks")), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
        if not moved or 2 * moved > before:
            settled.append(placed)
            break
        settled.append(placed.where("blocks = 1"))
        left, before = left.drop("size", "blocks"), moved
        own = lambda m: texts.join(m.select("doc_id", "d1", "d2", "cand").hint("shuffle_hash"), ["doc_id", "d1", "d2"])
        kept = tables.written(_linkable(own(left), left, n, percent, text, common, n_bytes, bits), "partenum-kept")
        again = _candidates(own(kept), n, percent, text, True, common, n_bytes, bits, seed)
        split = kept.drop("cand").join(again.select(F.col("node").alias("doc_id"), F.col("component").alias("cand")), "doc_id")
        split = tables.written(split, "partenum-split")
        placed = tables.written(split.join(_blocks(split, *limits), "cand"), "partenum-placed")
    return functools.reduce(DataFrame.unionByName, (p.select("doc_id", "d1", "d2", "cand", "blocks") for p in settled))


@tables.drops_shuffles
def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text",
                    block_rows: int = 2048, block_shingles: int = 2_000_000, block_bytes: int = 256 << 20,
                    per: int = 40_000, common_in: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``.

    Shingles that ``common_in`` of ``per`` documents hold leave the domain of the signatures (one in
    10,000 documents): the smaller that share, the fewer unrelated texts a shared passage ties together.
    """
    tables.ship(docs.sparkSession)
    docs = docs.select("doc_id", text)
    profile = tables.written(
        docs.mapInArrow(_profiles(n, text), "doc_id long, n_shingles long, d1 long, d2 long, bytes long"), "partenum-profile")
    whole = profile.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    named = profile.where("doc_id is not null and n_shingles > 0")
    classes = named.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.max("bytes").alias("bytes"))
    repeated = named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1")

    bits = _cell_bits(whole.bytes, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, whole.rows, n, text, per, common_in, bits))
    cand = _candidates(docs.where("doc_id is not null"), n, percent, text, False, common, whole.bytes, bits)
    members = classes.join(cand.select(F.col("node").alias("rep"), F.col("component").alias("cand")), "rep")
    members = members.withColumnRenamed("rep", "doc_id").join(repeated, "doc_id", "left").fillna(1, ["k"])
    members = tables.written(members, "partenum-members")
    limits = (block_rows, block_shingles, block_bytes)
    placed = members.join(_blocks(members, *limits), "cand")
    # texts move once, those of components of two or more only; shuffle_hash: the same plan at every size, and they are not sorted
    texts = docs.join(placed.select("doc_id", "d1", "d2", "cand", "blocks").hint("shuffle_hash"), "doc_id")
    texts = tables.written(texts, "partenum-texts", "zstd")
    large = placed.where("blocks > 1")
    if not large.isEmpty():
        again = texts.where("blocks > 1").drop("cand", "blocks")
        place = _finer(again, tables.written(large, "partenum-large"), n, percent, text, limits, common, bits)
        texts = texts.where("blocks = 1").unionByName(again.join(place.hint("shuffle_hash"), ["doc_id", "d1", "d2"]))
    links = _units(texts, text).groupBy("cand", "bi", "bj").applyInArrow(_verify(n, percent, text), "a long, b long")

    with_rep = named.join(classes.drop("bytes"), ["n_shingles", "d1", "d2"])
    same_id = with_rep.join(repeated, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    linked_docs = components(links.unionByName(same_id), "a", "b")

    known = classes.join(linked_docs, F.col("rep") == F.col("node"), "left").select(
        "n_shingles", "d1", "d2", F.coalesce("component", "rep").alias("component_id"))
    out = profile.join(known, ["n_shingles", "d1", "d2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of their component; rows with a null doc_id stay.

    Rows that repeat a kept doc_id all stay: they are the same document by name.
    """
    found = near_duplicates(docs, n, percent, text)
    dropped = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(dropped.hint("shuffle_hash"), "doc_id", "left_anti")
