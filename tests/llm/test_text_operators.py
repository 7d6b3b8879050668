"""Operators on texts against brute force: contamination, blocks, phrases, links."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.conftest import ODD
from reelhouse.llm import block_names, decontaminate, partenum_join, phrase_dedup, spans
from reelhouse.llm.components import components

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile("[^\x20\x09-\x0D]+")


def sentence(rng, n, vocabulary=40):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# --- spans ---------------------------------------------------------------------------
def test_span_hashes_do_not_depend_on_position():
    text = b"alpha beta alpha " + b"y" * (spans.SECTION + 5) + b" alpha " + b"y" * (spans.SECTION + 5)
    data = np.frombuffer(text, dtype=np.uint8)
    s, e = spans.word_spans(data, spans.ALNUM)
    h = spans.span_hashes(data, s, e)
    assert h[0] == h[2] == h[4] and h[3] == h[5] and len({int(x) for x in h}) == 3


# --- benchmark decontamination ---------------------------------------------------------
def contaminated_by_hand(docs, items, n=13):
    wins = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        m = min(n, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            wins[tuple(w[k:k + m])].add(str(item))
    out = []
    for i, text in docs:
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for m in {len(x) for x in wins}:
            for k in range(len(w) - m + 1):
                if tuple(w[k:k + m]) in wins:
                    hit.update(range(k, k + m))
                    found |= wins[tuple(w[k:k + m])]
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), ids, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


@pytest.fixture(scope="module")
def contamination(spark, make_docs):
    rng = random.Random(1)
    items = [(1, sentence(rng, 30, 900)), (2, "Short item!"), (3, None), (4, "..."), (5, sentence(rng, 13, 900)), (5, "one")]
    docs = [(i, sentence(rng, rng.randrange(200), 900)) for i in range(20, 40)]
    docs += [(50 + i, f"{docs[i][1]} -- {items[0][1].upper()} {docs[i + 1][1]}") for i in range(5)]
    docs += [(60, "a SHORT, item b"), (61, "short-item"), (62, items[4][1] + " " + items[0][1][40:])] + ODD
    bench = spark.createDataFrame(items, "item_id long, text string")
    return docs, items, make_docs(docs), bench


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_contamination_equals_brute_force(contamination, block_bytes):
    docs, items, df, bench = contamination
    found = decontaminate.find_contamination(df, bench, block_bytes=block_bytes)
    got = [(r.doc_id, r.n_words, r.n_hit, len(r.hit_items)) for r in found.collect()]
    want = [x[:4] for x in contaminated_by_hand(docs, items)]
    assert Counter(got) == Counter(want) and any(x[2] for x in want)


def test_contamination_report_and_actions(contamination):
    docs, items, df, bench = contamination
    want = contaminated_by_hand(docs, items)
    assert Counter(map(tuple, decontaminate.report(df, bench).collect())) == Counter(want)
    kept = decontaminate.drop_documents(df, bench)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(x[0] for x in want if not x[5])
    clean = decontaminate.remove_spans(df, bench)
    assert all(r.n_hit == 0 for r in decontaminate.find_contamination(clean.where("doc_id < 60"), bench).collect())
    before = {r.doc_id: r.text for r in df.collect()}
    assert all(before[r.doc_id] == r.text for r in clean.collect() if r.doc_id in range(20, 40) and not any(
        x[0] == r.doc_id and x[2] for x in want))


def test_contamination_clashing_columns_and_empty_tables(spark, contamination):
    _, _, df, bench = contamination
    odd = df.withColumn("n_hit", F.lit("x")).withColumn("hit_spans", F.lit(1))
    assert decontaminate.find_contamination(odd, bench).where("n_hit > 0").count() > 0
    assert decontaminate.find_contamination(df.limit(0), bench).count() == 0
    none = decontaminate.find_contamination(df, bench.limit(0))
    assert none.count() == df.count() and none.where("n_hit > 0").count() == 0


# --- exact dedup -------------------------------------------------------------------------
@pytest.mark.parametrize("block_hash", [F.xxhash64, lambda c: F.pmod(F.xxhash64(c), F.lit(3))])
def test_block_names_equal_brute_force(make_docs, block_hash):
    rng = random.Random(2)
    docs = [(100 + i, sentence(rng, rng.randrange(1, 40), 3)) for i in range(60)]
    docs += [(200 + i, docs[i][1].upper()) for i in range(20)] + [(300 + i, docs[3][1] * 9) for i in range(4)]
    docs += [(400, docs[3][1] * 9 + "!"), (401, "É"), (402, "é")] + ODD
    got = block_names.exact_groups(make_docs(docs), block_bytes=16, block_hash=block_hash).collect()
    groups = defaultdict(list)
    for i, t in docs:
        groups[(t or "").translate(LOWER)].append(i)
    want = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        for i in ids:
            want[(i, keep, len(ids), sha)] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_block_names_of_an_empty_table(make_docs):
    assert block_names.exact_groups(make_docs(ODD).limit(0)).count() == 0


# --- repeated substrings -------------------------------------------------------------------
def repeats_by_hand(docs, length):
    rank = lambda i: (i is None, i or 0)
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            if w not in first or rank(i) < rank(first[w]):
                first[w] = i
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if rank(first[b[k:k + length]]) < rank(i):
                gone[k:k + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length, trigger", [(50, 16), (20, 8)])
def test_repeats_equal_brute_force(make_docs, length, trigger):
    rng = random.Random(3)
    base = [sentence(rng, 60, 2000) for _ in range(8)]
    docs = [(100 + i, t) for i, t in enumerate(base)]
    docs += [(200 + i, t) for i, t in enumerate(base[:3])]                              # copies
    for i in range(30):                                                                 # edited and spliced copies
        a, b = rng.choice(base), rng.choice(base)
        k = rng.randrange(len(a))
        docs.append((300 + i, a[:k] + rng.choice(["", "Z", "é"]) + a[k + rng.randrange(2):] + b[rng.randrange(len(b)):]))
    docs += [(10 - i, "ab" * 100) for i in range(3)] + [x for x in ODD if x[0] not in (8, 9)]
    docs += [(8, "x" * 3000), (9, "long text " * 300)]
    got = phrase_dedup.report_of(make_docs(docs), length, trigger)
    assert Counter(map(tuple, got.collect())) == Counter(repeats_by_hand(docs, length))


def test_repeats_in_long_texts_cut_into_sections(make_docs):
    rng = random.Random(4)
    long = "".join(rng.choice("abcdefghij ") for _ in range(2 * spans.SECTION))
    docs = [(1, long), (2, "q" * 77 + long), (3, long[1000:400_000]), (4, long[spans.SECTION - 100:spans.SECTION + 100])]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in phrase_dedup.report(make_docs(docs)).collect()}
    assert got == {1: (0, 0), 2: (len(long), 1), 3: (399_000, 1), 4: (200, 1)}


def test_repeats_removed_from_texts(make_docs):
    passage = "This passage is longer than fifty bytes, and it repeats in two places. "
    out = {r.doc_id: r.text for r in phrase_dedup.remove_repeats(make_docs([(1, passage), (2, "Start. " + passage + "End."), (3, None)])).collect()}
    assert out[1] == passage and out[2].startswith("Start.") and out[2].endswith("End.") and len(out[2]) < 20 and out[3] is None
    assert phrase_dedup.report(make_docs(ODD).limit(0)).count() == 0


# --- n-gram Jaccard join ---------------------------------------------------------------------
def links_by_hand(docs, n, percent):
    sets = []
    for i, t in docs:
        w = SPACED.findall((t or "").translate(LOWER))
        sets.append((i, frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])))
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if None not in (i, j) and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return Counter((i, len(s), None if i is None else root(i)) for i, s in sets)


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def near(make_docs):
    rng = random.Random(5)
    docs = []
    for size in (3, 4, 6, 8, 12, 25, 60, 150, 400):
        for _ in range(4):
            base = sentence(rng, size, 3000)
            docs += [base] + [edited(rng, base, rng.randrange(1, 2 + size // 20)) for _ in range(4)] + [base + " tail" * rng.randrange(3)]
    common = sentence(rng, 60, 3000)
    docs += [sentence(rng, 40, 3000) + " " + common for _ in range(60)]
    docs = [(1000 + i, t) for i, t in enumerate(docs)] + ODD
    return docs, make_docs(docs, 4)


@pytest.mark.parametrize("n, percent, block_rows", [(4, 85, 2048), (5, 80, 2048), (4, 85, 7), (2, 60, 16)])
def test_near_duplicates_equal_brute_force(near, n, percent, block_rows):
    docs, df = near
    got = partenum_join.near_duplicates(df, n, percent, block_rows=block_rows, common_in=3 if block_rows > 10 else 10 ** 9)
    assert Counter(map(tuple, got.collect())) == links_by_hand(docs, n, percent)


@pytest.mark.parametrize("percent, seed", [(80, 1), (85, 2)])
def test_verification_leaves_out_texts_that_cannot_link(make_docs, monkeypatch, percent, seed):
    """A passage ties most texts into one component of many blocks, where few of them are near copies."""
    rng = random.Random(seed)
    passage = sentence(rng, 90, 3000)
    docs = [(i, f"{sentence(rng, 40, 3000)} {passage}") for i in range(300)]
    docs += [(1000 + i, edited(rng, docs[i // 3][1], 1)) for i in range(45)]
    # 2000 is linked by one text, and has more shingles alone by the other; 3000 comes twice; copies come once
    docs += [(2000, edited(rng, docs[20][1], 1)), (2000, f"{sentence(rng, 400, 3000)} {passage}"), (3000, f"{sentence(rng, 40, 3000)} {passage}"),
             (3000, f"{sentence(rng, 40, 3000)} {passage}"), (4000, docs[30][1]), (None, docs[31][1])]
    moved, units = [], partenum_join._units

    def counted(texts, text):
        moved.append(units(texts, text).count())
        return units(texts, text)

    monkeypatch.setattr(partenum_join, "_units", counted)
    got = partenum_join.near_duplicates(make_docs(docs, 4), 4, percent, block_rows=7, common_in=10 ** 9)
    assert Counter(map(tuple, got.collect())) == links_by_hand(docs, 4, percent)
    assert 45 < moved[0] < 2 * len(docs), moved


def test_lone_shingles_are_counted_by_component(make_docs, spark):
    docs = [(1, "a b c d e f"), (2, "a b c d x y"), (3, "a b c d e f q"), (4, "a b c d e f"), (4, "u v w")]
    members = [(1, 3, 0, 1), (2, 3, 0, 1), (3, 4, 1, 1), (4, 3, 2, 2)]
    sets = partenum_join.shingle_sets([t.encode() for _, t in docs], 4)
    one, two = partenum_join._digests(sets)
    cand = {i: c for i, _, c, _ in members}
    texts = spark.createDataFrame([(i, t, int(a), int(b), cand[i]) for (i, t), a, b in zip(docs, one, two)],
                                  "doc_id long, text string, d1 long, d2 long, cand long")
    common = spark.sparkContext.broadcast(np.empty(0, dtype=np.uint64))
    held = spark.createDataFrame(members, "doc_id long, n_shingles long, cand long, k long")
    kept = lambda percent, common: {r.doc_id for r in partenum_join._linkable(
        texts, held, 4, percent, "text", common, 10 ** 9, 64).collect()}
    # of three shingles 1 and 2 share one; 3 is alone in its component, and 4 stays as its doc_id is repeated
    assert kept(33, common) == {1, 2, 4} and kept(34, common) == {4}
    assert kept(34, spark.sparkContext.broadcast(np.sort(sets[0]))) == {1, 3, 4}


def test_shuffle_files_go_during_the_near_duplicates_only(spark, make_docs, monkeypatch):
    seen, written = [], partenum_join.tables.written
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    monkeypatch.setattr(partenum_join.tables, "written", lambda *a, **b: seen.append(spark.conf.get(key)) or written(*a, **b))
    before = spark.conf.get(key)
    partenum_join.near_duplicates(make_docs([(1, "a b c d e f"), (2, "u v w x y z")]))
    assert seen and set(seen) == {"true"} and spark.conf.get(key) == before
    with pytest.raises(Exception, match="doc_id"):
        partenum_join.near_duplicates(spark.range(3))
    assert spark.conf.get(key) == before


@pytest.mark.parametrize("flush", [1 << 20, 64])
def test_frequent_shingles_are_counted_over_all_documents(spark, make_docs, monkeypatch, flush):
    monkeypatch.setattr(partenum_join, "_FLUSH", flush)
    rng = random.Random(8)
    shared = [sentence(rng, 9, 3000) for _ in range(6)]
    # passage k is in every (4 k + 4)-th document: of 600 documents, 10 in 100 are 60
    docs = [(i, " ".join([sentence(rng, 8, 3000), *[s for k, s in enumerate(shared) if i % (4 * k + 4) == 0]])) for i in range(600)]
    df, bits = make_docs(docs + [(None, None), (-1, "")], 5), partenum_join._cell_bits(0, 8)
    sets = partenum_join.shingle_sets([t.encode() for _, t in docs], 5)
    counts = Counter(x >> (64 - bits) for s in sets for x in s.tolist())
    want = sorted(x for x, n in counts.items() if n >= 60)
    got = partenum_join.common_shingles(df, 600, 5, "text", 100, 10, bits)
    assert want and got.tolist() == want
    assert partenum_join.common_shingles(df.limit(0), 0, 5, "text", 100, 10, bits).tolist() == []


@pytest.mark.parametrize("strong, common_share", [(False, 0), (True, 0), (False, 0.4), (False, 0.9), (True, 0.5)])
def test_partenum_signs_every_link(strong, common_share):
    """Sets of all sizes with as many differences as the threshold allows share a signature."""
    rng = random.Random(6)
    bands = partenum_join.Bands(85, strong)
    for size in [*range(1, 60), 100, 333, 1000]:
        a = [rng.getrandbits(64) for _ in range(size)]
        most = int(0.15 / 1.85 * 2 * size)
        for out in {0, most // 2, most}:
            b = a[out:] + [rng.getrandbits(64) for _ in range(max(0, most - out))]
            inter, union = size - out, size + max(0, most - out)
            if 100 * inter < 85 * union:
                continue
            common = np.sort(np.array([x for x in a if rng.random() < common_share], dtype=np.uint64))
            owner, sig = partenum_join.signatures([np.unique(np.array(x, dtype=np.uint64)) for x in (a, b)], bands, common)
            assert set(sig[owner == 0].tolist()) & set(sig[owner == 1].tolist()), (size, out)


def test_keep_one_keeps_columns_and_smallest(near):
    docs, df = near
    kept = partenum_join.keep_one(df, 5, 80)
    assert kept.columns == df.columns
    want = Counter(i for (i, _, c), k in links_by_hand(docs, 5, 80).items() for _ in range(k) if i == c)
    assert Counter(r.doc_id for r in kept.collect()) == want


def test_near_duplicates_of_empty_tables(make_docs):
    assert partenum_join.near_duplicates(make_docs(ODD).limit(0)).count() == 0
    alone = partenum_join.near_duplicates(make_docs([(1, "a b c d e f"), (2, "u v w x y z")])).collect()
    assert {r.component_id for r in alone} == {1, 2}


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 200)] + [(1000, i) for i in range(1001, 1100)] + [(5000, 5000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "x long, y long"), "x", "y").collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1100)}}


def test_verification_reads_every_batch_of_a_group():
    import pyarrow as pa

    class Chunked:
        """A table whose chunks cannot be combined, as with more than 2 GB of strings."""

        def __init__(self, table):
            self.table, self.num_rows = table, table.num_rows
            self.column, self.to_batches, self.schema = table.column, table.to_batches, table.schema

        def combine_chunks(self):
            return self

    texts = ["a b c d e f g", "other words of another text here", "a  b c d e f g"]
    one, two = partenum_join._digests(partenum_join.shingle_sets([t.encode() for t in texts], 4))
    whole = pa.table({"doc_id": [1, 2, 3], "text": texts, "d1": one, "d2": two, **{c: [0, 0, 0] for c in ("cand", "block", "bi", "bj")}})
    group = Chunked(pa.concat_tables([whole.slice(i, 1) for i in range(3)]))
    got = partenum_join._verify(4, 85, "text")(group).to_pylist()
    assert {frozenset(r.values()) for r in got if r["a"] != r["b"]} == {frozenset((1, 3))}


def test_blocks_are_bounded_by_bytes_too(make_docs):
    base = [f"w{k}" for k in range(60)]
    docs = [(i, " ".join(base[:30] + [f"x{i}"] + base[30:]) + " " * i) for i in range(40)]
    want, got = ({tuple(r) for r in partenum_join.near_duplicates(make_docs(docs), block_bytes=b).collect()} for b in (256 << 20, 2000))
    assert want == got and {r[2] for r in got} == {0}
