"""Byte-pair encoding by backtracking, spelling variants, vantage-point clusters, clashing names: against brute force."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from llm.conftest import ODD
from reelhouse.llm import (
    backtrack_bpe,
    curriculum_mix,
    decontaminate,
    hilbert_shards,
    partenum_join,
    pieces,
    spelling_variants,
    toxicity,
    vantage_clusters,
)


# --- byte-pair encoding ------------------------------------------------------------------------
@pytest.fixture(scope="module")
def bpe():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    return path, Tokenizer.from_file(path)


def test_pieces_join_to_their_texts():
    rng = random.Random(3)
    texts = [None, "", " ", "a", " a", "a ", "a  b", "a \xa0 b c", "x y z\n w"] + [
        "".join(rng.choice("ab  \n\t\xa0.") for _ in range(rng.randrange(30))) for _ in range(500)]
    for part in pieces.chunks(pa.array(texts, pa.string()), 600):
        distinct, found, ends = pieces.split(part)
        cut = [0, *ends.tolist()]
        assert ["".join(distinct[i] for i in found[a:b]) for a, b in zip(cut, cut[1:])] == [t or "" for t in part.to_pylist()]
        assert len(set(distinct)) >= len(distinct) - len(part)


def test_backtracking_equals_merging(bpe):
    path, library = bpe
    rng = random.Random(8)
    marks = ["a", "b", "th", "e", " ", "  ", "\n", "\xa0", "1", "é", "ß", "漢", "ՙ", "ء", "\U0001f600", "'s", "'ll", "<|endoftext|>",
             "\t", ".", "!!", "\x1c", "\x85", "​", "ing", "x" * 9, "ֈ", "꟎"]
    texts = ["", None, "x" * 70_000, "ab" * 5000, " " * 5000, "a <|endoftext|> b\n\n<|endoftext|><|endoftext|>"]
    texts += ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    texts += ["".join(rng.choice("aeioustn") for _ in range(150)) for _ in range(300)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(32, 0x24F), rng.randint(0x20, 0xD7FF), rng.randint(0x10000, 0x1FFFF)]))
                      for _ in range(30)) for _ in range(500)]
    encoder, decoder = backtrack_bpe.TextEncoder(path), backtrack_bpe.Decoder(path)
    for text, packed in zip(texts, encoder(pa.array(texts, pa.string()))):
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        assert ids == library.encode(text or "", add_special_tokens=False).ids, text
        assert decoder(np.array(ids, dtype=np.int64))[0].tobytes().decode("utf-8", "replace") == (text or "")
    for _ in range(500):        # any ids, not only those of texts
        ids = [rng.randrange(50_257) for _ in range(20)]
        assert decoder(np.array(ids))[0].tobytes().decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False)


def test_bpe_query_equals_the_library(spark, make_docs, bpe):
    path, library = bpe
    for df in (make_docs([*ODD, (20, "it's  \xa0 <|endoftext|> I'll")]), spark.read.parquet(f"{SF_SMALL}/documents.parquet"), make_docs(ODD).limit(0)):
        want = Counter()
        for r in df.collect():
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
            want[(r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))] += 1
        assert Counter(map(tuple, backtrack_bpe.report(df.withColumn("ids", F.lit(1)), path).collect())) == want
    back = backtrack_bpe.decode(backtrack_bpe.encode(make_docs(ODD), path), path).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((i, t or "") for i, t in ODD)
    loose = spark.createDataFrame([(1, None), (2, [64, None, 999_999, -5, 65])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in backtrack_bpe.decode(loose, path).collect()} == {1: "", 2: library.decode([64, 65])}


def test_unfit_tokenizer_files_raise(bpe, tmp_path):
    spec = json.load(open(bpe[0], encoding="utf-8"))
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {**spec["pre_tokenizer"], "use_regex": False}},
                   {"pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Digits", "individual_digits": True}, spec["pre_tokenizer"]]}}):
        path = tmp_path / "t.json"
        path.write_text(json.dumps({**spec, **change}))
        with pytest.raises(ValueError):
            backtrack_bpe.Vocabulary(str(path))
        from reelhouse.llm import token_store
        assert not token_store.Encoder(str(path), 0).direct


# --- spelling variants ---------------------------------------------------------------------------
def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


@pytest.mark.parametrize("group_words", [3, 10_000])
def test_near_pairs_equal_brute_force(spark, group_words):
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(260)} | {"x" * 300, "x" * 301, "y" + "x" * 300, "a", "b"}
    vocabulary = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    got = [tuple(r) for r in spelling_variants.near_pairs(vocabulary, group_words).collect()]
    want = {(a, b) for a in words for b in words if a < b and abs(len(a) - len(b)) < 2 and one_edit(a, b)}
    assert len(got) == len(set(got)) and set(got) == want


def brute_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 5 and k >= 3}
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def test_spelling_query_equals_brute_force(spark, make_docs):
    rng = random.Random(2)
    stems = ["straße", "Étude", "colour", "wording", "abcdefgh"]
    words = stems + ["colours", "color", "colr", "wordin", "wordings", "abcdefg", "étude", "strasse", "straßen"]
    rows = [*ODD, *((100 + i, " ".join(rng.choice(words[:3 + i % 12]) for _ in range(40)) + ", 7x") for i in range(80))]
    for group_words in (2, 10_000):
        got = spelling_variants.report(make_docs(rows).withColumn("n", F.lit("x")), group_words=group_words).collect()
        assert len(got) == len(set(got)) and set(map(tuple, got)) == brute_variants(rows)
    assert spelling_variants.report(make_docs(ODD).limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling_variants.variants(spark.createDataFrame([("abcde", 3)], "word string, n long"), factor=1)


# --- vantage-point clusters ------------------------------------------------------------------------
def test_tree_finds_the_nearest_and_smallest():
    rng = np.random.default_rng(1)
    for k, dims, spread in ((1, 3, 4), (2, 3, 2), (40, 8, 3), (40, 64, 40), (200, 2, 6), (90, 5, 1 << 26)):
        points = rng.integers(-spread, spread, size=(k, dims))
        points[k // 2:k // 2 + 5] = points[0]       # repeated centroids
        vectors = np.vstack([rng.integers(-spread, spread, size=(500, dims)), points])
        all_ = np.stack([vantage_clusters.squared(vectors, p) for p in points], axis=1)
        for leaf in (1, 4):
            number, dist = vantage_clusters.VantageTree(points, leaf).nearest(vectors)
            assert (number == all_.argmin(axis=1)).all() and (dist == all_.min(axis=1)).all()


def brute_clusters(rows, k, rounds, size):
    kept = [(i, [int(np.floor(256.0 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1], r[0] is None, r[0] or 0))
    centroids = [v for _, v in order[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            mine = [v for f, (_, v) in zip(found, kept) if f == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [(i, *nearest(v)[::-1]) for i, v in kept]
    own = Counter()
    for _, j, d in last:
        own[j] += d
    return Counter((i, j, d, own[j], sum(own.values()), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for i, j, d in last)


def test_clusters_equal_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, [rng.choice([-1, 0, 0.5, 1]) * (i % 3) + rng.random() for _ in range(4)]) for i in range(150)]
    rows += [(3, [0.1, 0.2, 0.3, 0.4]), (3, [0.1, 0.2, 0.3, 0.4]), (None, [0.0, 0.0, 0.0, 0.0]), (200, None), (201, []), (202, [1.0]),
             (203, [1.0, None, 1.0, 1.0]), (204, [1.0, float("nan"), 1.0, 1.0]), (205, [1.0, float("inf"), 1.0, 1.0]), (206, [-0.001] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("x")).withColumn("q", F.lit(1))
    for k, rounds in ((8, 5), (500, 1), (3, 0)):
        got = vantage_clusters.report(df.repartition(5), k=k, rounds=rounds, size=4).collect()
        assert Counter(map(tuple, got)) == brute_clusters(rows, k, rounds, 4)
    assert vantage_clusters.report(df.limit(0), size=4).count() == 0
    with pytest.raises(Exception, match="2\\^27"):
        vantage_clusters.report(spark.createDataFrame([(1, [1e9] * 4)], "vec_id long, embedding array<double>"), size=4).collect()


# --- clashing names, edges, labels ---------------------------------------------------------------------
CLASHING = ["slope", "size", "position", "target", "taken", "_start", "_budget", "_copies", "_total", "_base", "_slice", "_rank", "_d0", "_row",
            "n_words", "n_hit", "hit_items", "score", "_toxicity", "fold", "toxic", "odd name", "a.b", "d1", "cand", "block"]


@pytest.mark.parametrize("stage", ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"])
def test_stages_keep_columns_whatever_their_names(spark, make_docs, stage):
    docs = make_docs([(i, f"one more text {'of some words ' * (i % 5)} {i % 7}") for i in range(60)])
    labels = spark.createDataFrame([(i, None, i % 2) for i in range(60)] + [(0, None, 1)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "no document has this passage")], "item_id long, text string")
    run = {"toxicity": lambda d: toxicity.drop_toxic(d, labels), "near_duplicates": partenum_join.keep_one,
           "decontamination": lambda d: decontaminate.drop_documents(d, bench, n=40),
           "mixing": curriculum_mix.mixed, "sharding": lambda d: hilbert_shards.assign(d, keep=True)}[stage]
    names = [c for c in CLASHING if stage != "sharding" or c not in ("size", "shard", "slot")]
    wide = docs.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in names])
    got = run(wide).collect()
    assert got and Counter(r.doc_id for r in got) == Counter(r.doc_id for r in run(docs).collect())
    assert all(r[c] == f"{c}-{r.doc_id}" for r in got for c in names)


def test_candidate_edges_do_not_follow_the_number_of_buckets(spark, make_docs):
    rng = random.Random(6)
    base = [rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randrange(40)) for _ in range(120)]
    docs = make_docs([(i, " ".join([*base[:i % 60], f"new{i}", *base[i % 60 + 1:]])) for i in range(200)])
    common = spark.sparkContext.broadcast(np.empty(0, dtype=np.uint64))
    kept, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    seen = partenum_join.components
    try:
        for parts in (4, 64):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            partenum_join.components = lambda edges, a, b: found.append(edges.count()) or seen(edges, a, b)
            partenum_join._candidates(docs.select("doc_id", "text"), 5, 80, "text", False, common, 0)
    finally:
        partenum_join.components = seen
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert found[0] > 0 and found[1] <= 1.5 * found[0], found


def test_labels_of_both_kinds_count_as_toxic(spark, make_docs):
    docs = make_docs([(i, f"text {i}") for i in range(4)])
    labels = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.labelled_sample(docs, labels, F.lit(True), 10).collect()
    assert {(r.text, r.toxic) for r in got} == {("text 0", 1), ("text 1", 0)}
    assert toxicity.report(docs.limit(0), labels).count() == 0
