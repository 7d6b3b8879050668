"""Toxicity, token files, shards, mixing, licences, secrets, and the pipeline."""

import hashlib
import itertools
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import __spark_entry__ as E
from conftest import SF_SMALL
from llm.conftest import ODD
from reelhouse.llm import curriculum_mix, hilbert_shards, license_digest, secret_markov, token_store, toxicity
from reelhouse.llm.oracles import oracle_sql

INSULTS = ["grumblod", "vexwit", "snarfle", "dolthead"]


# --- toxicity ------------------------------------------------------------------------------
def toxic_corpus(seed, n=400):
    rng = random.Random(seed)
    words = ["".join(rng.choice(["ta", "ro", "mi", "len", "su", "ka", "por"]) for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randrange(5, 80))]
        bad = rng.random() < 0.25
        if bad:
            for _ in range(2):
                x = rng.choice(INSULTS)
                style = rng.randrange(4)
                x = x if style < 2 else " ".join(x) if style == 2 else x[:3] + "x" + x[3:]
                w.insert(rng.randrange(len(w)), x)
        docs.append((i, " ".join(w) + "."))
        labels.append((i, None, int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def toxicity_run(spark, make_docs):
    docs, labels = toxic_corpus(7)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = make_docs([*docs, *((10_000 + k, t) for k, (_, t) in enumerate(ODD))])
    return docs, labels, df, table, {r.doc_id: r for r in toxicity.report(df, table).collect()}


def test_toxicity_on_held_out_documents(toxicity_run):
    _, labels, _, _, got = toxicity_run
    held = [(got[i], y) for i, _, y in labels if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in labels)
    right = sum(r.predicted == y for r, y in held) / len(held)
    recall = sum(r.predicted for r, y in held if y) / sum(y for _, y in held)
    assert right > 0.95 and recall > 0.85, (right, recall)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    assert got[10_000].score == got[10_001].score      # null and empty


def test_toxicity_tolerates_gaps_and_insertions(make_docs, toxicity_run):
    _, _, df, table, _ = toxicity_run
    model = toxicity.train(df, table, ~toxicity.held_out())
    probes = ["taro mi v e x w i t len", "taro mi snaxrfle len", "taro mi dolthead len", "taro mi grum-blod", "taro mi sukalen porta"]
    got = {r.doc_id: r.score for r in toxicity.score(make_docs(probes), model).collect()}
    assert min(got[i] for i in range(4)) > got[4]


def test_toxicity_scores_whole_texts(make_docs, toxicity_run):
    _, _, df, table, _ = toxicity_run
    model = toxicity.train(df, table, ~toxicity.held_out())
    filler = "taro milen suka " * 20_000
    got = {r.doc_id: r.score for r in toxicity.score(make_docs([(1, filler), (2, filler + " vexwit " + filler)]), model).collect()}
    assert got[2] > 0.7 > got[1]


def test_toxicity_window_sums_equal_the_kernel():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=toxicity.LETTERS ** toxicity.ORDER).astype(np.float32).reshape([toxicity.LETTERS] * 4)
    for axis in range(4):      # a string with a gap symbol is no feature
        weights[(slice(None),) * axis + (0,)] = 0
    weights = weights.ravel()
    text = "An i-d.iot xé, 42 trash".encode()
    got = toxicity.window_sums(np.frombuffer(text, dtype=np.uint8), weights)
    for i in range(len(text)):
        want = sum(weights[k] * v for k, v in toxicity._features(text[i:i + toxicity.WINDOW]).items())
        assert got[i] == pytest.approx(want, abs=1e-3)


def test_toxicity_without_both_classes(spark, make_docs):
    df = make_docs(ODD)
    for labels, want in (([], 0.0), ([(4, 1, 0)], 0.0), ([(4, 1, 1), (7, 0, None)], 1.0)):
        table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        got = toxicity.score(df, toxicity.train(df, table, F.lit(True))).collect()
        assert len(got) == len(ODD) and all(abs(r.score - want) < 1e-3 for r in got)


def test_svm_separates():
    x = np.array([[0, 0], [0, 1], [3, 3], [4, 3.0]])
    w, b = toxicity.fit_svm(x, np.array([-1, -1, 1, 1]), 10.0)
    assert ((x @ w + b > 0) == [False, False, True, True]).all()


# --- token files -------------------------------------------------------------------------------
def test_elias_fano_round_trip():
    rng = np.random.default_rng(2)
    for top in (1, 7, 1000, 10 ** 7):
        values = np.sort(rng.integers(0, top + 1, 1500))
        ef = token_store.EliasFano.of(values)
        assert (ef.all() == values).all() and all(ef.select(i) == values[i] for i in range(0, 1500, 7))
        assert 8 * (len(ef.low) + len(ef.high)) <= 1500 * (2 + max(0, np.log2(top / 1500)) + 1) + 64
    assert len(token_store.EliasFano.of(np.array([], dtype=np.int64)).all()) == 0


def test_token_files_equal_whole_text_encoding(spark, make_docs, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = [(i, t) for i, t in [*ODD, (11, "a  b   c\n\n d \n e"), (12, " lead"), (13, "trail "), (14, "<|endoftext|> it's I'll"),
                                (15, "tab\tb \t c"), (16, "nbsp    x")]]
    folder = str(tmp_path / "tokens")
    made = token_store.write_tokens(make_docs(docs), folder, path, file_ids=500).collect()
    assert sum(r.documents for r in made) == len(docs) and len(made) >= 3
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    order = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, d[1] or ""))
    want = [[*e.ids, 0] for e in whole.encode_batch([t or "" for _, t in order], add_special_tokens=False)]
    files = [token_store.TokenFile(open(os.path.join(folder, f), "rb").read()) for f in sorted(os.listdir(folder)) if f.endswith(".eft")]
    got = [f.document(i).tolist() for f in files for i in range(len(f.doc_ids))]
    assert got == want
    found = token_store.report(make_docs(docs), path).collect()
    start = 0
    rows = Counter()
    for (i, _), ids in zip(order, want):
        rows[(i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))] += 1
        start += len(ids)
    assert Counter(map(tuple, found)) == rows
    assert token_store.report(make_docs(ODD).limit(0), path).count() == 0


def test_token_pieces_keep_runs_of_white_space():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    rng = random.Random(4)
    texts = ["a \xa0 \xa0 b", "x" + " \xa0" * 5, "a\n\xa0 \xa0 b", "a b\xa0\n\xa0c d", "\xa0 a", "a \xa0", "a\t b \n c \u3000 d\u2003 e", " ", "\n "]
    texts += ["".join(rng.choice(["word", "It's", "7", ".", " ", " ", " ", "\n", "\t", "\xa0", "\u3000", "\x85", "\x1c", "\u200b"])
                      for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    encoder = token_store.Encoder(path, 0)
    for _ in range(2):      # the second time from the memo
        for text, got in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(got, dtype="<u2").tolist() == [*whole.encode(text, add_special_tokens=False).ids, 0], text


def test_token_pieces_part_at_any_border():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(6)
    units = [*"aZé\u00c9ß×÷ªāд中9²'’.,-_<|>(\"\u0300\u0440\u3000\u2000\u2028\u202f\u205f\u1680\u00a0\u0085\x1c\x1f\x7f\x00\x0b\f\r\t\n\n",
             " ", " ", " ", "  ", "'s", "'ll", "'S", "it's", "word", "\U0001f600", "e\u0301", "<|endoftext", "|>", "<|endoftext|>"]
    texts = ["".join(rng.choices(units, k=rng.randrange(12))) for _ in range(8000)]
    texts += [a + b + c for a in units for b in units for c in ("x", " ", "\n", ".")]
    for literal in (False, True):
        whole = Tokenizer.from_file(path)
        whole.encode_special_tokens = literal
        want = [[*e.ids, 0] for e in whole.encode_batch(texts, add_special_tokens=False)]
        for change in ({}, {"sizes": None}, {"sizes": np.full(50_257, 2)}, {"limit": 50}):
            encoder = token_store.Encoder(path, 0, literal_specials=literal)
            vars(encoder).update(change)
            for part in (slice(0, None), slice(0, 300), slice(5000, None)):
                got = [np.frombuffer(b, dtype="<u2").tolist() for b in encoder.encode(texts[part])]
                assert got == want[part], next((t, g, w) for t, g, w in zip(texts[part], got, want[part]) if g != w)
            assert len(encoder.memo) <= max(encoder.limit, 50_000) and encoder.starts[-1] == len(encoder.ids)


def test_token_encoder_gives_the_library_rows_of_pieces():
    import public_tokenizers
    from tokenizers import Tokenizer

    class Counting:
        def __init__(self, inner):
            self.inner, self.texts = inner, 0

        def encode_batch_fast(self, texts, **more):
            self.texts += len(texts)
            return self.inner.encode_batch_fast(texts, **more)

    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefgé", k=9)) for _ in range(6000)]
    texts = [" ".join(words[i:i + 40]) + rng.choice([".", ",\n", "!"]) for i in range(0, 6000, 40)]
    encoder = token_store.Encoder(path, 0)
    encoder.tokenizer = Counting(encoder.tokenizer)
    want = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(b, dtype="<u2").tolist() for b in encoder.encode(texts)] == [[*e.ids, 0] for e in want]
    assert encoder.tokenizer.texts < 60     # 6,000 distinct words, once a text each
    before = encoder.tokenizer.texts
    list(encoder.encode(texts))
    assert encoder.tokenizer.texts == before
    long = ["x" * 70 + str(i) for i in range(50)]
    encoder.limit = 100
    for _ in range(20):         # long pieces do not pile up
        list(encoder.encode(long))
    assert len(encoder.ids) < 10_000


def test_token_query_encodes_as_the_tokenizer_file_says(spark, make_docs, tmp_path):
    import public_tokenizers
    from reelhouse.llm import queries
    from tokenizers import Tokenizer

    docs = [(1, "a <|endoftext|> b"), (2, "a<|endoftext|>"), (3, "<|endoftext|>  \xa0x"), (4, "plain words")]
    make_docs(docs).write.parquet(str(tmp_path / "documents.parquet"))
    whole, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for i, t in docs:
        ids = [*whole.encode(t, add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, queries.op2_token_store(spark, str(tmp_path)).collect())) == want


# --- shards ------------------------------------------------------------------------------------
def test_hilbert_curve_visits_neighbours(spark):
    for n, bits in ((2, 3), (3, 2)):
        grid = spark.createDataFrame(list(itertools.product(range(1 << bits), repeat=n)), ", ".join(f"c{i} int" for i in range(n)))
        path = sorted(grid.select("*", hilbert_shards.curve_index([F.col(f"c{i}") for i in range(n)], bits).alias("h")).collect(),
                      key=lambda r: r.h)
        assert [r.h for r in path] == list(range(1 << (n * bits)))
        assert all(sum(abs(a[i] - b[i]) for i in range(n)) == 1 for a, b in zip(path, path[1:]))


def test_shards_keep_their_law(spark, make_docs):
    df = make_docs([*ODD, *((100 + i, "w " * (i % 37)) for i in range(300))])
    for source in (df, spark.read.parquet(f"{SF_SMALL}/documents.parquet"), make_docs(ODD[:5], 1), df.limit(0)):
        got = hilbert_shards.assign(source, shards=8).collect()
        counts = Counter(r.shard for r in got)
        assert len(got) == source.count() and set(counts) <= set(range(8))
        assert not got or max(counts[k] for k in range(8)) - min(counts[k] for k in range(8)) <= 1
        for k, n in counts.items():
            assert sorted(r.slot for r in got if r.shard == k) == list(range(n))
        texts = defaultdict(list)
        for r in source.collect():
            texts[r.doc_id].append((len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())))
        assert all((r.size, r.text_crc32) in texts[r.doc_id] and r.law == "rows" and r.grown_shard is None for r in got)


def test_shard_levels_follow_whole_strings(spark):
    names = [f"https://host.example/{k:02d}/é" for k in range(16)]
    rows = [(i, names[i % 16], "en") for i in range(320)] + [(1000, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string").repartition(5)
    source, lang = hilbert_shards.quantised(df, ["source", "lang"], 4)
    found = {(r.source, r.s) for r in df.select("source", source.alias("s"), lang.alias("l")).collect()}
    assert found == {(n, k) for k, n in enumerate(names)} | {(None, 0)}
    assert hilbert_shards.quantised(df.limit(0), ["source"], 4)


def test_shards_pass_columns_and_write(make_docs, tmp_path):
    df = make_docs([(i, "w " * (i % 37)) for i in range(200)]).withColumn("slot", F.lit("clash"))
    kept = hilbert_shards.assign(df, keep=True)
    assert kept.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and dict(kept.dtypes)["slot"] == "bigint"
    hilbert_shards.write_shards(df, str(tmp_path / "out"), shards=4, files=8)
    back = df.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.groupBy("shard").count().count() == 4 and back.count() == 200


# --- mixing --------------------------------------------------------------------------------------
def targets_by_hand(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    out, open_, left = {s: 0.0 for s in names}, set(names), float(sum(sizes.values()))
    while left > 1e-9 and open_:
        total, over = sum(w[s] for s in open_), 0.0
        for s in list(open_):
            out[s] += left * w[s] / total
            if out[s] >= 3 * sizes[s]:
                over += out[s] - 3 * sizes[s]
                out[s] = 3.0 * sizes[s]
                open_.discard(s)
        left = over
    return out


def test_targets_equal_the_stepwise_rule(spark):
    rng = random.Random(9)
    for _ in range(6):
        sizes = {(f"s{i}" if i else None): rng.choice([0, 1, 5, 40, 1000]) for i in range(rng.randrange(1, 9))}
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in curriculum_mix.targets(rows).collect()}
        want = targets_by_hand(sizes)
        assert all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in sizes)


def test_mix_takes_its_targets(make_docs):
    df = make_docs([*ODD, *((100 + i, "w " * (1 + i % 23)) for i in range(400))])
    rows = curriculum_mix.plan(df, keep=True).collect()
    assert len(rows) == df.count()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert r.size == len(re.findall("[^\x20\x09-\x0D]+", r.text or "")) and 0 <= r.taken <= 3 * r.size
        assert (r.position is None) == (r.taken == 0) and (r.position is None or 0 <= r.position < 1)
    for found in by.values():
        assert abs(sum(r.taken for r in found) - found[0].target) <= 0.5 + 1e-6
        # the demand at a document's position is where its words start in the source's stream
        for r in found:
            if r.position is not None:
                demand = r.target * (r.position + r.slope * (r.position ** 2 - r.position))
                assert abs(demand - r._start) < 1e-6 * (1 + r.target)
    assert Counter(map(tuple, curriculum_mix.plan(df).collect())) == Counter(map(tuple, curriculum_mix.plan(df.repartition(7)).collect()))


def test_schedule_has_all_copies_in_order(make_docs):
    df = make_docs([*ODD, *((100 + i, "w " * (1 + i % 23)) for i in range(400))])
    rows = curriculum_mix.scheduled(df, keep=True).collect()
    at = [2.0 if r.position is None else r.position for r in rows]
    assert at == sorted(at) and len(rows) == df.count()
    assert any(len(r.positions) == 3 for r in rows)
    for r in rows:
        assert len(r.positions) == (-(-r.taken // r.size) if r.taken else 0) and r.positions[:1] == [r.position][:r.taken]
        for k, x in enumerate(r.positions):
            demand = r.target * (x + r.slope * (x ** 2 - x))
            assert 0 <= x < 1 and abs(demand - r._start - k * r.source_size) < 1e-6 * (1 + r.target)


def test_mixing_query_is_in_training_order(spark):
    from reelhouse.llm import queries

    at = [2.0 if r.position is None else r.position for r in queries.op8_mixing(spark, SF_SMALL).collect()]
    assert at == sorted(at)


def test_mixed_stream_repeats_whole_documents(make_docs):
    df = make_docs([*ODD, *((100 + i, "w " * (1 + i % 23)) for i in range(400))])
    out = curriculum_mix.mixed(df)
    assert out.columns == df.columns
    taken = Counter()
    for r in curriculum_mix.plan(df).collect():
        if r.size:
            taken[r.doc_id] += int(r.taken / r.size + 0.5)
    assert Counter(r.doc_id for r in out.collect()) == +taken
    assert curriculum_mix.plan(df.limit(0)).count() == 0 and curriculum_mix.mixed(df.limit(0)).count() == 0


# --- licences --------------------------------------------------------------------------------------
def test_licenses_by_canonical_digest(make_docs):
    mit = license_digest._MIT
    docs = [(1, "MIT License\n\nCopyright (c) 2019 Somebody\n\n" + mit.replace(". ", ".\n")), (2, mit.upper()),
            (3, "Some prose.\nReleased under the MIT LICENCE!\nLicensed under CC BY-NC 4.0.\nMore."), (4, mit + " And more."),
            (5, "license"), *ODD[:3]]
    got = {r.doc_id: r for r in license_digest.find_licenses(make_docs([d for d in docs if d[0] != 1 or "MIT" in (d[1] or "")])).collect()}
    assert (got[2].text_license, got[4].text_license, got[5].text_license) == ("MIT", None, None)
    assert (got[3].n_license_lines, got[3].licenses) == (2, "CC-BY-NC-4.0,MIT")
    first = license_digest.find_licenses(make_docs(docs[:1])).first()
    assert first.text_license == "MIT"
    assert license_digest.find_licenses(make_docs(ODD)).count() == len(ODD)
    assert license_digest.find_licenses(make_docs(ODD).limit(0)).count() == 0


def test_every_known_notice_matches_in_other_spellings(make_docs):
    styles = [lambda t: re.sub(" +(?![0-9])", "\t", t), lambda t: "* " + re.sub(" +(?![0-9])", " - ", t).upper() + " *", lambda t: re.sub(" +(?![0-9])", "  ", t).rstrip("."),
              lambda t: t.replace("icense", "icence")]
    known = [(name, t) for name, t in license_digest.KNOWN if "\n" not in t]
    docs = [(100 * i + k, "Some prose.\n" + style(t) + "\nMore.") for i, (_, t) in enumerate(known) for k, style in enumerate(styles)]
    got = {r.doc_id: r for r in license_digest.find_licenses(make_docs([*docs, (-1, "All rights-reserved")])).collect()}
    assert got[-1].text_license == "proprietary"
    assert all((got[i].n_license_lines, got[i].licenses) == (1, known[i // 100][0]) for i, _ in docs)


def test_full_licenses_and_copyright_statements(spark, make_docs):
    mit, texts = license_digest._MIT, {p.stem: p.read_text() for p in license_digest.TEXTS.glob("*.txt")}
    apache = texts["Apache-2.0"]
    bsd = ("BSD 3-Clause License\n\nCopyright (c) 2009, Some People\nAll rights reserved.\n\n"
           + license_digest._bsd(3)[0].replace(" 1. ", " * "))
    docs = [*texts.items(), ("MIT", "Copyright (c) The Authors\n\n" + mit), ("MIT", "MIT License\n\n© Some One\n" + mit),
            ("MIT", "MIT License Copyright (c) 2019 Some One " + mit), ("MIT", "Copyright 2020 Acme. Licensed under the MIT License."),
            ("MIT", "Copyright 2020 J. Doe, Acme Inc. Licensed under the MIT License."), ("BSD-3-Clause", bsd),
            ("Apache-2.0", apache.replace("[yyyy] [name of copyright owner]", "2020 Acme")),
            ("Apache-2.0", apache.split("   APPENDIX")[0]), (None, "Copyright 2020 Acme. Nothing else."), (None, apache[:9000]),
            (None, "Copyright (c) 2020 " + "x " * 400_000)]
    df = make_docs([(i, t) for i, (_, t) in enumerate(docs)])
    got = {r.doc_id: r for r in license_digest.find_licenses(df).collect()}
    assert {i: r.text_license for i, r in got.items()} == {i: name for i, (name, _) in enumerate(docs)}
    line = license_digest.find_licenses(make_docs([(1, "x\nCopyright 2020 Acme. Licensed under the MIT License.\ny")])).first()
    assert (line.n_license_lines, line.licenses) == (1, "MIT")
    own = spark.createDataFrame([("Own-1.0", "Do as you like.")], "license string, text string")
    got = {r.doc_id: r.text_license for r in license_digest.find_licenses(make_docs([(1, "do as you LIKE"), (2, mit)]), table=own).collect()}
    assert got == {1: "Own-1.0", 2: None}


# --- secrets ---------------------------------------------------------------------------------------
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_by_hand(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(found)


@pytest.fixture(scope="module")
def secrets(make_docs):
    rng = random.Random(11)
    pool = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rand = lambda n, a=pool: "".join(rng.choice(a) for _ in range(n))
    plain = ["configuration_manager", "getElementByIdentifier", "responsibilities", "implementation-details", "authenticationHandler"]
    docs = [(100 + i, f"{rng.choice(plain)} é\U0001f600 token = \"{rand(30)}\" {rng.choice(plain)} {rand(40, '0123456789abcdef')}") for i in range(40)]
    parts = ["config", "manager", "value", "request", "handler", "index", "reader", "buffer", "total", "async", "stream", "node"]
    docs += [(1000 + i, " ".join("_".join(rng.choice(parts) for _ in range(4)) for _ in range(8))) for i in range(200)]
    docs += [(200, "password: token: abcdefgh"), (201, "token=secret=abcdefgh"), (202, "AKIAABC AKIA" + "Q7" * 8), (203, "API_KEY:'x' apikey='longenough'"),
             (204, "password=abc " * 500 + "PASSWD = 1234567"), (205, "deadbeef" * 3), (206, "deadbeef" * 2 + "g"),
             (207, "see " + rand(44) + " and " + " ".join(plain)), (208, "\U0001f600" * 5 + "secret:abcdef")] + ODD
    return docs, make_docs(docs)


def test_base_secrets_equal_brute_force(secrets):
    docs, df = secrets
    want = Counter()
    for i, t in docs:
        spans = base_by_hand(t or "")
        text = ",".join(f"{secret_markov.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        want[(i, *(sum(k == j for _, k, _ in spans) for j in range(3)), hashlib.sha256(text.encode()).hexdigest())] += 1
    got = secret_markov.report(df).collect()
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want
    by = {r.doc_id: r for r in got}
    # models of the other rows find a bare random string, and no identifier
    model = secret_markov.train(df.where("doc_id <> 207"))
    bare = secret_markov.find_secrets(df.where("doc_id = 207"), model).first().found
    assert [(x.start, secret_markov.KINDS[x.kind], x.end) for x in bare] == [(4, "markov", 48)]
    assert all(x in by[100].spans.split(",") for x in [f"{secret_markov.KINDS[k]}:{a}:{b}" for a, k, b in base_by_hand(docs[0][1])])


def test_secrets_are_masked(secrets, make_docs):
    docs, df = secrets
    unique = df.where("doc_id is not null").dropDuplicates(["doc_id"])
    before, out = ({r.doc_id: r.text for r in x.collect()} for x in (unique, secret_markov.masked(unique)))
    assert out[1] is None and all(len(out[i]) == len(before[i]) for i in out if before[i])
    for i, t in before.items():
        for a, _, b in base_by_hand(t or ""):
            assert set(out[i][a:b]) == {"*"}


def test_secrets_of_tables_without_any(make_docs):
    assert secret_markov.report(make_docs(ODD).limit(0)).count() == 0
    got = secret_markov.report(make_docs([(1, "plain words only"), (2, None)])).collect()
    assert {r.base_sha256 for r in got} == {hashlib.sha256(b"").hexdigest()} and all(r.spans == "" for r in got)


# --- registered queries and the pipeline ---------------------------------------------------------------
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    order = [rel.columns.index(c) for c in cols]
    assert Counter(tuple(r[c] for c in cols) for r in df.collect()) == Counter(tuple(r[i] for i in order) for r in rel.fetchall())


def test_all_ten_queries_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen[-1], SF_SMALL)
        if name != "sharding":
            assert out.columns == docs.columns
        seen.append(corpus_pipeline.tables.written(out, "test-stage"))
    raw, clean, single, decon, mix, shards = seen
    scores = {r.doc_id: r.predicted for r in toxicity.report(raw, spark.read.parquet(f"{SF_SMALL}/labels.parquet")).collect()}
    assert {r.doc_id for r in clean.collect()} == {i for i, p in scores.items() if not p}
    from llm.test_text_operators import contaminated_by_hand, links_by_hand
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    assert {r.doc_id for r in single.collect()} == {i for i, _, c in links_by_hand(rows, 5, 80) if i == c}
    rows = [(r.doc_id, r.text) for r in single.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert {r.doc_id for r in decon.collect()} == {x[0] for x in contaminated_by_hand(rows, items) if not x[5]}
    taken = Counter({r.doc_id: int(r.taken / r.size + 0.5) for r in curriculum_mix.plan(decon).collect() if r.size})
    assert Counter(r.doc_id for r in mix.collect()) == +taken
    assert shards.count() == mix.count() and set(docs.columns) < set(shards.columns)
    counts = Counter(r.shard for r in shards.collect())
    assert max(counts.values()) - min(counts.values()) <= 1
