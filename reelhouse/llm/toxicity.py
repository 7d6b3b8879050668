"""Toxicity: a gap-weighted subsequence kernel, Nystroem landmarks and a linear SVM, learnt from labelled sentences.

Kernel.  A window of ``WINDOW`` characters has a feature for every string of four letters: the
sum of ``DECAY ** span`` over its occurrences as a subsequence that spans ``REACH`` bytes at most
(Lodhi et al., JMLR 2002, with bounded gaps).  Letters are a-z in either case, white space, and
two classes of non-ASCII bytes; other bytes are gaps.  White space and any byte may be skipped
too, so "i d.i-o t" and "idxiot" still share most of the features of "idiot".

Training (multiple instances: a toxic text has a toxic window somewhere, a clean one nowhere).
Rows come from a bounded sample of labelled documents.  Landmarks are the words and word starts
that go most with the label, no two of them nearly alike, and the commonest words.  Each round collects from every sample text its
highest windows under the present model (one of a toxic text, three of a clean one), maps them
to Nystroem features K_zz^(-1/2) k_z(x), and fits an SVM (squared hinge, Newton steps in the
primal).  Windows of clean texts accumulate over the rounds as hard negatives.  The document's
margin is that of its highest window; a logistic fit turns it into a probability.  The fit takes the
sample's margins from models trained on the other two of three folds of texts.  ``pool`` candidates for
landmarks, ranked over the whole sample, come to the driver.

Scoring.  Kernel expansions over landmarks are linear in the features, so the trained model is
one weight per four-letter string; all windows of all texts are scored by table look-ups and
running sums.  Whole texts are scored, in sections that overlap by a window.

Defined results: null and empty texts get the score of a text without any letters; repeated rows
score alike; labels of null, or without a text, are not used; a document with labels of both kinds
counts as toxic; a sample without both classes gives
every text the share of toxic labels (0 without labels); extra columns are kept.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.llm import spans, tables

ORDER, REACH, WINDOW, DECAY = 4, 7, 12, 0.7
LETTERS = 30
_CODE = np.zeros(256, dtype=np.int32)
_CODE[97:123] = _CODE[65:91] = np.arange(1, 27)
_CODE[[9, 10, 13, 32]] = 27
_CODE[0x80:0xC0] = 28 + np.arange(64) % 2
_GAPS = [g for g in itertools.combinations(range(1, REACH), ORDER - 1)]
_SECTION = 1 << 16
#: Rows that a sum over training windows takes at once, and the folds of the calibration.
BLOCK, FOLDS = 2048, 3


@dataclass
class Model:
    """``weights`` per four-letter string; probability = 1 / (1 + exp(-(slope * margin + offset)))."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(LETTERS ** ORDER, dtype=np.float32))
    slope: float = 0.0
    offset: float = -50.0

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -50, 50)))


def window_sums(data: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The model's sum for the window that starts at each byte of ``data`` (padded with gaps at its end)."""
    n = len(data)
    c = np.zeros(n + WINDOW + REACH, dtype=np.int32)
    c[:n] = _CODE[data]
    m = n + WINDOW
    first = {a: (c[:m] * LETTERS + c[a:a + m]) * LETTERS ** 2 for a in range(1, REACH - 2)}
    last = {g: c[:m + REACH - g] * LETTERS + c[g:g + m + REACH - g] for g in range(1, REACH - 2)}
    by_span: dict[int, np.ndarray] = {}
    for a, b, d in _GAPS:
        found = weights[first[a] + last[d - b][b:b + m]]
        span = d + 1
        if span in by_span:
            by_span[span] += found
        else:
            by_span[span] = found
    out = np.zeros(n, dtype=np.float64)
    for span, found in by_span.items():
        sums = np.zeros(m + 1, dtype=np.float64)
        np.cumsum(found * np.float32(DECAY ** span), out=sums[1:], dtype=np.float64)
        out += sums[WINDOW - span + 1:][:n] - sums[:n]
    return out


def _sections(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """(document, offset, bytes) pieces, packed; long texts are cut so that each window start is in one piece."""
    out, size = [], 0
    for d, text in enumerate(texts):
        for at in range(0, max(1, len(text)), _SECTION):
            piece = text[at:at + _SECTION + WINDOW]
            if out and size + len(piece) > _SECTION:
                yield out
                out, size = [], 0
            out.append((d, at, piece))
            size += len(piece) + WINDOW
    if out:
        yield out


def top_windows(texts: list[bytes], weights: np.ndarray, k: int) -> tuple[np.ndarray, list[list[bytes]]]:
    """The highest margin of each text (0 without letters), and the texts of its ``k`` highest distant windows."""
    best = np.zeros(len(texts))
    tops: list[list[tuple[float, bytes]]] = [[] for _ in texts]
    for section in _sections(texts):
        data = np.frombuffer((b" " * WINDOW).join(p for _, _, p in section), dtype=np.uint8)
        sums = window_sums(data, weights)
        at = 0
        for d, _, piece in section:
            part = sums[at:at + min(len(piece), _SECTION)]
            if len(part):
                best[d] = max(best[d], part.max())
                part = part.copy() if k > 1 else part
                for _ in range(k):
                    j = int(part.argmax())
                    tops[d].append((float(part[j]), piece[j:j + WINDOW]))
                    if k > 1:
                        part[max(0, j - WINDOW):j + WINDOW] = -np.inf
            at += len(piece) + WINDOW
    return best, [[w for _, w in sorted(t, key=lambda x: -x[0])[:k]] for t in tops]


def _features(window: bytes) -> dict[int, float]:
    """The explicit kernel features of one window."""
    c = _CODE[np.frombuffer(window[:WINDOW], dtype=np.uint8)].tolist()
    out: dict[int, float] = {}
    for i, (a, b, d) in itertools.product(range(len(c)), _GAPS):
        if i + d < len(c) and c[i] and c[i + a] and c[i + b] and c[i + d]:
            key = ((c[i] * LETTERS + c[i + a]) * LETTERS + c[i + b]) * LETTERS + c[i + d]
            out[key] = out.get(key, 0.0) + DECAY ** (d + 1)
    return out


class Nystroem:
    """Landmark windows and the map of windows to k_z(x) and to whitened features."""

    def __init__(self, landmarks: list[bytes]) -> None:
        found = [f for f in map(_features, landmarks) if f]
        self.columns = {k: i for i, k in enumerate(sorted({k for f in found for k in f}))}
        self.z = np.zeros((len(found), len(self.columns)), dtype=np.float32)
        for i, f in enumerate(found):
            for k, v in _unit(f).items():
                self.z[i, self.columns[k]] = v
        values, vectors = np.linalg.eigh((self.z @ self.z.T).astype(np.float64))
        keep = values > 1e-6 * max(values.max(initial=0), 1e-12)
        self.whiten = vectors[:, keep] / np.sqrt(values[keep])

    def map(self, windows: list[bytes], out: np.ndarray | None = None) -> np.ndarray:
        out = np.zeros((len(windows), self.whiten.shape[1]), dtype=np.float32) if out is None else out
        for i, window in enumerate(windows):
            f = [(self.columns[k], v) for k, v in _features(window).items() if k in self.columns]
            out[i] = 0
            if f:
                at, v = zip(*f)
                out[i] = (self.z[:, list(at)] @ np.array(v)) @ self.whiten
        return out

    def weights(self, w: np.ndarray) -> np.ndarray:
        """The table of one weight per four-letter string that equals w on whitened features."""
        table = np.zeros(LETTERS ** ORDER, dtype=np.float32)
        table[list(self.columns)] = (self.whiten @ w) @ self.z
        return table


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float, rounds: int = 30, use: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss, by Newton steps on the active rows; y in -1, 1, classes weighted evenly.

    ``use`` marks the rows that count.  Sums go over blocks of rows, so no copy of ``x`` is made.
    """
    use = np.ones(len(x), dtype=bool) if use is None else use
    pos, neg = (use & (y > 0)).sum(), (use & (y < 0)).sum()
    c = cost * use * np.where(y > 0, 0.5 / max(1, pos), 0.5 / max(1, neg)) * (pos + neg)
    ridge = np.ones(x.shape[1] + 1)
    ridge[-1] = 1e-6
    w = np.zeros(len(ridge))
    for _ in range(rounds):
        gram, moment = np.diag(ridge), np.zeros(len(ridge))
        for i in range(0, len(x), BLOCK):
            xb, yb, cb = x[i:i + BLOCK], y[i:i + BLOCK], c[i:i + BLOCK]
            active = (yb * (xb @ w[:-1].astype(x.dtype) + w[-1]) < 1) & (cb > 0)
            xa = np.hstack([xb[active], np.ones((active.sum(), 1))])
            gram += (xa * cb[active][:, None]).T @ xa
            moment += xa.T @ (cb * yb)[active]
        new = np.linalg.solve(gram, moment)
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w[:-1], float(w[-1])


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(y=1 | margin), with Platt's smoothed targets."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - target) + 1e-3 * np.array([w[0], 0])
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w - step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(w[0], 1e-6)), float(w[1])


def labelled_sample(docs: DataFrame, labels: DataFrame, train, max_docs: int, text: str = "text") -> DataFrame:
    """(text, toxic, fold) of at most ``max_docs`` training documents of each class, the smallest by a hash of doc_id.

    The ids are chosen from the labels alone, so ``2 * max_docs`` ids are broadcast and no text is shuffled.
    """
    y = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & train)
    # a document with labels of both kinds counts as toxic
    y = y.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    y = y.withColumn("_h", F.xxhash64("doc_id"))
    part = [y.where(F.col("toxic") == k).orderBy("_h").limit(max_docs).select("doc_id", "toxic") for k in (0, 1)]
    rows = docs.select("doc_id", F.col(text).alias("text")).where(F.col("text").isNotNull())
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold")  # equal texts share one
    return rows.join(F.broadcast(part[0].unionByName(part[1])), "doc_id").select("text", "toxic", fold)


def landmark_words(sample: DataFrame, n: int, pool: int = 4000) -> tuple[list[bytes], list[float], list[bytes]]:
    """Two thirds of them words and word starts that go most with the label, by document counts, the rest the commonest.

    Each starts with a space.  ``pool`` bounds what comes to the driver; a word that is nearly
    alike (kernel cosine over 0.9) to one with a higher score is passed over.
    """
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}{3,16})\p{L}*"), 1)
    starts = F.flatten(F.transform(F.array_distinct(words), lambda w: F.array(w, *(F.substring(w, 1, k) for k in (4, 5, 6, 8)))))
    counts = sample.select("toxic", F.explode(F.array_distinct(starts)).alias("word")).groupBy("word").agg(
        F.sum("toxic").alias("pos"), F.count(F.lit(1)).alias("df")).where("df > 2")
    total = sample.agg(F.sum("toxic").alias("p"), F.count(F.lit(1)).alias("n")).first()
    rate = total.p / total.n
    # a binomial z score of the word's documents being toxic
    ranked = counts.withColumn("z", (F.col("pos") - rate * F.col("df")) / F.sqrt(rate * (1 - rate) * F.col("df")))
    top: list[tuple[bytes, float, dict]] = []
    for r in ranked.where("z > 0").orderBy(F.desc("z"), F.desc(F.length("word")), "word").limit(pool).collect():
        f = _unit(_features(b" " + r.word.encode()))
        if f and len(top) < 2 * n // 3 and all(sum(v * g.get(k, 0.0) for k, v in f.items()) < 0.9 for _, _, g in top):
            top.append((b" " + r.word.encode(), r.z, f))
    common = ranked.orderBy(F.desc("df"), "word").limit(n - 2 * n // 3).collect()
    return [w for w, _, _ in top], [z for _, z, _ in top], [b" " + r.word.encode() for r in common]


def _unit(f: dict[int, float]) -> dict[int, float]:
    norm = np.sqrt(sum(v * v for v in f.values()))
    return {k: v / norm for k, v in f.items()}


def train(docs: DataFrame, labels: DataFrame, train_rows, max_docs: int = 3000, landmarks: int = 384,
          rounds: int = 4, cost: float = 1.0, text: str = "text") -> Model:
    """Fit on ``labels`` rows that the Column ``train_rows`` selects; ``max_docs`` bounds the sample of each class."""
    tables.ship(docs.sparkSession)
    sample = tables.written(labelled_sample(docs, labels, train_rows, max_docs, text), "toxicity-sample")
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        share = sizes.get(1, 0) / max(1, sum(sizes.values()))
        return Model(offset=float(np.clip(np.log((share + 1e-9) / (1 - share + 1e-9)), -50, 50)))
    words, z, common = landmark_words(sample, landmarks)
    space = Nystroem([*words, *common])
    if not space.whiten.size:
        return Model(offset=float(np.log(sizes[1] / sizes[0])))
    weights = np.zeros(LETTERS ** ORDER, dtype=np.float32)
    for word, value in zip(words, z):
        for k, v in _unit(_features(word)).items():
            weights[k] += v * value
    # one array for all rounds: a window of each toxic text first, then those of clean texts as they come
    n_toxic, width = sizes[1], space.whiten.shape[1]
    x = np.zeros((n_toxic + 3 * rounds * sizes[0], width), dtype=np.float32)
    fold, y, end = np.zeros(len(x), dtype=np.int8), np.repeat([1, -1], [n_toxic, len(x) - n_toxic]), n_toxic
    seen: set[tuple[int, bytes]] = set()
    use = np.zeros(len(x), dtype=bool)
    for _ in range(rounds):
        found = _tops(sample, weights)
        toxic = [(part, tops[0]) for label, part, _, tops in found if label and tops]
        hard = sorted({(part, t) for label, part, _, tops in found if not label for t in tops} - seen)
        del found
        seen.update(hard)
        use[:n_toxic] = np.arange(n_toxic) < len(toxic)
        use[end:end + len(hard)] = True
        for at, rows in ((0, toxic), (end, hard)):
            space.map([t for _, t in rows], x[at:at + len(rows)])
            fold[at:at + len(rows)] = [part for part, _ in rows]
        end += len(hard)
        w, _ = fit_svm(x[:end], y[:end], cost, use=use[:end])
        weights = space.weights(w)
    del seen
    # the margins that set the probability come from models that have not seen their texts
    margins, labels_ = [], []
    for part in range(FOLDS):
        w, _ = fit_svm(x[:end], y[:end], cost, use=use[:end] & (fold[:end] != part))
        for label, _, margin, _ in _tops(sample.where(F.col("fold") == part), space.weights(w)):
            margins.append(margin)
            labels_.append(label)
    slope, offset = _logistic(np.array(margins), np.array(labels_))
    return Model(weights, slope, offset)


def _tops(sample: DataFrame, weights: np.ndarray) -> list[tuple[int, int, float, list[bytes]]]:
    """(label, fold, margin, highest windows) of the bounded sample."""
    shared = sample.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, tops = top_windows(spans.binary_column(batch, "text"), shared.value, 3)
            labels = [batch.column(batch.schema.get_field_index(c)) for c in ("toxic", "fold")]
            yield pa.RecordBatch.from_arrays([*labels, pa.array(best), pa.array(tops, pa.list_(pa.binary()))],
                                             names=["toxic", "fold", "margin", "tops"])

    rows = sample.mapInArrow(run, "toxic int, fold int, margin double, tops array<binary>").collect()
    shared.destroy()
    return sorted((r.toxic, r.fold, r.margin, [bytes(t) for t in r.tops or () if t]) for r in rows)


def score(docs: DataFrame, model: Model, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the probability of being toxic in ``column`` (replaced if there is one)."""
    tables.ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = spans.binary_column(batch, text)
            best, _ = top_windows(texts, shared.value.weights, 0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(f.name)) for f in kept), pa.array(shared.value.probability(best))],
                names=[*(f.name for f in kept), column])

    return docs.mapInArrow(run, T.StructType([*kept, T.StructField(column, T.DoubleType())]))


def held_out(doc_id: str = "doc_id"):
    """A third of all documents, by the checksum of their id; labels of the others train."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def report(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every document (held_out is false for a null doc_id)."""
    model = train(docs, labels, ~held_out())
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, with their own columns."""
    model = train(docs, labels, ~held_out())
    scored = score(tables.carried(docs, "text"), model)
    return scored.where(F.col("score") < threshold).select(f"{tables.ROW}.*")
