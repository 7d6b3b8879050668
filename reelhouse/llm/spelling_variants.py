"""Spelling variants by finite-state composition: vocabulary o one edit o vocabulary.

Two words are near when exactly one inserted, deleted or replaced code point makes one from the other.  The
pairs are the paths of a composition of three machines: the minimised acyclic acceptor of the vocabulary, a
transducer that copies all but one code point, and the acceptor again.  Before the edit both acceptors are in
the same state; after it they read the same rest, so a pair is a shared beginning, an edit, and a string that
two states both accept.

The vocabulary is never in one place.  A pair of words whose shorter one has ``m`` code points has its first
difference in one window ``[s, t)`` of positions 0 to m (the last window holds position m as well, an
insertion at the end).  What stands before the window and what stands after it is equal in both words, so the
words that agree there are the ones below one initial state of the composition, and only they meet in a task:
one acceptor of the middles of length m, one of the middles of length m + 1.  First differences are unique, so
every pair comes from exactly one window, once.  Words start with two windows, the halves; groups above
``group_words`` are dealt again with their window halved, until a window is one position.  Such a group has at most
an alphabet of words of either length times an alphabet, whatever the size of the corpus, so a beginning that a
third of all words share ends up in many small groups.  Groups are found by a 64-bit hash and told apart in
the task by their contexts.

Tasks add up each word's near words before the shuffle (number, and the most frequent one).

Defined results: null and empty texts have no words; a null doc_id counts as the empty string in the damage
rule; rows that repeat count again; an empty table gives no rows; texts and words of any length are read whole;
other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import tables
from reelhouse.llm.block_names import normalised

#: Letters of a word after A-Z are lower-cased.
LETTERS = "[a-zÀ-ÿ]+"
#: States that one register may hold before it starts anew between two groups.
REGISTER = 200_000
FLUSH = 50_000


class Acceptor:
    """Minimal acyclic acceptors over one register: states with equal right languages are one state."""

    def __init__(self) -> None:
        self.register: dict[tuple, int] = {}
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.words: list[int] = []

    def _state(self, final: bool, arcs: list[tuple[str, int]]) -> int:
        key = (final, tuple(arcs))
        at = self.register.get(key)
        if at is None:
            at = self.register[key] = len(self.arcs)
            self.arcs.append(dict(arcs))
            self.final.append(final)
            self.words.append(final + sum(self.words[x] for _, x in arcs))
        return at

    def initial(self, words: list[str]) -> int:
        """The initial state for ``words``, which are sorted and distinct."""
        path: list[tuple[list, list]] = [([False], [])]  # unfinished states along the last word
        last = ""
        for word in words:
            shared = 0
            while shared < len(last) and shared < len(word) and last[shared] == word[shared]:
                shared += 1
            self._close(path, last, shared)
            path.extend(([False], []) for _ in range(len(word) - shared))
            path[-1][0][0] = True
            last = word
        self._close(path, last, 0)
        return self._state(path[0][0][0], path[0][1])

    def _close(self, path: list, last: str, depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            path[-1][1].append((last[len(path) - 1], self._state(final[0], arcs)))

    def common(self, x: int, y: int, but: str = "") -> Iterator[str]:
        """The strings that both states accept, without those that begin with ``but``."""
        stack = [(x, y, "")]
        while stack:
            x, y, read = stack.pop()
            if self.final[x] and self.final[y]:
                yield read
            mine, other = self.arcs[x], self.arcs[y]
            if len(other) < len(mine):
                mine, other = other, mine
            for c in mine:
                if c in other and (read or c != but):
                    stack.append((mine[c], other[c], read + c))

    def replaced(self, start: int) -> Iterator[tuple[str, str]]:
        """Pairs of accepted words that differ in one replaced code point."""
        stack = [(start, "")]
        while stack:
            p, read = stack.pop()
            arcs = [(c, x) for c, x in self.arcs[p].items()]
            for i, (c, x) in enumerate(arcs):
                for d, y in arcs[:i]:
                    for rest in self.common(x, y):
                        yield read + c + rest, read + d + rest
                if self.words[x] > 1:
                    stack.append((x, read + c))

    def inserted(self, short: int, long: int, at_end: bool) -> Iterator[tuple[str, str]]:
        """Pairs of a word accepted from ``short`` and one from ``long`` with one more code point, by their first difference."""
        stack = [(short, long, "")]
        while stack:
            p, q, read = stack.pop()
            for c, y in self.arcs[q].items():
                for rest in self.common(p, y, but=c):
                    if rest or at_end:
                        yield read + rest, read + c + rest
                if c in self.arcs[p]:
                    stack.append((self.arcs[p][c], y, read + c))


def _key() -> Column:
    more = F.char_length("word") - F.col("m")
    left = F.substring("word", F.lit(1), F.col("s"))
    right = F.substring("word", F.col("t") + more + 1, F.char_length("word"))
    return F.xxhash64("m", "s", "t", left, right)


def _dealt(rows: DataFrame, windows: Column) -> DataFrame:
    """Rows (word, n, m, s, t, h) for each of their windows, an array of (m, s, t)."""
    out = rows.select("word", "n", F.explode(windows).alias("w")).select("word", "n", "w.*")
    return out.withColumn("h", _key())


def _halves(m: Column, s: Column, t: Column) -> list[Column]:
    mid = F.floor((s + t) / 2).cast("int")
    return [F.struct(m.alias("m"), a.alias("s"), b.alias("t")) for a, b in ((s, mid), (mid, t))]


def groups(vocabulary: DataFrame, group_words: int = 10_000) -> DataFrame:
    """(word, n, m, s, t, h): words by window; those of one group have one ``h``."""
    size, none = F.char_length("word"), F.lit(0)
    level = _dealt(vocabulary, F.array(*_halves(size, none, size), *_halves(size - 1, none, size - 1)))
    done = []
    while True:
        big = tables.written(level.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.max(F.col("t") - F.col("s")).alias("wide"))
                             .where(F.col("k") > group_words).where("wide > 1").select("h"), "hot-windows")
        if big.isEmpty():
            done.append(level)
            break
        done.append(level.join(big, "h", "left_anti"))
        level = _dealt(level.join(big, "h", "left_semi"), F.array(*_halves(F.col("m"), F.col("s"), F.col("t"))))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _pairs(acceptor: Acceptor, rows: list[tuple[str, int, int, int, int]]) -> Iterator[tuple[str, str]]:
    """All near pairs of the groups that share a hash."""
    by_context: dict[tuple, tuple[set[str], set[str]]] = defaultdict(lambda: (set(), set()))
    for word, _, m, s, t in rows:
        more = len(word) - m
        by_context[m, s, t, word[:s], word[t + more:]][more].add(word[s:t + more])
    for (m, _, t, left, right), (short, long) in by_context.items():
        if len(short) + len(long) < 2 or not short:
            continue
        start = acceptor.initial(sorted(short))
        for a, b in acceptor.replaced(start):
            yield left + a + right, left + b + right
        if long:
            for a, b in acceptor.inserted(start, acceptor.initial(sorted(long)), at_end=t == m):
                yield left + a + right, left + b + right


def _each_group(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows (word, n, m, s, t) of one hash after another; rows come sorted by hash."""
    now, rows = None, []
    for batch in batches:
        h, *cols = (c.to_pylist() for c in batch.columns)
        for key, *row in zip(h, *cols):
            if key != now:
                if len(rows) > 1:
                    yield rows
                now, rows = key, []
            rows.append(tuple(row))
    if len(rows) > 1:
        yield rows


def _in_groups(vocabulary: DataFrame, group_words: int) -> DataFrame:
    tables.ship(vocabulary.sparkSession)
    return (groups(vocabulary, group_words).select("h", "word", "n", "m", "s", "t")
            .repartition("h").sortWithinPartitions("h"))


def near_pairs(vocabulary: DataFrame, group_words: int = 10_000) -> DataFrame:
    """(a, b): every pair of near words of ``vocabulary`` (word, n) once, the smaller word first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acceptor, out = Acceptor(), []
        for rows in _each_group(batches):
            out.extend((min(p), max(p)) for p in _pairs(acceptor, rows))
            acceptor = Acceptor() if len(acceptor.arcs) > REGISTER else acceptor
            if len(out) > FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*out)], names=["a", "b"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*out)], names=["a", "b"])

    return _in_groups(vocabulary, group_words).mapInArrow(run, "a string, b string")


def nearest_forms(vocabulary: DataFrame, group_words: int = 10_000) -> DataFrame:
    """(word, n_near, best, best_n): the number of near words and the most frequent of them (ties: the smallest)."""
    names = ["word", "n_near", "best", "best_n"]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acceptor, out = Acceptor(), []
        for rows in _each_group(batches):
            n = {row[0]: row[1] for row in rows}
            found: dict[str, list] = {}
            for a, b in _pairs(acceptor, rows):
                for word, other in ((a, b), (b, a)):
                    key = (-n[other], other)
                    if word not in found:
                        found[word] = [1, key]
                    else:
                        found[word][0] += 1
                        found[word][1] = min(found[word][1], key)
            out.extend((w, k, best[1], -best[0]) for w, (k, best) in found.items())
            acceptor = Acceptor() if len(acceptor.arcs) > REGISTER else acceptor
            if len(out) > FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)

    parts = _in_groups(vocabulary, group_words).mapInArrow(run, "word string, n_near long, best string, best_n long")
    first = F.struct((-F.col("best_n")).alias("k"), "best")
    return (parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(first).alias("f"))
            .select("word", "n_near", F.col("f.best").alias("best"), (-F.col("f.k")).alias("best_n")))


def vocabulary(docs: DataFrame, min_chars: int = 5, min_count: int = 3, damage: int | None = None, text: str = "text") -> DataFrame:
    """(word, n): lower-cased runs of letters with at least ``min_chars`` code points and ``min_count`` occurrences.

    With ``damage``, a run loses one code point where ``damage`` divides the crc32 of ``<doc_id>:<run>``, at the place
    that the crc32 names; such errors, known beforehand, are what the grouping is measured by.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(normalised(text), F.lit(LETTERS), F.lit(0))).alias("run"))
    word = F.col("run")
    if damage:
        h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run"))
        at = F.pmod(h, F.char_length("run").cast("long")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
        word = F.when(h % damage == 0, cut).otherwise(word)
    words = runs.select(word.alias("word")).where(F.char_length("word") >= min_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form; each round doubles the steps that a word has followed."""
    now = tables.written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("after"))
        step = now.join(on, "root", "left").select("word", F.coalesce("after", "root").alias("root"), F.col("after").isNotNull().alias("moved"))
        step = tables.written(step, "roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def variants(words: DataFrame, factor: int = 2, group_words: int = 10_000) -> DataFrame:
    """One row a word of ``words`` (word, n): word, form, root, n, n_near, form_n.

    A word's form is its most frequent near word, if that is at least ``factor`` (above 1) times as frequent; the root is
    where the forms lead.
    """
    if factor < 2:
        raise ValueError("factor must be 2 or more, or forms could run in circles")
    words = tables.written(words, "vocabulary")
    near = nearest_forms(words, group_words)
    is_form = F.col("best_n") >= factor * F.col("n")
    found = tables.written(words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    roots = _roots(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def report(docs: DataFrame, min_chars: int = 5, min_count: int = 3, damage: int | None = 97, factor: int = 2,
           group_words: int = 10_000, text: str = "text") -> DataFrame:
    return variants(vocabulary(docs, min_chars, min_count, damage, text), factor, group_words)
