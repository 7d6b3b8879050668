"""Secret scans with character Markov models, with DataFrame functions only.

Three patterns give the base spans (``assign``, ``access``, ``hex``).  Two first-order Markov models
over characters add ``markov`` spans: one of random strings, one of ordinary identifiers.  Their
labelled samples come from the whole table and from a table of identifiers: values that the base patterns
find are random strings, all other tokens of 12 or more characters are ordinary ones, and so are the
tokens of ``ordinary`` (by default ``identifiers()``, some 1,800 by a rule).  Character pairs are counted
by one grouped sum (the counts are bounded by the square of the alphabet, whatever the tables' sizes).
Half of the random model's mass is spread evenly over the alphabet, so keys of other alphabets than the
samples' score too.  The ordinary model is mixed in fixed shares of the table's pairs (in lower case,
capitalised and in capitals), the identifiers' pairs and an even part, so that one pair that no sample has
does not decide.  A token of 16 or more characters is a secret when its log-likelihood ratio exceeds
``least`` nats.

Positions.  SQL has no function for all positions of a pattern.  But splitting a text at a pattern gives
the gaps between its matches: a match starts after the lengths of all gaps and matches before it.  Only
these lengths leave the scan; a window per row sums them up, so many matches in one text stay linear.

Defined results: null text is empty; a text without spans has counts 0 and the digest of the empty
string; repeated rows are reported one by one; a table without any base match trains the random model on
the even part alone, one without ordinary tokens has the ordinary model of the identifiers alone; null and
empty identifiers are ignored; other columns are ignored.  A random
string inside a base span is listed by both.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The base patterns, and the least length of a match (for ``assign``, of its second group).
PATTERNS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"[0-9a-f]{24,}+",
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SAMPLE_TOKEN = r"[A-Za-z0-9+/_=-]{12,}+"
TOKEN = r"[A-Za-z0-9+/_=-]{16,}+"
KINDS = ("assign", "access", "hex", "markov")
#: The log-likelihood ratio above which a token is a secret.
LEAST_RATIO = 4.0
#: Shares of the ordinary model: pairs of the table, pairs of the identifiers; the rest is even.
SHARES = (0.35, 0.5)
#: Words that names in programs are made of.
NAME_WORDS = (
    "access account action active address array async attribute backup balance batch binary block body bool branch "
    "broker button byte cache callback card channel char check child class client clock cluster code column command "
    "config connect content context control copy count create cursor data date debug default delete depth device "
    "digest disk domain driver edge email enable encode entry error event exception export factory field file filter "
    "flag format frame function gateway global graph group guard handler hash header height host image import index "
    "input instance item iterator job json key label layer length level limit link list load local lock logger loop "
    "manager map matrix max member memory merge message method metric min mode model module mutex name network node "
    "null number object offset option order output owner packet page parent parser password path pattern payload "
    "pixel point policy pool port position prefix process profile project property proxy query queue range rate "
    "record register remote request reset resource response result retry return role root route row rule sample "
    "schema scope screen script search section select server service session shape share size socket sort source "
    "stack state status storage stream string style submit switch symbol sync system table target task template "
    "test text thread time token total track transfer tree trigger type update upload user util valid value vector "
    "version view volume wait web width window worker wrapper write yield zone"
).split()


def identifiers(spark: SparkSession) -> DataFrame:
    """(token): ordinary names of two to four words, in five spellings, some with a version or a year."""
    n, tokens = len(NAME_WORDS), []
    for i in range(n):
        words = [NAME_WORDS[(i * a + a // 2) % n] for a in (1, 7, 31, 101)][:2 + i % 3]
        caps = [w.capitalize() for w in words]
        end = ("", "", "2", "v1", "v3", "2019", "2024", "10", "01")[i % 9]
        tail = lambda by: by + end if end else ""
        tokens += [words[0] + "".join(caps[1:]) + end, "".join(caps) + end, "_".join(words) + tail("_"),
                   "-".join(words) + tail("-"), "_".join(words).upper() + tail("_").upper(), "/".join(words) + tail("/")]
    return spark.createDataFrame([(t,) for t in tokens], "token string")


def _maybe(text: Column, kind: str) -> Column:
    """A cheap test that no text with a match fails."""
    return F.contains(text, F.lit("AKIA")) if kind == "access" else F.regexp_like(text, F.lit(PATTERNS.get(kind, TOKEN)))


def _pairs(token: Column) -> Column:
    """The codes of adjacent character pairs of a token of the alphabet."""
    size = len(ALPHABET)
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    return F.element_at(F.transform(F.array(codes), lambda x: F.zip_with(
        F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), lambda a, b: a * size + b)), 1)


def values(text: Column) -> Column:
    """What the base patterns find: candidate random strings."""
    found = [F.regexp_extract_all(text, F.lit(PATTERNS[k]), 2 if k == "assign" else 0) for k in PATTERNS]
    parts = [F.when(_maybe(text, k), f).otherwise(F.array().cast("array<string>")) for k, f in zip(PATTERNS, found)]
    return F.array_distinct(F.concat(*parts))


def _capitals(seen: dict[int, int]) -> dict[int, int]:
    """Pair counts with those of small letters repeated for capitals and for a capital first."""
    size, out = len(ALPHABET), dict(seen)
    for pair, n in seen.items():
        a, b = divmod(pair, size)
        if a < 26 and b < 26:
            for other in ((a + 26) * size + b, (a + 26) * size + b + 26):
                out[other] = out.get(other, 0) + n
    return out


def _chances(seen: dict[int, int], prior: float = 1.0) -> list[float] | None:
    """The chance of the second character after the first, for each pair; None where nothing was seen.

    An even part weighs as much as ``prior`` pairs of each first character.
    """
    size = len(ALPHABET)
    if not seen:
        return None
    total = [sum(seen.get(a * size + b, 0) for b in range(size)) for a in range(size)]
    return [(seen.get(p, 0) + prior / size) / (total[p // size] + prior) for p in range(size * size)]


def train(docs: DataFrame, text: str = "text", ordinary: DataFrame | None = None) -> list[float]:
    """The log-likelihood ratio (random to ordinary) of each pair of characters, from all rows.

    ``ordinary`` has a string column ``token`` of names that are no secrets.
    """
    size = len(ALPHABET)
    bad = rf"[^{ALPHABET.replace('-', '')}-]"
    clean = lambda t: F.regexp_replace(t, bad, "")
    rows = docs.select(F.col(text).alias("text")).where(F.regexp_like("text", F.lit(SAMPLE_TOKEN)))
    rows = rows.select(values(F.col("text")).alias("found"), F.array_distinct(
        F.regexp_extract_all("text", F.lit(SAMPLE_TOKEN), 0)).alias("tokens"))
    random = F.transform(F.filter("found", lambda v: F.length(v) >= 12), lambda v: F.struct(
        F.lit(1).alias("label"), clean(v).alias("token")))
    plain = F.transform(F.filter("tokens", lambda t: ~F.exists("found", lambda v: F.contains(t, v) | F.contains(v, t))),
                        lambda t: F.struct(F.lit(0).alias("label"), t.alias("token")))
    tokens = rows.select(F.explode(F.concat(random, plain)).alias("s")).select("s.*")
    names = identifiers(docs.sparkSession) if ordinary is None else ordinary
    tokens = tokens.unionByName(names.select(F.lit(2).alias("label"), clean(F.col("token")).alias("token")).where("token <> ''"))
    counts = tokens.select("label", F.explode(_pairs(F.col("token"))).alias("pair")).groupBy("label", "pair").count()
    seen: dict[int, dict[int, int]] = {0: {}, 1: {}, 2: {}}
    for r in counts.collect():  # 3 * 67^2 rows at most
        seen[r.label][r.pair] = r["count"]
    even = [1.0 / size] * (size * size)
    found, prose, named = _chances(seen[1], size) or even, _chances(_capitals(seen[0])), _chances(seen[2])
    if prose is None and named is None:
        return [0.0] * size * size
    prose, named = prose or named, named or prose
    x, y = SHARES
    return [math.log((0.5 * e + 0.5 * f) / (x * p + y * q + (1 - x - y) * e)) for e, f, p, q in zip(even, found, prose, named)]


def _lengths(text: Column, kind: str, number: int, ok) -> Column:
    """For each match of a kind: its number, the length of the gap before it, its length, and if it counts."""
    pattern = F.lit(PATTERNS.get(kind, TOKEN))
    gaps = F.split(text, PATTERNS.get(kind, TOKEN), -1)
    whole = F.regexp_extract_all(text, pattern, 0)
    checked = F.regexp_extract_all(text, pattern, 2) if kind == "assign" else whole
    rows = F.transform(F.arrays_zip(gaps.alias("g"), whole.alias("m"), checked.alias("c")), lambda x, i: F.struct(
        F.lit(number).alias("kind"), i.alias("i"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("size"), ok(x["c"]).alias("ok")))
    some = F.filter(rows, lambda r: r["size"].isNotNull())
    return F.when(_maybe(text, kind), some).otherwise(F.array().cast("array<struct<kind:int,i:int,gap:int,size:int,ok:boolean>>"))


def find_secrets(docs: DataFrame, model: list[float], least: float = LEAST_RATIO, text: str = "text") -> DataFrame:
    """Per row: doc_id and ``found``, the sorted spans (start, kind number, end) in code points."""
    ratios = F.lit([float(x) for x in model])
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", t.alias("text"))
    body = F.col("text")

    def random(token: Column) -> Column:
        return F.aggregate(_pairs(token), F.lit(0.0), lambda acc, p: acc + F.element_at(ratios, p + 1)) > least

    kinds = [_lengths(body, k, i, (lambda v, k=k: F.length(v) >= LEAST[k]) if k in LEAST else random) for i, k in enumerate(KINDS)]
    rows = rows.select("row", "doc_id", F.explode_outer(F.concat(*kinds)).alias("m")).select("row", "doc_id", "m.*")
    rows = rows.repartition("row")
    along = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(along))
    span = F.struct((F.col("end") - F.col("size")).alias("start"), "kind", "end")
    return rows.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.when(F.col("ok"), span))).alias("found")).drop("row")


def _joined(found: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, least: float = LEAST_RATIO, ordinary: DataFrame | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov of every row."""
    found = find_secrets(docs, train(docs, ordinary=ordinary), least)
    count = lambda i: F.size(F.filter("found", lambda s: s["kind"] == i)).cast("long")
    base = _joined(F.filter("found", lambda s: s["kind"] < 3))
    return found.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                        F.sha2(base, 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))


def masked(docs: DataFrame, least: float = LEAST_RATIO, text: str = "text") -> DataFrame:
    """(doc_id, text) with every span replaced by asterisks; rows are joined by doc_id, which must be unique."""
    found = find_secrets(docs.select("doc_id", F.col(text).alias("text")), train(docs, text), least)
    joined = docs.select("doc_id", text).join(found, "doc_id", "left")
    step = F.aggregate(
        F.coalesce("found", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")),
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.struct(
            F.concat(acc.out, F.substring(F.col(text), (acc.at + 1).cast("int"), F.greatest(F.lit(0), s.start - acc.at).cast("int")),
                     F.repeat(F.lit("*"), F.greatest(F.lit(0), s.end - F.greatest(s.start, acc.at)).cast("int"))).alias("out"),
            F.greatest(acc.at, s.end).alias("at")),
        lambda acc: F.concat(acc.out, F.substring(F.col(text), (acc.at + 1).cast("int"), F.length(F.col(text)))))
    return joined.select("doc_id", F.when(F.size("found") > 0, step).otherwise(F.col(text)).alias(text))
