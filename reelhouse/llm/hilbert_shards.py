"""Sharding along a Hilbert curve over several metadata dimensions, with DataFrame functions only.

Each dimension is quantised to 2^bits levels at quantiles of the table (approximate ones of
numbers; strings by running row counts over their distinct whole values), the curve index of the cell is
computed from the levels, and rows are ordered by (curve index, hash of doc_id, doc_id).  The order is cut
into runs whose row counts differ by one at most (law ``rows``).  Neighbouring cells differ in one
dimension by one level, so a run covers a narrow box in every dimension and file statistics prune.

The global rank needs no global sort and no single task over rows: rows are counted by (cell,
slice of the doc_id hash), the counts are summed along the order, and ranks within a slice come
from a window over that slice alone.  A hot cell is spread over all slices.

Defined results: a null text has size 1 and the checksum of the empty text; null dimensions count
as the lowest level; null doc_ids come first in their slice; repeated rows get slots of their own;
an empty table gives an empty result.  Columns named like a result are replaced, others pass
through ``assign(keep=...)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.llm import tables

SLICES = 1024


def curve_index(levels: list[Column], bits: int) -> Column:
    """The Hilbert index of integer levels 0 .. 2^bits - 1 (Skilling, 2004: axes to transposed index)."""
    n = len(levels)
    start = F.array(*[x.cast("int") for x in levels])
    steps = [(1 << b, i) for b in range(bits - 1, 0, -1) for i in range(n)]

    def undo(x: Column, s: Column) -> Column:
        q, low = s["q"], s["q"] - 1
        here = F.element_at(x, s["i"] + 1)
        swap = F.element_at(x, 1).bitwiseXOR(here).bitwiseAND(low)
        flip = here.bitwiseAND(q) != 0
        return F.transform(x, lambda v, j: F.when(flip & (j == 0), v.bitwiseXOR(low))
                           .when(~flip & ((j == 0) | (j == s["i"])) & (s["i"] != 0), v.bitwiseXOR(swap)).otherwise(v))

    walk = F.array(*[F.struct(F.lit(q).alias("q"), F.lit(i).alias("i")) for q, i in steps])
    order = F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(1 << b).alias("q")) for b in range(bits - 1, -1, -1) for i in range(n)])
    masks = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)])

    def gray(x: Column) -> Column:
        return F.transform(x, lambda v, j: F.aggregate(F.slice(x, 1, j + 1), F.lit(0), lambda a, b: a.bitwiseXOR(b)))

    def turned(g: Column) -> Column:
        top = F.element_at(g, n)
        turn = F.aggregate(masks, F.lit(0), lambda t, q: F.when(top.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))
        return _let(turn, lambda t: F.transform(g, lambda v: v.bitwiseXOR(t)))

    def interleaved(x: Column) -> Column:
        return F.aggregate(order, F.lit(0), lambda acc, s: acc * 2 + F.when(
            F.element_at(x, s["i"]).bitwiseAND(s["q"]) != 0, 1).otherwise(0))

    x = F.aggregate(walk, start, undo) if steps else start
    return _let(_let(_let(x, gray), turned if steps else lambda g: g), interleaved)


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` evaluated once, however often ``then`` uses it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def string_cuts(df: DataFrame, column: str, bits: int) -> list[str]:
    """Quantiles of whole strings: the values at which the running row count reaches each share.

    The distinct values are sorted in ranges, and the counts of the ranges are summed up apart, so no
    task holds all values.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    runs = tables.written(counts.repartitionByRange("value").withColumn("run", F.spark_partition_id()), "hilbert-values")
    before = runs.groupBy("run").agg(F.sum("n").alias("m")).select(  # one row a range
        "run", (F.sum("m").over(Window.orderBy("run")) - F.col("m")).alias("before"), F.sum("m").over(Window.partitionBy()).alias("total"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("run").orderBy("value"))
    reached = runs.join(before, "run").select("value", "total", upto.alias("upto"))
    cuts = [F.min(F.when(F.col("upto") * 2 ** bits >= F.col("total") * k, F.col("value"))).alias(f"c{k}") for k in range(1, 2 ** bits)]
    return [c for c in reached.agg(*cuts).first() if c is not None] if cuts else []


def quantised(df: DataFrame, dimensions: list[str], bits: int) -> list[Column]:
    """A level per dimension, cut at quantiles of the whole table."""
    kinds = dict(df.dtypes)
    strings = [c for c in dimensions if kinds[c] == "string"]
    columns = {c: F.col(c) if c in strings else F.col(c).cast("double") for c in dimensions}
    shares = F.array(*[F.lit(k / 2 ** bits) for k in range(1, 2 ** bits)])
    cuts = {c: string_cuts(df, c, bits) for c in strings}
    numbers = [c for c in dimensions if c not in strings]
    if numbers:
        found = df.agg(*[F.percentile_approx(columns[c], shares, F.lit(1000)) for c in numbers]).first()
        cuts.update(zip(numbers, found))
    out = []
    for c in dimensions:
        x, levels = columns[c], sorted(set(cuts[c] or ()), key=lambda v: v.encode() if isinstance(v, str) else v)
        out.append(reduce(lambda a, b: a + b, [F.when(x > c, 1).otherwise(0) for c in levels], F.lit(0)))
    return out


def assign(docs: DataFrame, shards: int = 8, dimensions: tuple[str, ...] = ("source", "lang", "size"), bits: int = 4,
           text: str = "text", keep: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and curve of every row; ``keep`` adds the input's columns."""
    new = ("size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve")
    docs = docs.drop(*new)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    size = (F.octet_length(body) + 1).cast("long")
    # dimensions get names of their own, and the input's columns travel in a struct
    cuts = {f"_d{i}": size if c == "size" else F.col(f"`{c}`") for i, c in enumerate(dimensions)}
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(tables.ROW)] if keep else []
    rows = docs.select("doc_id", size.alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
                       *[x.alias(name) for name, x in cuts.items()], *row)
    levels = quantised(rows, list(cuts), bits)
    # two steps: the levels are computed once, not once for each use
    rows = rows.withColumn("_levels", F.array(*levels))
    rows = rows.withColumn("curve", curve_index([F.element_at("_levels", i + 1) for i in range(len(dimensions))], bits))
    rows = rows.withColumn("_slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)).cast("int")).drop("_levels", *cuts)

    slices = rows.groupBy("curve", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    cells = slices.groupBy("curve").agg(F.sum("_n").alias("_cell"))  # 2^(bits * dimensions) rows at most
    cells = cells.select("curve", (F.sum("_cell").over(Window.orderBy("curve")) - F.col("_cell")).alias("_before"),
                         F.sum("_cell").over(Window.partitionBy()).alias("_total"))
    along = Window.partitionBy("curve").orderBy("_slice")
    slices = slices.withColumn("_in_cell", F.sum("_n").over(along) - F.col("_n"))
    offsets = slices.join(cells, "curve").select("curve", "_slice", (F.col("_before") + F.col("_in_cell")).alias("_base"), "_total")

    within = Window.partitionBy("curve", "_slice").orderBy("doc_id", "size", "text_crc32")
    ranked = rows.join(offsets, ["curve", "_slice"]).withColumn("_rank", F.col("_base") + F.row_number().over(within) - 1)
    shard = F.expr(f"_rank * {shards} div _total")
    first = F.expr(f"(shard * _total + {shards - 1}) div {shards}")  # the first rank of a shard
    ranked = ranked.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("_rank") - first)
    out = ranked.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))
    return out.select(f"{tables.ROW}.*" if keep else "doc_id", *new)


def write_shards(docs: DataFrame, path: str, shards: int = 8, files: int = 64) -> None:
    """Write the shards as folders ``shard=k`` of files that are runs of the curve."""
    cut = assign(docs, shards, keep=True)
    (cut.repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
