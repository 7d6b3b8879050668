"""Mixing sources to target weights that change over training, with DataFrame functions only.

Targets.  Sources in code point order (null last) weigh 5, 2, 1, repeating, and share the words of
all documents; a target stops at 3 times its source's words, and the excess is reshared by weight
until none is above.  That fixed point is ``min(3 * size, level * weight)`` for one level, found by
running sums over the sources in order of ``3 * size / weight``.

Curriculum.  A source's weight at training time t in [0, 1] is ``weight * (1 + slope * (2 t - 1))``.
Its integral, scaled to the target, is the source's cumulative token demand
``target * (t + slope * (t^2 - t))``.  The source's documents form a stream in the order of the MD5 of
their doc_id, repeated as often as the target needs.  A copy that starts at word c of the stream is
due when the demand reaches c: its training position is the inverse of the demand at c.

The word at which a document starts is a sum over the documents before it.  It is taken in two steps
(slices of the MD5, then documents within a slice), so no task holds a whole source.

Defined results: null text has no words; a null source is a source of its own; null doc_ids are
streamed by the MD5 of the empty string; repeated rows are documents of their own; an empty table, or
one without words, takes nothing; the input's columns pass through ``mixed`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.llm import tables

WEIGHTS = (5, 2, 1)
SLOPES = (0.5, 0.0, -0.5)
MOST = 3
NEW = ("size", "source_size", "target", "taken", "position")
WORKING = ("_start", "_budget", "slope")


def n_words(text: str = "text") -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _cycle(values: tuple, rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (rank % len(values) + 1).cast("int"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, slopes: tuple[float, ...] = SLOPES) -> DataFrame:
    """(source, source_size, target, slope) of a table (source, source_size) with one row a source."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = sizes.withColumn("_rank", rank).withColumn("_w", _cycle(weights, F.col("_rank"))).withColumn("slope", _cycle(slopes, F.col("_rank")))
    rows = rows.withColumn("_cap", MOST * F.col("source_size"))
    whole = Window.partitionBy()
    before = Window.orderBy(F.col("_cap") / F.col("_w"), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    open_ = F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0))
    rows = rows.withColumn("_level", left.cast("double") / open_)
    level = F.max("_level").over(whole)
    target = F.least(F.col("_cap").cast("double"), level * F.col("_w"))
    return rows.select("source", "source_size", target.alias("target"), "slope")


def due(offset: Column) -> Column:
    """The time at which the demand of ``target`` with ``slope`` reaches ``offset`` words."""
    u = offset.cast("double") / F.col("target")
    one = 1.0 - F.col("slope")
    return (2.0 * u) / (one + F.sqrt(one * one + (4.0 * F.col("slope")) * u))


def plan(docs: DataFrame, text: str = "text", keep: bool = False) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken, position (of its first copy; null if nothing is taken).

    ``keep`` adds the input's columns, and ``_start``, ``_budget``, ``slope``, from which ``due`` gives the
    position of every copy.  Columns of the input with one of these names are left out.
    """
    rows = _planned(docs, text, keep)
    if not keep:
        return rows.select("doc_id", *NEW)
    own = [F.col(f"{tables.ROW}.`{c}`") for c in docs.columns if c not in (*NEW, *WORKING)]
    return rows.select(*own, *WORKING, *NEW)


def _planned(docs: DataFrame, text: str, keep: bool) -> DataFrame:
    rows = tables.carried(docs, *dict.fromkeys(("doc_id", "source", text))).withColumn("size", n_words(text))
    rows = rows.select("doc_id", "source", "size", *([tables.ROW] if keep else []))
    rows = rows.withColumn("_md5", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    rows = rows.withColumn("_slice", F.substring("_md5", 1, 3))
    key = F.struct("source").alias("_source")  # a struct is never null, so it joins null sources too
    slices = rows.groupBy("source", "_slice").agg(F.sum("size").alias("_n"))
    aims = targets(slices.groupBy("source").agg(F.sum("_n").alias("source_size")))
    aims = aims.select(key, "source_size", "target", "slope")
    along = Window.partitionBy("source").orderBy("_slice")
    slices = slices.select(key, "_slice", (F.sum("_n").over(along) - F.col("_n")).alias("_base"))
    offsets = slices.join(aims, "_source")

    within = (Window.partitionBy("_source", "_slice").orderBy("_md5", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_source", F.struct("source")).join(offsets, ["_source", "_slice"])
    rows = rows.withColumn("_start", F.col("_base") + F.sum("size").over(within) - F.col("size"))
    rows = rows.withColumn("_budget", F.floor(F.col("target") + 0.5).cast("long"))
    rest = F.expr("_budget % source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_start")))
    taken = F.when(F.col("source_size") > 0, F.expr("_budget div source_size") * F.col("size") + part).otherwise(F.lit(0))
    rows = rows.withColumn("taken", taken.cast("long"))
    rows = rows.withColumn("position", F.when(F.col("taken") > 0, due(F.col("_start"))))
    return rows.select(*([tables.ROW] if keep else []), "doc_id", *WORKING, *NEW)


def scheduled(docs: DataFrame, text: str = "text", keep: bool = False) -> DataFrame:
    """The rows of ``plan``, range-sorted by position (rows that are not taken last).

    ``keep`` also adds ``positions``: those of all copies that are begun, in ascending order.
    """
    rows = plan(docs, text, keep)
    if keep:
        copies = F.when(F.col("taken") > 0, F.sequence(F.lit(0), (F.ceil(F.col("taken") / F.col("size")) - 1).cast("int")))
        rows = rows.withColumn("positions", F.transform(
            F.coalesce(copies, F.array().cast("array<int>")), lambda k: due(F.col("_start") + k * F.col("source_size"))))
    order = [F.col("position").asc_nulls_last(), F.col("doc_id").asc_nulls_first()]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def mixed(docs: DataFrame, text: str = "text") -> DataFrame:
    """The training stream: rows of ``docs``, each as often as it is taken, range-sorted by position.

    Whole documents: the copy in which the budget ends counts if half of its words are within.  Documents
    without words have no demand and are left out.
    """
    rows = _planned(docs, text, keep=True).where("taken > 0")
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    rows = rows.withColumn("_copies", copies).where("_copies > 0")
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    rows = rows.withColumn("_position", due(F.col("_start") + F.col("_copy") * F.col("source_size")))
    rows = rows.select(tables.ROW, "_position", "doc_id")
    return rows.repartitionByRange("_position").sortWithinPartitions("_position", "doc_id").select(f"{tables.ROW}.*")

