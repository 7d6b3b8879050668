"""Exact dedup by deterministic block naming (Karp, Miller, Rosenberg).

Texts are equal when identical after lower-casing A-Z.  Each text's bytes are cut into blocks
of a fixed size.  Level 0 sorts the distinct blocks and numbers them; each further level sorts
the distinct pairs of adjacent names and numbers those, until every document is one name.
Documents of one byte length finish at one level, so (length, name) is the same for two
documents if and only if their bytes are: names come from comparing contents, not from hashes.

At level 0 contents are shuffled once, to be grouped and sorted; the partitions of the grouping
are numbered apart (partition in the high bits, rank within the sorted partition in the low
ones).  Names go back to the blocks by a 64-bit hash of the block; blocks whose hash belongs to
several contents are found by counting and joined by content instead.

Names are written to the shared folder before they are used, so a retry cannot renumber them.

Defined results: null text is empty; all empty texts are one group; a null doc_id is smaller than
any other; of rows that repeat doc_id and text one is kept; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm import tables

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DOC = ["doc_id", "sha", "n_bytes"]


def normalised(text: str = "text") -> Column:
    """Null as empty, A-Z lower-cased, all else untouched."""
    t = F.coalesce(F.col(text), F.lit(""))
    ascii_only = F.octet_length(t) == F.char_length(t)
    return F.when(ascii_only, F.lower(t)).otherwise(F.translate(t, _UPPER, _LOWER))


def _numbered(distinct: DataFrame, *by: str) -> DataFrame:
    """Integer names of distinct rows, ascending in the sorted partitions."""
    return distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def identities(docs: DataFrame, block_bytes: int = 4096, text: str = "text", block_hash=F.xxhash64) -> DataFrame:
    """(doc_id, sha, n_bytes, name, copies) per distinct document row; sha is the binary SHA-256 of the normalised text."""
    body = docs.select("doc_id", normalised(text).cast("binary").alias("body"))
    body = body.select("doc_id", F.unhex(F.sha2("body", 256)).alias("sha"), F.octet_length("body").cast("long").alias("n_bytes"), "body")
    last = F.greatest(F.lit(0), F.ceil(F.col("n_bytes") / block_bytes).cast("int") - 1)
    blocks = body.select(*_DOC, "body", F.explode(F.sequence(F.lit(0), last)).alias("idx"))
    blocks = blocks.select(*_DOC, "idx", F.substring("body", F.col("idx") * block_bytes + 1, F.lit(block_bytes)).alias("block"))
    blocks = blocks.withColumn("h", block_hash("block"))

    names = tables.written(_numbered(blocks.groupBy("h", "block").agg(F.count(F.lit(1)).alias("_")), "block").select("h", "name"), "names")
    shared = names.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("name"))
    rows = blocks.groupBy(*_DOC, "idx", "h").agg(F.count(F.lit(1)).alias("copies"))
    level = rows.join(shared.where("n = 1").drop("n"), "h").drop("h")
    clash = shared.where("n > 1").select("h")
    if not clash.isEmpty():
        # several contents behind one hash: name these by content, with names that no other block has
        again = blocks.join(clash, "h", "left_semi")
        own = tables.written(_numbered(again.groupBy("block").agg(F.count(F.lit(1)).alias("_")), "block")
                             .select("block", (-1 - F.col("name")).alias("name")), "names")
        level = level.unionByName(again.groupBy(*_DOC, "idx", "block").agg(F.count(F.lit(1)).alias("copies")).join(own, "block").drop("block"))
    level = tables.written(level, "block-names")

    size, done = block_bytes, []
    while True:
        done.append(level.where(F.col("n_bytes") <= size).drop("idx"))
        rest = level.where(F.col("n_bytes") > size)
        if rest.isEmpty():
            break
        half = F.col("idx") % 2
        pairs = tables.written(rest.groupBy(*_DOC, F.shiftright("idx", 1).alias("idx")).agg(
            F.max(F.when(half == 0, F.col("name"))).alias("a"),
            F.max(F.when(half == 1, F.col("name"))).alias("b"), F.max("copies").alias("copies")), "pairs")
        # an odd last name has no partner: b is null, which equals only null
        found = tables.written(_numbered(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("_")), "a", "b").drop("_"), "names")
        found = found.select(F.col("a").alias("a2"), F.col("b").alias("b2"), "name")
        joined = pairs.join(found, (F.col("a") == F.col("a2")) & F.col("b").eqNullSafe(F.col("b2")))
        level = tables.written(joined.select(*_DOC, "idx", "copies", "name"), "block-names")
        size *= 2
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def exact_groups(docs: DataFrame, block_bytes: int = 4096, text: str = "text", block_hash=F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    found = identities(docs, block_bytes, text, block_hash)
    groups = found.groupBy("n_bytes", "name").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    rows = found.join(groups, ["n_bytes", "name"]).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)
    return rows.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
