"""S11s: incremental upsert of newly arrived files with Structured Streaming.

A file stream (``readStream``) tracks which files were processed in its
checkpoint, so each batch holds only new rows; ``foreachBatch`` applies the same
upsert plan as the batch loader; ``trigger(availableNow=True)`` processes what
is there and stops, which makes it a scheduled incremental job.  A restarted
query resumes from the checkpoint (exactly-once file tracking; an upsert is
idempotent, so a micro-batch replayed after a failure gives the same table).

Semantics: the newest row per key by ``order_by`` wins, within a micro-batch and across them, so
files that arrive late or in another order give the same table (of rows with the same order the
later arrival wins; ``newest_wins=False`` lets the later arrival win always).  A micro-batch
replaces only the key buckets it touches (``KeyedTarget``).  ``policy`` is the schema-change policy
for columns that the stream's schema has and the table has not.

With a ``ledger`` the ids of the micro-batches that were merged are kept in it, and a batch that is
replayed after a crash between merge and checkpoint is skipped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.loads import KeyedTarget, Target, write_frame


def start_upsert_stream(spark: SparkSession, source_dir: str, schema: T.StructType | str,
                        target: KeyedTarget, order_by: Sequence[str],
                        checkpoint_location: str, fmt: str = "parquet",
                        max_files_per_trigger: int | None = None, policy: str = "fail",
                        newest_wins: bool = True, ledger: Target | None = None) -> StreamingQuery:
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source_dir)

    def apply_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        if ledger and ledger.exists(session) and not ledger.read(session).where(F.col("batch_id") == epoch_id).isEmpty():
            return
        target.upsert(session, batch, order_by, newest_wins=newest_wins, policy=policy)
        if ledger:
            write_frame(session.range(1).select(F.lit(epoch_id).cast("long").alias("batch_id")), ledger, "append")

    return (stream.writeStream.foreachBatch(apply_batch)
            .option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True)
            .start())
