"""J1 + S9 on a stream: landed feed rows against the stored ledger, each new accession once.

A micro-batch keeps the first row of each accession (in feed order) that the ledger lacks and writes those rows as
the ledger's partition of that batch.  A batch that is delivered again, as after a crash between the write and the
stream's commit, reads the ledger without its own partition and writes the same rows in its place, so the ledger
holds each accession once whatever is repeated.  State is the ledger itself: nothing is kept in the stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from dealflow.operators.ledger import drop_without, first_per_key, not_processed
from dealflow.sources.store import replace_partitions, stored

BATCH = "batch_id"
SEED = -1                                      # the batch of rows that were there before the stream


def ledger_schema(rows: StructType) -> StructType:
    return StructType([*rows.fields, StructField(BATCH, LongType())])


def ledger_sink(path: str, key: str = "accession", order: str = "feed_rank") -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function that extends the ledger at ``path``."""
    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = stored(spark, path, ledger_schema(batch.schema)).where(F.col(BATCH) != batch_id)
        new = not_processed(first_per_key(drop_without(batch, key), key, order), known.select(key), key)
        replace_partitions(new.withColumn(BATCH, F.lit(batch_id).cast("long")), path, BATCH)

    return put


def seed_ledger(rows: DataFrame, path: str) -> None:
    """Rows processed before the stream began."""
    replace_partitions(rows.withColumn(BATCH, F.lit(SEED).cast("long")), path, BATCH)


def run_ledger_stream(stream: DataFrame, path: str, checkpoint: str, key: str = "accession",
                      order: str = "feed_rank") -> None:
    """Take everything that has landed into the ledger, then stop; a rerun goes on from the checkpoint."""
    q = (stream.writeStream.foreachBatch(ledger_sink(path, key, order)).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def read_stream_ledger(spark: SparkSession, path: str, rows: StructType) -> DataFrame:
    return stored(spark, path, ledger_schema(rows))
