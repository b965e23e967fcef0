"""Structured Streaming forms: ST1-ST3, ST6, ST7.

* ST1 intake: a file source over landed feed rows (``maxFilesPerTrigger``
  bounds a micro-batch), run with ``availableNow`` or ``processingTime``.
* ST2 exactly-once per accession: ``dropDuplicates`` (state grows with the
  number of keys, parity with the reference) or the bounded
  ``dropDuplicatesWithinWatermark``.
* ST3 progress: the streaming checkpoint replaces the reference's
  every-15-rows save; a restart resumes after the last committed batch.
* ST6 minute bars from ticks and ST7 a daily digest: tumbling windows with
  a watermark, append mode (a window is emitted once the watermark passes
  its end, so the last open windows are held back).

Event times on the driver tables are TIMESTAMP_NTZ holding UTC wall clock;
watermarks need TIMESTAMP, so ``utc_instant`` converts without depending on
the session time zone, and ``to_utc_wall`` converts window bounds back.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealflow.functions.timefns import fmt_date, to_utc_wall, utc_instant  # noqa: F401
from dealflow.session import ensure_checkpoint_dir


def stream_workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return os.path.join(ensure_checkpoint_dir(spark), "dealflow-streams", f"{name}-{uuid.uuid4().hex}")


def land(df: DataFrame, path: str) -> None:
    """Write rows as parquet files for a file stream to pick up."""
    df.write.mode("error").parquet(path)


def file_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """ST1: a parquet file source with a fixed schema."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def dedup_exact(stream: DataFrame, key: str = "accession") -> DataFrame:
    """ST2 (parity): every key once, state keeps all keys."""
    return stream.where(F.col(key).isNotNull()).dropDuplicates([key])


def dedup_within_watermark(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """ST2 (bounded): duplicates are dropped while within ``delay`` of the
    watermark; state for older keys is evicted."""
    return (stream.where(F.col(key).isNotNull()).withWatermark(event_time, delay)
            .dropDuplicatesWithinWatermark([key]))


def minute_bars_stream(ticks: DataFrame, delay: str = "10 minutes", ticker: str = "ticker",
                       ts: str = "ts", price: str = "price", size: str = "size") -> DataFrame:
    """ST6: OHLCV per (ticker, minute) with a watermark on the tick time."""
    w = ticks.withWatermark(ts, delay)
    agg = (w.groupBy(F.window(ts, "1 minute").alias("win"), F.col(ticker).alias("ticker"))
           .agg(F.min_by(price, ts).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
                F.max_by(price, ts).alias("close"), F.sum(size).alias("volume")))
    return agg.select("ticker", to_utc_wall(F.col("win.start")).alias("minute"),
                      "open", "high", "low", "close", "volume")


def daily_digest_stream(filings: DataFrame, delay: str = "1 hour", ts: str = "event_time",
                        score: str = "impact_score", threshold: float = 5.0) -> DataFrame:
    """ST7: per UTC day, the low-impact filings (score below ``threshold``)."""
    low = filings.where(F.col(score).isNull() | (F.col(score) < F.lit(threshold)))
    agg = (low.withWatermark(ts, delay).groupBy(F.window(ts, "1 day").alias("win"))
           .agg(F.count(F.lit(1)).alias("n_low")))
    return agg.select(fmt_date(to_utc_wall(F.col("win.start"))).alias("day"), "n_low")


def run_available_now(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append",
                      timeout_s: float | None = None) -> int:
    """ST1/ST3: process everything available, commit per micro-batch to the
    checkpoint, then stop.  A rerun resumes from the checkpoint.

    Without ``timeout_s`` it waits until all is processed.  With it, a run
    that isn't done by then is stopped and raises ``TimeoutError``: the sink
    holds the committed batches only, and a rerun goes on from them.

    Returns how many rows this run dropped as later than the watermark."""
    q = (stream.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode(mode)
         .trigger(availableNow=True).start())
    try:
        done = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise q.exception()
    if timeout_s and not done:
        raise TimeoutError(f"the stream to {sink} was not finished after {timeout_s} s")
    return sum(s.numRowsDroppedByWatermark for p in q.recentProgress for s in p.stateOperators)
