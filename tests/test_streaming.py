"""Stream = batch: replayed files, restart from a checkpoint, closed windows."""

import os

from pyspark.sql import functions as F

from dealflow.operators.bars import minute_bars
from dealflow.sources.tables import table
from dealflow.streaming import streams as S


def test_dedup_replay_and_restart(spark, tmp_path):
    schema = "accession string, k bigint"
    src, sink, ckpt = (str(tmp_path / p) for p in ("in", "out", "ckpt"))
    spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], schema).write.parquet(os.path.join(src, "f1"))
    spark.createDataFrame([("B", 4), ("C", 5)], schema).write.parquet(os.path.join(src, "f2"))
    stream = S.file_stream(spark, src + "/*", spark.createDataFrame([], schema).schema, max_files=1)
    S.run_available_now(S.dedup_exact(stream), sink, ckpt)
    first = sorted(r.accession for r in spark.read.parquet(sink).collect())
    assert first == ["A", "B", "C"]
    # a replayed file plus a new key, same checkpoint: only the new key is written
    spark.createDataFrame([("A", 6), ("D", 7)], schema).write.parquet(os.path.join(src, "f3"))
    stream = S.file_stream(spark, src + "/*", spark.createDataFrame([], schema).schema, max_files=1)
    S.run_available_now(S.dedup_exact(stream), sink, ckpt)
    assert sorted(r.accession for r in spark.read.parquet(sink).collect()) == ["A", "B", "C", "D"]


def test_stream_bars_equal_batch_over_closed_windows(spark, sf_small, tmp_path):
    ev = table(spark, sf_small, "events")
    ticks = ev.select(F.col("event_type").alias("ticker"), S.utc_instant(F.col("ts")).alias("ts"),
                      F.col("value").alias("price"), (F.col("user_id") + 1).alias("size"))
    src = str(tmp_path / "ticks")
    ticks.where(F.dayofmonth("ts") <= 15).write.parquet(src + "/a")
    ticks.where(F.dayofmonth("ts") > 15).write.parquet(src + "/b")
    stream = S.file_stream(spark, src + "/*", ticks.schema)
    sink, ckpt = str(tmp_path / "bars"), str(tmp_path / "ck")
    S.run_available_now(S.minute_bars_stream(stream, "10 minutes"), sink, ckpt)
    got = {(r.ticker, r.minute, r.open, r.close, r.volume) for r in spark.read.parquet(sink).collect()}
    batch = minute_bars(ev.select(F.col("event_type").alias("ticker"), "ts", F.col("value").alias("price"),
                                  (F.col("user_id") + 1).alias("size")))
    max_ts = ev.agg(F.max("ts")).first()[0]
    import datetime as dt
    closed = batch.where(F.col("ts") + F.expr("INTERVAL 1 MINUTE") <= F.lit(max_ts - dt.timedelta(minutes=10)))
    want = {(r.ticker, r.ts, r.open, r.close, r.volume) for r in closed.collect()}
    assert got == want and len(got) > 0


def test_dedup_within_watermark_bounded(spark, tmp_path):
    import datetime as dt
    schema = "accession string, t timestamp"
    src = str(tmp_path / "w")
    base = dt.datetime(2024, 1, 1, 12, 0)
    spark.createDataFrame([("A", base), ("A", base + dt.timedelta(minutes=1)), ("B", base)], schema) \
        .write.parquet(src + "/1")
    stream = S.file_stream(spark, src + "/*", spark.createDataFrame([], schema).schema)
    S.run_available_now(S.dedup_within_watermark(stream, "accession", "t", "1 hour"),
                        str(tmp_path / "o"), str(tmp_path / "c"))
    assert sorted(r.accession for r in spark.read.parquet(str(tmp_path / "o")).collect()) == ["A", "B"]


def test_a_stream_cut_short_raises(spark, tmp_path):
    import pytest
    src = str(tmp_path / "many")
    spark.range(4000).repartition(40).write.parquet(src)
    stream = S.file_stream(spark, src, spark.range(1).schema, max_files=1)
    sink, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    with pytest.raises(TimeoutError):
        S.run_available_now(stream, sink, ckpt, timeout_s=2)
    S.run_available_now(S.file_stream(spark, src, spark.range(1).schema, max_files=20), sink, ckpt)
    assert spark.read.parquet(sink).distinct().count() == 4000
