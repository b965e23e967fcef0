"""Registered queries: streaming intake, de-duplication, bars and digest.

``stream_bars`` streams the events table as it lies; the filing feeds, which
are derived from several tables, are landed as parquet files first.  Each runs
its stream with ``availableNow`` to a parquet sink with a checkpoint, in a
fresh folder under ``spark.checkpoint.dir``, and returns the sink.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from dealflow.functions.timefns import ntz_text, parse_published
from dealflow.plans import fx_filings as fxf
from dealflow.plans import oracle as osql
from dealflow.plans.q_filings import FEED_SQL, feed_ids, sql
from dealflow.plans.registry import register
from dealflow.sources.tables import table
from dealflow.streaming import streams as S

BAR_DELAY_MIN = 10
DIGEST_DELAY_H = 1


def _drained(spark, name, stream):
    ws = S.stream_workspace(spark, name)
    sink, ckpt = (os.path.join(ws, p) for p in ("sink", "checkpoint"))
    S.run_available_now(stream, sink, ckpt)
    return spark.read.parquet(sink)


def _run(spark, name, source_df, build):
    src = os.path.join(S.stream_workspace(spark, name), "input")
    S.land(source_df, src)
    return _drained(spark, name, build(S.file_stream(spark, src, source_df.schema)))


@register("stream_dedup", lambda: sql(FEED_SQL, query="SELECT DISTINCT accession FROM feed_ids WHERE accession IS NOT NULL"))
def stream_dedup(spark, sf_dir):
    """ST1 + ST2 + ST3: both feeds landed as files, each accession once."""
    rows = feed_ids(spark, sf_dir).select("accession", "feed", "k")
    out = _run(spark, "dedup", rows, lambda s: S.dedup_exact(s, "accession"))
    return out.select("accession")


@register("stream_bars", lambda: "WITH " + osql.BARS_FX + f"""
SELECT ticker, strftime(ts, '%Y-%m-%d %H:%M:%S') AS minute, open, high, low, close, volume
FROM bars_fx
WHERE ts + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL {BAR_DELAY_MIN} MINUTE""")
def stream_bars(spark, sf_dir):
    """ST6: minute bars from event ticks with a watermark; closed windows."""
    ev = S.file_stream(spark, f"{sf_dir}/events.parque[t]", table(spark, sf_dir, "events").schema)
    ticks = ev.select(F.col("event_type").alias("ticker"), S.utc_instant(F.col("ts")).alias("ts"),
                      F.col("value").alias("price"), (F.col("user_id") + 1).alias("size"))
    out = _drained(spark, "bars", S.minute_bars_stream(ticks, f"{BAR_DELAY_MIN} minutes"))
    return out.select("ticker", ntz_text(F.col("minute")).alias("minute"),
                      "open", "high", "low", "close", "volume")


def _digest_sql():
    from dealflow.plans.ox_ids import parse_published_sql
    return sql(f"""
dg AS (SELECT {parse_published_sql('published_raw')} AS event_time, impact_score FROM analysis_fx)""", query=f"""
SELECT strftime(date_trunc('day', event_time), '%Y-%m-%d') AS day, count(*) AS n_low
FROM dg
WHERE event_time IS NOT NULL AND (impact_score IS NULL OR impact_score < 5)
  AND date_trunc('day', event_time) + INTERVAL 1 DAY
      <= (SELECT max(event_time) FROM dg WHERE event_time IS NOT NULL) - INTERVAL {DIGEST_DELAY_H} HOUR
GROUP BY 1""")


@register("daily_digest", _digest_sql)
def daily_digest(spark, sf_dir):
    """ST7: low-impact filings per UTC day (the digest the docs describe)."""
    a = fxf.analysis_fx(spark, sf_dir)
    rows = (a.select(parse_published(F.col("published_raw")).alias("published_ts"), "impact_score")
             .where(F.col("published_ts").isNotNull())
             .select(S.utc_instant(F.col("published_ts")).alias("event_time"), "impact_score"))
    return _run(spark, "digest", rows, lambda s: S.daily_digest_stream(s, f"{DIGEST_DELAY_H} hour"))
