"""Views that derive the reference's input shapes from the driver tables.

Every view is an ordinary Spark expression over the driver tables, so its
size grows with the scale factor.  The DuckDB twins live in
``dealflow.plans.oracle``; both follow the definitions in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealflow.functions.timefns import filing_context, fmt_date
from dealflow.operators.bars import daily_bars, minute_bars
from dealflow.sources.tables import table

# The benchmark series of the fixtures is the 'view' event type.
FX_BENCHMARK = "view"


# --------------------------------------------------------------------------
# events family: minute bars, daily bars, alerts
# --------------------------------------------------------------------------

def bars_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    ticks = ev.select(F.col("event_type").alias("ticker"), "ts", F.col("value").alias("price"),
                      (F.col("user_id") + 1).alias("size"))
    return minute_bars(ticks)


def daily_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_bars(bars_fx(spark, sf_dir))


def alerts_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    k = F.col("event_id")
    structure = (F.when(k % 5 == 0, F.lit("all-cash")).when(k % 5 == 1, F.lit("all-stock"))
                 .when(k % 5 == 2, F.lit("mixed")).when(k % 5 == 3, F.lit(""))
                 .otherwise(F.lit(None).cast("string")))
    return (ev.where(F.col("event_type") != F.lit(FX_BENCHMARK))
            .select(k.alias("alert_id"),
                    F.col("event_type").alias("ticker"),
                    F.col("ts").alias("filing_ts"),
                    F.col("value").alias("price_at_filing"),
                    F.when(k % 2 == 0, F.lit("bullish")).otherwise(F.lit("neutral")).alias("direction"),
                    (k % 12).cast("double").alias("groq_score"),
                    structure.alias("deal_structure"),
                    F.concat_ws("-", F.col("event_type"), fmt_date(F.col("ts"))).alias("id"),
                    filing_context(F.col("ts")).alias("filing_context")))
