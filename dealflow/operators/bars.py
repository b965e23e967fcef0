"""ST6 (batch form) and S7: minute bars from ticks, daily bars from minute bars.

Both are hash aggregates whose partial phase runs before the shuffle, so a
ticker holding a third of all ticks still sends one partial row per
(ticker, minute) per input partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealflow.functions.timefns import minute_floor


def minute_bars(ticks: DataFrame, ticker: str = "ticker", ts: str = "ts",
                price: str = "price", size: str = "size") -> DataFrame:
    """OHLCV per (ticker, minute): open = price of the first tick, close =
    price of the last tick, volume = sum of sizes."""
    t = ticks.select(F.col(ticker).alias("_tk"), F.col(ts).alias("_ts"),
                     F.col(price).alias("_px"), F.col(size).alias("_sz"))
    return (t.groupBy(F.col("_tk").alias("ticker"), minute_floor(F.col("_ts")).alias("ts"))
            .agg(F.min_by("_px", "_ts").alias("open"),
                 F.max("_px").alias("high"),
                 F.min("_px").alias("low"),
                 F.max_by("_px", "_ts").alias("close"),
                 F.sum("_sz").alias("volume")))


def daily_bars(bars: DataFrame) -> DataFrame:
    """Daily OHLCV per (ticker, UTC date) from minute bars."""
    return (bars.groupBy("ticker", F.to_date("ts").alias("d"))
            .agg(F.min_by("open", "ts").alias("open"),
                 F.max("high").alias("high"),
                 F.min("low").alias("low"),
                 F.max_by("close", "ts").alias("close"),
                 F.sum("volume").alias("volume")))
