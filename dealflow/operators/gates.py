"""Row gates: F1, F3, F5, F7, F8, F10, F12 (F2/F4/F11 are text predicates in
``dealflow.functions.text``; F6/F9 live with the ledger)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealflow.functions.numeric import truthy
from dealflow.functions.text import has_item_101_v2

# Fixed values (reference defaults): liquidity thresholds.
MIN_MARKET_CAP = 100_000_000
MIN_AVG_VOLUME = 100_000
MIN_DOLLAR_VOLUME = 500_000


def form_filter(df: DataFrame, title: str = "title", form: str = "8-K") -> DataFrame:
    """the title mentions the form."""
    return df.where(F.col(title).contains(form))


def item_gate(has_item_meta: Column, raw: Column) -> Column:
    """F3 then F2: metadata false drops, true passes, unknown falls back to
    the document regex."""
    return F.when(has_item_meta.isNotNull(), has_item_meta).otherwise(has_item_101_v2(raw))


def liquidity_reason(cap: Column, avg_volume: Column, price: Column,
                     min_cap: float = MIN_MARKET_CAP, min_avg_volume: float = MIN_AVG_VOLUME,
                     min_dollar_volume: float = MIN_DOLLAR_VOLUME) -> Column:
    """the first failing rule, else ``OK``.  Equality passes; a null
    average volume fails; a null price counts as 0."""
    px = F.coalesce(F.when(truthy(price), price), F.lit(0.0))
    return (F.when(~truthy(cap), F.lit("no_cap"))
            .when(cap < F.lit(float(min_cap)), F.lit("low_cap"))
            .when(avg_volume.isNull() | (avg_volume < F.lit(float(min_avg_volume))), F.lit("low_volume"))
            .when(avg_volume * px < F.lit(float(min_dollar_volume)), F.lit("low_dollar_volume"))
            .otherwise(F.lit("OK")))


def liquidity_gate(df: DataFrame, **thresholds) -> DataFrame:
    return df.withColumn("liquidity", liquidity_reason(F.col("cap"), F.col("avg_volume"), F.col("price"),
                                                       **thresholds)).where(F.col("liquidity") == "OK")


def non_empty(df: DataFrame, col: str = "raw") -> DataFrame:
    """drop empty documents."""
    return df.where(F.length(F.coalesce(F.col(col), F.lit(""))) > 0)


def routed(df: DataFrame) -> DataFrame:
    """F8: drop low-impact rows (no priority)."""
    return df.where(F.col("priority").isNotNull())


def status_is(df: DataFrame, status: str) -> DataFrame:
    """F12."""
    return df.where(F.col("tracker_status") == F.lit(status))
