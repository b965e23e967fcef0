"""ST4 + ST5: the alert lifecycle and the session-close tracker job.

The reference keeps one mutable JSON document that both the scanner and the
tracker rewrite (alerts written in between are lost).  Here the scanner
appends to an ``alerts`` log and the tracker appends to an ``outcomes`` log;
status is derived on read (latest outcome per alert, else ``pending``), so
there is no shared mutation and a rerun is idempotent per (alert, as_of).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealflow.operators.bars import daily_bars
from dealflow.operators.ledger import latest_per_key
from dealflow.operators.outcomes import track_outcomes, with_session_date
from dealflow.operators.report import report_by_context, report_by_score, report_by_structure, report_totals
from dealflow.sources.readers import read_bars
from dealflow.sources.store import exists, replace_partitions


def alert_status(alerts: DataFrame, outcomes: DataFrame, key: str = "alert_id") -> DataFrame:
    """ST4: pending until an outcome exists; then the latest outcome's
    terminal status (``tracked`` or ``no_data``)."""
    last = latest_per_key(outcomes.select(key, "tracker_status", "as_of"), key, "as_of")
    return (alerts.join(last, key, "left")
            .withColumn("tracker_status", F.coalesce(F.col("tracker_status"), F.lit("pending"))))


def run_tracker(alerts: DataFrame, outcomes: DataFrame | None, bars: DataFrame, daily: DataFrame,
                as_of: dt.date, benchmark: str = "SPY", compat: bool = True) -> DataFrame:
    """ST5: measure pending alerts whose session ended by ``as_of``; returns
    the new outcome rows (the caller appends them to the outcomes log)."""
    a = with_session_date(alerts).where(F.col("session_date") <= F.lit(as_of))
    if outcomes is not None:
        a = a.join(outcomes.select("alert_id").distinct(), "alert_id", "left_anti")
    new = track_outcomes(a.drop("session_date"), bars, daily, benchmark, compat=compat)
    return new.withColumn("as_of", F.lit(as_of))


def weekly_report(outcomes: DataFrame, as_of: dt.date) -> dict[str, DataFrame] | None:
    """The Monday gate: the report runs when ``as_of`` is a Monday and, like
    the reference, aggregates all tracked history (not only the last week)."""
    if as_of.weekday() != 0:
        return None
    return {"totals": report_totals(outcomes), "by_structure": report_by_structure(outcomes),
            "by_score": report_by_score(outcomes), "by_context": report_by_context(outcomes)}


def track_step(spark: SparkSession, alerts: str, bars: str, outcomes: str, as_of: dt.date, benchmark: str = "SPY",
               compat: bool = True) -> None:
    """ST4 + ST5 + S10 over stored logs: measure what is pending by ``as_of`` and extend the outcome log.

    ``alerts`` and ``bars`` are folders that others append to (bars as ``write_bars`` leaves them).  An alert is
    pending until an earlier step has an outcome of it, so alerts and bars that land late are taken by the next
    step.  A step's outcomes are one partition of the log: run again with the same ``as_of`` it replaces its own
    rows, and steps one after the other leave what one step over everything would.
    """
    day = F.lit(as_of)
    waiting = with_session_date(spark.read.parquet(alerts)).where(F.col("session_date") <= day)
    if exists(spark, outcomes):
        earlier = spark.read.parquet(outcomes).where(F.col("as_of") < day)
        waiting = waiting.join(earlier.select("alert_id").distinct(), "alert_id", "left_anti")
    seen = read_bars(spark, bars).where(F.col("session_date") <= day)
    new = track_outcomes(waiting.drop("session_date"), seen, daily_bars(seen), benchmark, compat=compat)
    replace_partitions(new.withColumn("as_of", day), outcomes, "as_of")
