"""Event-study outcomes of alerts: J10-J14, A1-A8 (the tracker job).

Plan shape (scales with bars, not with alerts x bars):

1. ``session_date`` per alert (P11) and the distinct (ticker, session_date)
   keys the alerts need.
2. Bars are semi-joined to those keys (equi-join on ticker and UTC date;
   AQE turns it into a broadcast when the key set is small at run time,
   else a shuffle join) and aggregated once per (ticker, session_date)
   with conditional aggregates: the open, five cumulative windows, the
   241-minute range and the first bar after open+240.  These depend only on
   the session open, not on the alert, so many alerts on one session share
   one aggregate row.  Partial aggregation runs map-side.
3. Alerts are joined to the session aggregate on (ticker, session_date), to
   the benchmark's per-day aggregate (one row per date, broadcast) and to
   daily bars with the previous close (``lag`` per ticker).
4. Direction-dependent metrics (touch, sustain, direction accuracy) are
   plain column expressions per alert.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealflow.functions.numeric import pct, truthy, rnd
from dealflow.functions.timefns import (SESSION_OPEN_MINUTE, next_session_date,
                                        plus_minutes, session_open_ts)

# Fixed values (reference defaults): cumulative windows from the open, in
# minutes, with their labels; the 4-hour range window; the target move.
HORIZONS = (("t_15m", 15), ("t_30m", 30), ("t_1h", 60), ("t_2h", 120), ("t_4h", 240))
RANGE_MINUTES = 241
BENCH_CLOSE_MINUTES = 240
TARGET_PCT = 1.0
BENCHMARK_TICKER = "SPY"

_SUFFIX = {"t_15m": "15m", "t_30m": "30m", "t_1h": "1h", "t_2h": "2h", "t_4h": "4h"}


def _sfx(label: str) -> str:
    return _SUFFIX.get(label, label)


def with_session_date(alerts: DataFrame, ts_col: str = "filing_ts") -> DataFrame:
    return alerts.withColumn("session_date", next_session_date(F.col(ts_col)))


def session_aggregates(bars: DataFrame, keys: DataFrame | None = None,
                       horizons=HORIZONS, open_minute: int = SESSION_OPEN_MINUTE,
                       range_minutes: int = RANGE_MINUTES,
                       bench_close_minutes: int = BENCH_CLOSE_MINUTES) -> DataFrame:
    """One row per (ticker, session_date) with everything A1-A3 and J11-J13 need.

    ``keys`` (ticker, session_date) restricts the bars read to the sessions
    some alert needs; bars stored by ``session_date`` keep that column, so the
    keys prune the store's folders at run time.  Windows are ``[open, open + m)``.
    """
    date = F.col("session_date") if "session_date" in bars.columns else F.to_date("ts")
    b = bars.select("ticker", "ts", "open", "high", "low", "close", "volume", date.alias("session_date"))
    if keys is not None:
        b = b.join(keys, ["ticker", "session_date"], "left_semi")
    b = b.withColumn("_open_ts", session_open_ts(F.col("session_date"), open_minute))
    after_open = F.col("ts") >= F.col("_open_ts")

    def within(m: int):
        return after_open & (F.col("ts") < plus_minutes(F.col("_open_ts"), m))

    def when(cond, c):
        return F.when(cond, F.col(c))

    aggs = [F.count(F.lit(1)).alias("n_day_bars"),
            F.avg("volume").alias("day_avg_volume"),
            F.min_by(when(after_open, "open"), when(after_open, "ts")).alias("price_open")]
    for label, m in horizons:
        s = _sfx(label)
        w = within(m)
        aggs += [F.count(when(w, "ts")).alias(f"n_{s}"),
                 F.max_by(when(w, "close"), when(w, "ts")).alias(f"close_{s}"),
                 F.max(when(w, "high")).alias(f"high_{s}"),
                 F.min(when(w, "low")).alias(f"low_{s}"),
                 F.sum(when(w, "volume")).alias(f"vol_{s}")]
    r = within(range_minutes)
    aggs += [F.count(when(r, "ts")).alias("n_range"),
             F.max(when(r, "high")).alias("range_high"),
             F.min(when(r, "low")).alias("range_low"),
             F.max_by(when(r, "close"), when(r, "ts")).alias("range_close")]
    late = F.col("ts") >= plus_minutes(F.col("_open_ts"), bench_close_minutes)
    aggs += [F.min_by(when(late, "close"), when(late, "ts")).alias("first_close_after_4h")]
    return b.groupBy("ticker", "session_date").agg(*aggs)


def benchmark_context(bars: DataFrame, benchmark: str = BENCHMARK_TICKER,
                      open_minute: int = SESSION_OPEN_MINUTE,
                      bench_close_minutes: int = BENCH_CLOSE_MINUTES) -> DataFrame:
    """Benchmark open and 4-hour change per session date.

    One row per date, so its size is bounded by the calendar (about 250
    rows a year) and it is safe to broadcast."""
    b = bars.where(F.col("ticker") == F.lit(benchmark)).select(
        "ts", "open", "close", F.to_date("ts").alias("session_date"))
    b = b.withColumn("_open_ts", session_open_ts(F.col("session_date"), open_minute))
    after_open = F.col("ts") >= F.col("_open_ts")
    late = F.col("ts") >= plus_minutes(F.col("_open_ts"), bench_close_minutes)
    agg = b.groupBy("session_date").agg(
        F.min_by(F.when(after_open, F.col("open")), F.when(after_open, F.col("ts"))).alias("_bo"),
        F.min_by(F.when(late, F.col("close")), F.when(late, F.col("ts"))).alias("_b4"))
    return agg.where(F.col("_bo").isNotNull()).select(
        "session_date",
        rnd("_bo", 2).alias("spy_open_price"),
        pct(F.col("_b4"), F.col("_bo")).alias("spy_4h_pct"))


def previous_close(daily: DataFrame) -> DataFrame:
    """J14 input: daily open with the previous session's close (``lag``).

    The window is partitioned by ticker over one row per day, so a ticker's
    partition holds one row per trading day however many bars it has."""
    w = Window.partitionBy("ticker").orderBy("d")
    return daily.select("ticker", F.col("d").alias("session_date"), F.col("open").alias("day_open"),
                        F.lag("close").over(w).alias("prev_close"))


def track_outcomes(alerts: DataFrame, bars: DataFrame, daily: DataFrame | None = None,
                   benchmark: str | DataFrame | None = BENCHMARK_TICKER,
                   horizons=HORIZONS, target_pct: float = TARGET_PCT,
                   compat: bool = True, open_minute: int = SESSION_OPEN_MINUTE) -> DataFrame:
    """Measure every alert against its session's minute bars.

    ``alerts`` needs ``alert_id, ticker, filing_ts, direction`` and may carry
    ``price_at_filing``; other columns pass through.  ``compat=True`` keeps the
    reference's touch rule (high for every direction, non-bullish negated);
    ``compat=False`` uses the low for bearish and leaves neutral unmeasured.
    """
    a = with_session_date(alerts)
    keys = a.select("ticker", "session_date").where(F.col("ticker").isNotNull()).distinct()
    stats = session_aggregates(bars, keys, horizons, open_minute)
    o = a.join(stats, ["ticker", "session_date"], "left")

    po = F.col("price_open")
    tracked = po.isNotNull()
    o = o.withColumn("tracker_status", F.when(tracked, F.lit("tracked")).otherwise(F.lit("no_data")))
    o = o.withColumn("price_at_open", rnd(po, 4))
    vol_base = F.when(truthy(F.col("day_avg_volume")), F.col("day_avg_volume")).otherwise(F.lit(1.0))
    for label, m in horizons:
        s = _sfx(label)
        ok = tracked & (F.col(f"n_{s}") > 0) & (po != 0)
        o = (o.withColumn(f"close_pct_{s}", F.when(ok, pct(F.col(f"close_{s}"), po)))
              .withColumn(f"high_pct_{s}", F.when(ok, pct(F.col(f"high_{s}"), po)))
              .withColumn(f"low_pct_{s}", F.when(ok, pct(F.col(f"low_{s}"), po)))
              .withColumn(f"volume_ratio_{s}",
                          F.when(ok, rnd(F.col(f"vol_{s}") / (vol_base * F.lit(float(m))), 2))))
    rok = tracked & (F.col("n_range") > 0) & (po > 0)
    o = (o.withColumn("range_high_pct", F.when(rok, pct(F.col("range_high"), po)))
          .withColumn("range_low_pct", F.when(rok, pct(F.col("range_low"), po)))
          .withColumn("close_4h_pct", F.when(rok, pct(F.col("range_close"), po))))

    bullish = F.col("direction") == F.lit("bullish")
    bearish = F.col("direction") == F.lit("bearish")

    def touch_move(s):
        if compat:
            return F.when(bullish, F.col(f"high_pct_{s}")).otherwise(-F.col(f"high_pct_{s}"))
        return F.when(bullish, F.col(f"high_pct_{s}")).when(bearish, -F.col(f"low_pct_{s}"))

    def close_move(s):
        if compat:
            return F.when(bullish, F.col(f"close_pct_{s}")).otherwise(-F.col(f"close_pct_{s}"))
        return F.when(bullish, F.col(f"close_pct_{s}")).when(bearish, -F.col(f"close_pct_{s}"))

    touch_at = F.lit(None).cast("string")
    touch_min = F.lit(None).cast("int")
    sust_at = F.lit(None).cast("string")
    for label, m in reversed(horizons):
        s = _sfx(label)
        t = F.coalesce(touch_move(s) >= F.lit(target_pct), F.lit(False))
        c = F.coalesce(close_move(s) >= F.lit(target_pct), F.lit(False))
        touch_at = F.when(t, F.lit(label)).otherwise(touch_at)
        touch_min = F.when(t, F.lit(m)).otherwise(touch_min)
        sust_at = F.when(c, F.lit(label)).otherwise(sust_at)
    o = (o.withColumn("first_touch_at", F.when(tracked, touch_at))
          .withColumn("first_touch_minutes", F.when(tracked, touch_min))
          .withColumn("sustained_at", F.when(tracked, sust_at))
          .withColumn("target_touched", F.when(tracked, F.col("first_touch_at").isNotNull()))
          .withColumn("target_sustained", F.when(tracked, F.col("sustained_at").isNotNull())))

    def dir_correct(s):
        c = F.col(f"close_pct_{s}")
        if compat:
            return F.when(c.isNull(), F.lit(None).cast("boolean")).when(bullish, c > 0).otherwise(c < 0)
        return F.when(c.isNull(), F.lit(None).cast("boolean")).when(bullish, c > 0).when(bearish, c < 0)

    for s in ("15m", "1h", "4h"):
        if any(_sfx(lbl) == s for lbl, _ in horizons):
            o = o.withColumn(f"direction_at_{s}", dir_correct(s))

    # Benchmark context, one row per date -> broadcast is bounded.
    if benchmark is not None:
        bench = benchmark if isinstance(benchmark, DataFrame) else benchmark_context(bars, benchmark,
                                                                                     open_minute)
        o = o.join(F.broadcast(bench), ["session_date"], "left")
        has_spy = tracked & F.col("spy_open_price").isNotNull()
        o = (o.withColumn("spy_open_price", F.when(has_spy, F.col("spy_open_price")))
              .withColumn("spy_4h_pct", F.when(has_spy, F.col("spy_4h_pct")))
              .withColumn("alpha_4h", F.when(has_spy, rnd(F.col("close_4h_pct") - F.col("spy_4h_pct"), 2))))

    # Gap from the previous close and from the filing price.
    if daily is not None:
        pc = previous_close(daily)
        o = o.join(pc, ["ticker", "session_date"], "left")
        avail = tracked & F.col("day_open").isNotNull() & truthy(F.col("prev_close"))
        pf = F.col("price_at_filing") if "price_at_filing" in alerts.columns else F.lit(None).cast("double")
        o = (o.withColumn("premarket_available", F.when(tracked, avail))
              .withColumn("gap_from_prev_close_pct", F.when(avail, pct(F.col("day_open"), F.col("prev_close"))))
              .withColumn("gap_from_filing_pct", F.when(avail & truthy(pf), pct(F.col("day_open"), pf)))
              .withColumn("prev_close", F.when(avail, rnd("prev_close", 4)))
              .withColumn("open_price", F.when(avail, rnd("day_open", 4))))
    return o
