"""Registered queries: tracker outcomes and reports (events family)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealflow.functions.numeric import rnd

from dealflow.operators import outcomes as oc
from dealflow.operators.bars import daily_bars
from dealflow.operators import report as rp
from dealflow.plans import fixtures as fx
from dealflow.plans import oracle as osql
from dealflow.plans.registry import register

_SFX = [s for s in ("15m", "30m", "1h", "2h", "4h")]


def outcomes_fx(spark: SparkSession, sf_dir: str, compat: bool = True) -> DataFrame:
    """Every fixture alert measured against the fixture bars (reference rules)."""
    bars = fx.bars_fx(spark, sf_dir)
    return oc.track_outcomes(fx.alerts_fx(spark, sf_dir), bars, daily=daily_bars(bars),
                             benchmark=fx.FX_BENCHMARK, compat=compat)


def _sd(c="session_date"):
    return F.col(c).cast("string").alias(c)


# ---- flagship -------------------------------------------------------------

@register("outcome_by_structure", lambda: osql.with_outcomes("""
SELECT coalesce(nullif(deal_structure, ''), 'unknown') AS deal_structure,
       count(*) AS total, count(*) FILTER (WHERE target_sustained) AS sustained
FROM outcomes WHERE tracker_status = 'tracked' GROUP BY 1 ORDER BY 1"""))
def outcome_by_structure(spark, sf_dir):
    return rp.report_by_structure(outcomes_fx(spark, sf_dir))


# ---- session-level snapshots (alert-independent) --------------------------

def _snap_sql_cols():
    cols = []
    for s in _SFX:
        ok = f"(n_{s} > 0 AND price_open <> 0)"
        vb = "(CASE WHEN day_avg_volume <> 0 THEN day_avg_volume ELSE 1.0 END)"
        m = {"15m": 15, "30m": 30, "1h": 60, "2h": 120, "4h": 240}[s]
        cols += [f"CASE WHEN {ok} THEN {osql.pct_sql(f'close_{s}', 'price_open')} END AS close_pct_{s}",
                 f"CASE WHEN {ok} THEN {osql.pct_sql(f'high_{s}', 'price_open')} END AS high_pct_{s}",
                 f"CASE WHEN {ok} THEN {osql.pct_sql(f'low_{s}', 'price_open')} END AS low_pct_{s}",
                 f"CASE WHEN {ok} THEN round(vol_{s} / ({vb} * {float(m)}), 2) END AS volume_ratio_{s}"]
    return cols


def _ohlc_sql():
    return ("WITH " + ",".join([osql.BARS_FX, osql.DAILY_FX, osql.session_stats_cte()]) + f"""
SELECT ticker, CAST(session_date AS VARCHAR) AS session_date, round(price_open, 4) AS price_at_open,
       {', '.join(_snap_sql_cols())}
FROM stats WHERE price_open IS NOT NULL""")


@register("ohlc_snapshots", _ohlc_sql)
def ohlc_snapshots(spark, sf_dir):
    """A1 + A2 for every (ticker, session) that has an open bar."""
    st = oc.session_aggregates(fx.bars_fx(spark, sf_dir)).where(F.col("price_open").isNotNull())
    po = F.col("price_open")
    vb = F.when((F.col("day_avg_volume") != 0), F.col("day_avg_volume")).otherwise(F.lit(1.0))
    cols = [F.col("ticker"), _sd(), rnd(po, 4).alias("price_at_open")]
    for (label, m) in oc.HORIZONS:
        s = oc._sfx(label)
        ok = (F.col(f"n_{s}") > 0) & (po != 0)
        cols += [F.when(ok, oc.pct(F.col(f"close_{s}"), po)).alias(f"close_pct_{s}"),
                 F.when(ok, oc.pct(F.col(f"high_{s}"), po)).alias(f"high_pct_{s}"),
                 F.when(ok, oc.pct(F.col(f"low_{s}"), po)).alias(f"low_pct_{s}"),
                 F.when(ok, rnd(F.col(f"vol_{s}") / (vb * F.lit(float(m))), 2)).alias(f"volume_ratio_{s}")]
    return st.select(*cols)


def _range_sql():
    ok = "n_range > 0 AND price_open > 0"
    return ("WITH " + ",".join([osql.BARS_FX, osql.DAILY_FX, osql.session_stats_cte()]) + f"""
, fca AS (SELECT ticker, session_date,
                 arg_min(close, ts) FILTER (WHERE ts >= open_ts + INTERVAL 240 MINUTE) AS fca
          FROM sb GROUP BY ticker, session_date)
SELECT s.ticker, CAST(s.session_date AS VARCHAR) AS session_date, round(price_open, 4) AS price_at_open,
       CASE WHEN {ok} THEN {osql.pct_sql('range_high', 'price_open')} END AS range_high_pct,
       CASE WHEN {ok} THEN {osql.pct_sql('range_low', 'price_open')} END AS range_low_pct,
       CASE WHEN {ok} THEN {osql.pct_sql('range_close', 'price_open')} END AS close_4h_pct,
       {osql.pct_sql('fca', 'price_open')} AS first_close_after_4h_pct
FROM stats s JOIN fca f ON s.ticker = f.ticker AND s.session_date = f.session_date
WHERE price_open IS NOT NULL""")


@register("range_4h", _range_sql)
def range_4h(spark, sf_dir):
    """A3 with both as-of readings: last close before open+241 (J12) and first
    close at or after open+240 (J11)."""
    st = oc.session_aggregates(fx.bars_fx(spark, sf_dir)).where(F.col("price_open").isNotNull())
    po = F.col("price_open")
    ok = (F.col("n_range") > 0) & (po > 0)
    return st.select("ticker", _sd(), rnd(po, 4).alias("price_at_open"),
                     F.when(ok, oc.pct(F.col("range_high"), po)).alias("range_high_pct"),
                     F.when(ok, oc.pct(F.col("range_low"), po)).alias("range_low_pct"),
                     F.when(ok, oc.pct(F.col("range_close"), po)).alias("close_4h_pct"),
                     oc.pct(F.col("first_close_after_4h"), po).alias("first_close_after_4h_pct"))


# ---- per-alert outcomes ----------------------------------------------------

_TOUCH_COLS = ["alert_id", "ticker", "session_date", "direction", "tracker_status",
               "first_touch_at", "first_touch_minutes", "target_touched"]
_SUST_COLS = ["alert_id", "ticker", "session_date", "direction", "tracker_status",
              "sustained_at", "target_sustained", "close_pct_15m", "close_pct_30m", "close_pct_1h",
              "close_pct_2h", "close_pct_4h"]
_DIR_COLS = ["alert_id", "direction", "tracker_status", "direction_at_15m", "direction_at_1h",
             "direction_at_4h"]
_ALPHA_COLS = ["alert_id", "ticker", "session_date", "close_4h_pct", "spy_open_price", "spy_4h_pct",
               "alpha_4h"]
_GAP_COLS = ["alert_id", "ticker", "session_date", "price_at_filing", "premarket_available",
             "prev_close", "open_price", "gap_from_prev_close_pct", "gap_from_filing_pct"]


def _alert_sql(cols):
    out = [("CAST(session_date AS VARCHAR) AS session_date" if c == "session_date" else c) for c in cols]
    return lambda: osql.with_outcomes(f"SELECT {', '.join(out)} FROM outcomes")


def _alert_query(cols):
    def q(spark, sf_dir):
        o = outcomes_fx(spark, sf_dir)
        return o.select(*[(_sd() if c == "session_date" else F.col(c)) for c in cols])
    return q


register("target_touch", _alert_sql(_TOUCH_COLS))(_alert_query(_TOUCH_COLS))
register("target_sustained", _alert_sql(_SUST_COLS))(_alert_query(_SUST_COLS))
register("direction_accuracy", _alert_sql(_DIR_COLS))(_alert_query(_DIR_COLS))
register("alpha_vs_benchmark", _alert_sql(_ALPHA_COLS))(_alert_query(_ALPHA_COLS))
register("premarket_gap", _alert_sql(_GAP_COLS))(_alert_query(_GAP_COLS))


# ---- reports ---------------------------------------------------------------

@register("report_totals", lambda: osql.with_outcomes("""
SELECT * FROM (
  SELECT count(*) AS total,
         count(*) FILTER (WHERE direction_at_1h) AS n_dir_1h,
         CAST(round_even(count(*) FILTER (WHERE direction_at_1h) / count(*) * 100.0, 0) AS INTEGER) AS pct_dir_1h,
         count(*) FILTER (WHERE direction_at_4h) AS n_dir_4h,
         CAST(round_even(count(*) FILTER (WHERE direction_at_4h) / count(*) * 100.0, 0) AS INTEGER) AS pct_dir_4h,
         count(*) FILTER (WHERE target_touched) AS n_touched,
         CAST(round_even(count(*) FILTER (WHERE target_touched) / count(*) * 100.0, 0) AS INTEGER) AS pct_touched,
         count(*) FILTER (WHERE target_sustained) AS n_sustained,
         CAST(round_even(count(*) FILTER (WHERE target_sustained) / count(*) * 100.0, 0) AS INTEGER) AS pct_sustained,
         round(avg(range_high_pct), 2) AS avg_range_high,
         round(avg(range_low_pct), 2) AS avg_range_low,
         round(avg(alpha_4h), 2) AS avg_alpha,
         CAST(round_even(avg(CASE WHEN first_touch_minutes <> 0 THEN first_touch_minutes END), 0) AS INTEGER) AS avg_touch_minutes
  FROM outcomes WHERE tracker_status = 'tracked') t
WHERE total >= 2"""))
def report_totals(spark, sf_dir):
    return rp.report_totals(outcomes_fx(spark, sf_dir))


@register("report_by_score", lambda: osql.with_outcomes("""
SELECT score_bucket, count(*) AS total, count(*) FILTER (WHERE target_sustained) AS sustained
FROM (SELECT CASE WHEN coalesce(groq_score, 0) BETWEEN 9 AND 10 THEN '9-10 MEGA/MAJOR'
                  WHEN coalesce(groq_score, 0) BETWEEN 7 AND 8 THEN '7-8 MAJOR'
                  WHEN coalesce(groq_score, 0) BETWEEN 5 AND 6 THEN '5-6 STANDARD' END AS score_bucket,
             target_sustained
      FROM outcomes WHERE tracker_status = 'tracked') x
WHERE score_bucket IS NOT NULL GROUP BY score_bucket"""))
def report_by_score(spark, sf_dir):
    return rp.report_by_score(outcomes_fx(spark, sf_dir))


@register("report_by_context", lambda: osql.with_outcomes("""
SELECT filing_context, count(*) AS total, count(*) FILTER (WHERE target_sustained) AS sustained
FROM outcomes WHERE tracker_status = 'tracked'
  AND filing_context IN ('pre-market', 'market-hours', 'after-hours')
GROUP BY filing_context"""))
def report_by_context(spark, sf_dir):
    return rp.report_by_context(outcomes_fx(spark, sf_dir))


_PART = "SELECT {name} AS name, count(*) AS total, count(*) FILTER (WHERE target_sustained) AS sustained FROM t GROUP BY 1"


def _lines_sql(name: str) -> str:
    return (f"(SELECT array_to_string(list_sort(list(name || ' ' || CAST(sustained AS VARCHAR) || '/' || CAST(total AS VARCHAR))), '; ') "
            f"FROM ({_PART.format(name=name)}) x WHERE name IS NOT NULL)")


@register("report_summary", lambda: osql.with_outcomes(f"""
, t AS (SELECT * FROM outcomes WHERE tracker_status = 'tracked')
SELECT * FROM (
  SELECT count(*) AS total, count(*) FILTER (WHERE target_sustained) AS sustained,
         {_lines_sql("coalesce(nullif(deal_structure, ''), 'unknown')")} AS by_structure,
         {_lines_sql("CASE WHEN coalesce(groq_score, 0) BETWEEN 9 AND 10 THEN '9-10 MEGA/MAJOR' WHEN coalesce(groq_score, 0) BETWEEN 7 AND 8 THEN '7-8 MAJOR' WHEN coalesce(groq_score, 0) BETWEEN 5 AND 6 THEN '5-6 STANDARD' END")} AS by_score,
         {_lines_sql("CASE WHEN filing_context IN ('pre-market', 'market-hours', 'after-hours') THEN filing_context END")} AS by_context
  FROM t) s WHERE total >= 2"""))
def report_summary(spark, sf_dir):
    """The combined report, one row."""
    return rp.report_summary(outcomes_fx(spark, sf_dir))
