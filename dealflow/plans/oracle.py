"""DuckDB oracle SQL for every registered query.

Each query is one SQL string: fixture CTEs (the DuckDB twins of
``dealflow.plans.fixtures``) followed by the query.  Helpers below spell
the same arithmetic in the same order as the Spark columns.
"""

from __future__ import annotations

from dealflow.operators.outcomes import (BENCH_CLOSE_MINUTES, HORIZONS, RANGE_MINUTES,
                                         TARGET_PCT)
from dealflow.functions.timefns import SESSION_OPEN_MINUTE, SESSION_CLOSE_HOUR
from dealflow.plans.fixtures import FX_BENCHMARK

_SFX = {"t_15m": "15m", "t_30m": "30m", "t_1h": "1h", "t_2h": "2h", "t_4h": "4h"}


def pct_sql(p: str, b: str, dp: int = 2) -> str:
    return f"(CASE WHEN ({b}) <> 0 THEN round((({p}) - ({b})) / ({b}) * 100, {dp}) END)"


def weekday_sql(x: str) -> str:
    return f"(isodow({x}) - 1)"


def next_session_sql(ts: str) -> str:
    rolled = (f"(CASE WHEN hour({ts}) >= {SESSION_CLOSE_HOUR} OR {weekday_sql(ts)} >= 5 "
              f"THEN CAST({ts} AS DATE) + 1 ELSE CAST({ts} AS DATE) END)")
    return (f"(CASE WHEN {weekday_sql(rolled)} = 5 THEN {rolled} + 2 "
            f"WHEN {weekday_sql(rolled)} = 6 THEN {rolled} + 1 ELSE {rolled} END)")


def filing_context_sql(ts: str) -> str:
    mod = f"(hour({ts}) * 60 + minute({ts}))"
    return (f"(CASE WHEN {ts} IS NULL THEN 'unknown' WHEN {weekday_sql(ts)} >= 5 THEN 'weekend' "
            f"WHEN {mod} < {SESSION_OPEN_MINUTE} THEN 'pre-market' "
            f"WHEN {mod} < {SESSION_CLOSE_HOUR * 60} THEN 'market-hours' ELSE 'after-hours' END)")


# --------------------------------------------------------------------------
# events family CTEs
# --------------------------------------------------------------------------

BARS_FX = """
bars_fx AS (
  SELECT ticker, minute AS ts, arg_min(value, t) AS open, max(value) AS high,
         min(value) AS low, arg_max(value, t) AS close, CAST(sum(size) AS BIGINT) AS volume
  FROM (SELECT event_type AS ticker, date_trunc('minute', ts) AS minute, ts AS t,
               value, user_id + 1 AS size FROM events) e
  GROUP BY ticker, minute)"""

DAILY_FX = """
daily_fx AS (
  SELECT ticker, CAST(ts AS DATE) AS d, arg_min(open, ts) AS open, max(high) AS high,
         min(low) AS low, arg_max(close, ts) AS close, CAST(sum(volume) AS BIGINT) AS volume
  FROM bars_fx GROUP BY ticker, CAST(ts AS DATE))"""

ALERTS_FX = f"""
alerts_fx AS (
  SELECT event_id AS alert_id, event_type AS ticker, ts AS filing_ts, value AS price_at_filing,
         CASE WHEN event_id % 2 = 0 THEN 'bullish' ELSE 'neutral' END AS direction,
         CAST(event_id % 12 AS DOUBLE) AS groq_score,
         CASE event_id % 5 WHEN 0 THEN 'all-cash' WHEN 1 THEN 'all-stock' WHEN 2 THEN 'mixed'
              WHEN 3 THEN '' END AS deal_structure,
         event_type || '-' || strftime(ts, '%Y-%m-%d') AS id,
         {filing_context_sql('ts')} AS filing_context
  FROM events WHERE event_type <> '{FX_BENCHMARK}')"""


def _open_ts(d: str) -> str:
    return f"(CAST({d} AS TIMESTAMP) + INTERVAL {SESSION_OPEN_MINUTE} MINUTE)"


def session_stats_cte() -> str:
    w = lambda m: f"ts >= open_ts AND ts < open_ts + INTERVAL {m} MINUTE"
    cols = ["count(*) AS n_day_bars", "avg(volume) AS day_avg_volume",
            "arg_min(open, ts) FILTER (WHERE ts >= open_ts) AS price_open"]
    for label, m in HORIZONS:
        s = _SFX[label]
        cols += [f"count(*) FILTER (WHERE {w(m)}) AS n_{s}",
                 f"arg_max(close, ts) FILTER (WHERE {w(m)}) AS close_{s}",
                 f"max(high) FILTER (WHERE {w(m)}) AS high_{s}",
                 f"min(low) FILTER (WHERE {w(m)}) AS low_{s}",
                 f"sum(volume) FILTER (WHERE {w(m)}) AS vol_{s}"]
    r = w(RANGE_MINUTES)
    cols += [f"count(*) FILTER (WHERE {r}) AS n_range", f"max(high) FILTER (WHERE {r}) AS range_high",
             f"min(low) FILTER (WHERE {r}) AS range_low",
             f"arg_max(close, ts) FILTER (WHERE {r}) AS range_close"]
    return f"""
sb AS (SELECT ticker, ts, open, high, low, close, volume, CAST(ts AS DATE) AS session_date,
              {_open_ts('CAST(ts AS DATE)')} AS open_ts FROM bars_fx),
stats AS (SELECT ticker, session_date, {', '.join(cols)} FROM sb GROUP BY ticker, session_date),
bench AS (
  SELECT session_date, round(bo, 2) AS spy_open_price, {pct_sql('b4', 'bo')} AS spy_4h_pct
  FROM (SELECT session_date,
               arg_min(open, ts) FILTER (WHERE ts >= open_ts) AS bo,
               arg_min(close, ts) FILTER (WHERE ts >= open_ts + INTERVAL {BENCH_CLOSE_MINUTES} MINUTE) AS b4
        FROM sb WHERE ticker = '{FX_BENCHMARK}' GROUP BY session_date) x
  WHERE bo IS NOT NULL),
prevc AS (SELECT ticker, d AS session_date, open AS day_open,
                 lag(close) OVER (PARTITION BY ticker ORDER BY d) AS prev_close FROM daily_fx)"""


def outcomes_cte(compat: bool = True, target: float = TARGET_PCT) -> str:
    """Per-alert outcome columns, same names as ``track_outcomes``."""
    sel = ["a.*", "st.price_open",
           "CASE WHEN st.price_open IS NOT NULL THEN 'tracked' ELSE 'no_data' END AS tracker_status",
           "round(st.price_open, 4) AS price_at_open"]
    tracked = "st.price_open IS NOT NULL"
    vb = "(CASE WHEN st.day_avg_volume IS NOT NULL AND st.day_avg_volume <> 0 THEN st.day_avg_volume ELSE 1.0 END)"
    for label, m in HORIZONS:
        s = _SFX[label]
        ok = f"({tracked} AND st.n_{s} > 0 AND st.price_open <> 0)"
        sel += [f"CASE WHEN {ok} THEN {pct_sql(f'st.close_{s}', 'st.price_open')} END AS close_pct_{s}",
                f"CASE WHEN {ok} THEN {pct_sql(f'st.high_{s}', 'st.price_open')} END AS high_pct_{s}",
                f"CASE WHEN {ok} THEN {pct_sql(f'st.low_{s}', 'st.price_open')} END AS low_pct_{s}",
                f"CASE WHEN {ok} THEN round(st.vol_{s} / ({vb} * {float(m)}), 2) END AS volume_ratio_{s}"]
    rok = f"({tracked} AND st.n_range > 0 AND st.price_open > 0)"
    sel += [f"CASE WHEN {rok} THEN {pct_sql('st.range_high', 'st.price_open')} END AS range_high_pct",
            f"CASE WHEN {rok} THEN {pct_sql('st.range_low', 'st.price_open')} END AS range_low_pct",
            f"CASE WHEN {rok} THEN {pct_sql('st.range_close', 'st.price_open')} END AS close_4h_pct"]
    base = f"SELECT {', '.join(sel)} FROM alerts_s a LEFT JOIN stats st ON a.ticker = st.ticker AND a.session_date = st.session_date"

    def move(col, low_col=None):
        if compat:
            return f"(CASE WHEN direction = 'bullish' THEN {col} ELSE -{col} END)"
        return f"(CASE WHEN direction = 'bullish' THEN {col} WHEN direction = 'bearish' THEN -{low_col} END)"

    t_at, t_min, s_at = [], [], []
    for label, m in HORIZONS:
        s = _SFX[label]
        tm = move(f"high_pct_{s}", f"low_pct_{s}")
        cm = move(f"close_pct_{s}", f"close_pct_{s}")
        t_at.append(f"WHEN {tm} >= {target} THEN '{label}'")
        t_min.append(f"WHEN {tm} >= {target} THEN {m}")
        s_at.append(f"WHEN {cm} >= {target} THEN '{label}'")

    def dirc(s):
        if compat:
            return (f"CASE WHEN close_pct_{s} IS NULL THEN NULL WHEN direction = 'bullish' "
                    f"THEN close_pct_{s} > 0 ELSE close_pct_{s} < 0 END")
        return (f"CASE WHEN close_pct_{s} IS NULL THEN NULL WHEN direction = 'bullish' "
                f"THEN close_pct_{s} > 0 WHEN direction = 'bearish' THEN close_pct_{s} < 0 END")

    tr = "tracker_status = 'tracked'"
    sel2 = ["o1.*",
            f"CASE WHEN {tr} THEN CASE {' '.join(t_at)} END END AS first_touch_at",
            f"CASE WHEN {tr} THEN CAST(CASE {' '.join(t_min)} END AS INTEGER) END AS first_touch_minutes",
            f"CASE WHEN {tr} THEN CASE {' '.join(s_at)} END END AS sustained_at",
            f"({dirc('15m')}) AS direction_at_15m", f"({dirc('1h')}) AS direction_at_1h",
            f"({dirc('4h')}) AS direction_at_4h"]
    sel3 = ["o2.*",
            f"CASE WHEN {tr} THEN first_touch_at IS NOT NULL END AS target_touched",
            f"CASE WHEN {tr} THEN sustained_at IS NOT NULL END AS target_sustained",
            f"CASE WHEN {tr} AND b.spy_open_price IS NOT NULL THEN b.spy_open_price END AS spy_open_price",
            f"CASE WHEN {tr} AND b.spy_open_price IS NOT NULL THEN b.spy_4h_pct END AS spy_4h_pct",
            f"CASE WHEN {tr} AND b.spy_open_price IS NOT NULL THEN round(close_4h_pct - b.spy_4h_pct, 2) END AS alpha_4h"]
    avail = f"({tr} AND p.day_open IS NOT NULL AND p.prev_close IS NOT NULL AND p.prev_close <> 0)"
    sel4 = ["o3.*",
            f"CASE WHEN {tr} THEN {avail} END AS premarket_available",
            f"CASE WHEN {avail} THEN {pct_sql('p.day_open', 'p.prev_close')} END AS gap_from_prev_close_pct",
            f"CASE WHEN {avail} AND o3.price_at_filing IS NOT NULL AND o3.price_at_filing <> 0 "
            f"THEN {pct_sql('p.day_open', 'o3.price_at_filing')} END AS gap_from_filing_pct",
            f"CASE WHEN {avail} THEN round(p.prev_close, 4) END AS prev_close",
            f"CASE WHEN {avail} THEN round(p.day_open, 4) END AS open_price"]
    return f"""
alerts_s AS (SELECT *, {next_session_sql('filing_ts')} AS session_date FROM alerts_fx),
o1 AS ({base}),
o2 AS (SELECT {', '.join(sel2)} FROM o1),
o3 AS (SELECT {', '.join(sel3)} FROM o2 o2 LEFT JOIN bench b ON o2.session_date = b.session_date),
outcomes AS (SELECT {', '.join(sel4)} FROM o3 LEFT JOIN prevc p ON o3.ticker = p.ticker AND o3.session_date = p.session_date)"""


def with_outcomes(query: str, compat: bool = True) -> str:
    return ("WITH " + ",".join([BARS_FX, DAILY_FX, ALERTS_FX, session_stats_cte(), outcomes_cte(compat)])
            + "\n" + query)
