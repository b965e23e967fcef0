"""Registered queries that start from landed files and stored tables: the fixture views are written to a fresh
folder in the form that the sources deliver, and read back through the readers.

Each oracle says what the same work gives on the views themselves, so a lost, doubled or misread row shows.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealflow.functions import identifiers as ids
from dealflow.functions import timefns as tf
from dealflow.functions.exchange import Exchange, us_holidays
from dealflow.operators import enrich, gates, history_store, ledger, route
from dealflow.operators import outcomes as oc
from dealflow.operators.asof import asof_join
from dealflow.plans import fixtures as fx
from dealflow.plans import fx_filings as fxf
from dealflow.plans import oracle as osql
from dealflow.plans import ox_ids as oi
from dealflow.plans.q_filings import (FEED_SQL, HIST_COLS, META_SQL, feed_ids, merged_feed, routed_frame, sql)
from dealflow.plans.registry import ORACLES, register
from dealflow.sources import readers as R
from dealflow.streaming import ledger_stream as LS
from dealflow.streaming import streams as S
from dealflow.streaming import tracker_job as TJ


def folder(spark: SparkSession, name: str, *parts: str) -> list[str]:
    """Fresh paths under the shared folder."""
    top = S.stream_workspace(spark, name)
    return [os.path.join(top, p) for p in parts]


# ---- S1 + S2: XML feeds ---------------------------------------------------------

BROKEN = 97                                    # an entry in so many has an open title

XML_SQL = f"""
WITH_ids AS (SELECT *, {oi.acc_v2_sql('link', 'entry_id')} AS accession FROM feed_entries_fx WHERE k % {BROKEN} <> 0)"""


@register("xml_intake", lambda: sql(XML_SQL.replace("WITH_ids", "landed"), query=f"""
SELECT accession, arg_min(title, feed_rank) AS title, arg_min(link, feed_rank) AS link, arg_min(feed, feed_rank) AS feed,
       arg_min(published_raw, feed_rank) AS published_raw, count(*) AS n_entries,
       (SELECT count(*) FROM feed_entries_fx WHERE k % {BROKEN} = 0) AS n_broken
FROM landed WHERE accession IS NOT NULL GROUP BY accession"""))
def xml_intake(spark, sf_dir):
    """S1 + S2 + W2: both feeds as XML files, some entries malformed; the first entry of each accession in file order,
    and how many entries could not be read.  A file is read in blocks, so the order rests on the block ranks."""
    entries = fxf.feed_entries_fx(spark, sf_dir)
    paths = dict(zip(("primary", "backup"), folder(spark, "xml", "primary", "backup")))
    for feed, path in paths.items():
        some = entries.where(F.col("feed") == feed).repartitionByRange("feed_rank").sortWithinPartitions("feed_rank")
        some.select(R.render_entry(F.col("k") % BROKEN == 0)).write.text(path)
    # all primary entries rank before the backup's
    read = R.read_feed(spark, paths["primary"], "primary").unionByName(
        R.read_feed(spark, paths["backup"], "backup").withColumn("feed_rank", F.col("feed_rank") + (1 << 62)))
    table, = folder(spark, "xml", "table")
    read.write.parquet(table)                  # parsed once; Spark answers no query on the corrupt column alone
    read = spark.read.schema(read.schema).parquet(table)
    good = read.where(F.col("_corrupt_record").isNull())
    kept = good.withColumn("accession", ids.accession_v2(F.col("link"), F.col("entry_id")))
    kept = ledger.drop_without(kept).groupBy("accession").agg(
        F.min_by(F.struct("title", "link", "feed", "published_raw"), "feed_rank").alias("r"), F.count(F.lit(1)).alias("n_entries"))
    broken = read.select(F.count(F.when(F.col("_corrupt_record").isNotNull(), 1)).alias("n")).scalar()
    return kept.select("accession", "r.title", "r.link", "r.feed", F.coalesce("r.published_raw", F.lit("")).alias("published_raw"),
                       "n_entries", broken.alias("n_broken"))


# ---- S4 + S5: JSON issuer map and submissions --------------------------------------

PART = 1000                                    # entries of a landed map, filings of a landed submissions page


def land_issuer_map(issuers: DataFrame, path: str) -> None:
    """``{"0": {..}, ..}`` documents of at most ``PART`` issuers, one a line."""
    entry = F.struct(F.col("ordinal").cast("string"), F.struct("cik_str", "ticker", "title"))
    docs = issuers.groupBy(F.expr(f"ordinal DIV {PART}").alias("part")).agg(F.map_from_entries(F.collect_list(entry)).alias("m"))
    docs.select(F.to_json("m")).write.text(path)


def land_submissions(filings: DataFrame, tickers: DataFrame, path: str) -> None:
    """A document for each issuer and page of at most ``PART`` filings, with parallel arrays, one a line."""
    pages = (filings.groupBy("cik", F.expr(f"cast(right(accession, 6) as int) DIV {PART}").alias("page"))
             .agg(F.sort_array(F.collect_list(F.struct("accession", "items"))).alias("f")))
    docs = tickers.join(pages, "cik", "left").select(
        "cik", F.array_compact(F.array(F.lower("first_ticker"))).alias("tickers"),
        F.struct(F.struct(F.coalesce(F.col("f.accession"), F.array()).alias("accessionNumber"),
                          F.coalesce(F.col("f.items"), F.array()).alias("items")).alias("recent")).alias("filings"))
    docs.select(F.to_json(F.struct("cik", "tickers", "filings"))).write.text(path)


@register("json_intake", lambda: sql(FEED_SQL, META_SQL, """
dim AS (SELECT CAST(cik_str AS VARCHAR) AS cik, upper(arg_min(ticker, ordinal)) AS issuer_ticker
        FROM issuers_fx WHERE ticker IS NOT NULL AND ticker <> '' GROUP BY 1)""", query=f"""
SELECT m.k, m.feed, m.cik, m.accession, m.meta_ticker, m.meta_items, m.has_item_101, d.issuer_ticker
FROM meta2 m LEFT JOIN dim d ON {oi.cik_strip_sql('m.cik')} = d.cik"""))
def json_intake(spark, sf_dir):
    """S4 + S5 + J3 + J4: issuer map and submissions landed as JSON, joined to the merged feed."""
    map_path, sub_path = folder(spark, "json", "issuers", "submissions")
    land_issuer_map(fxf.issuers_fx(spark, sf_dir), map_path)
    land_submissions(fxf.submissions_fx(spark, sf_dir), fxf.sub_tickers_fx(spark, sf_dir), sub_path)
    filings, tickers = R.read_submissions(spark, sub_path, lines=True)
    m = enrich.item_metadata(merged_feed(spark, sf_dir), filings, tickers)
    m = enrich.lookup_issuer(m, R.read_issuer_map(spark, map_path, lines=True), by="feed_rank")
    return m.select("k", "feed", "cik", "accession", "meta_ticker", "meta_items", "has_item_101", "issuer_ticker")


# ---- S7 + S8 + J10: stored bars ------------------------------------------------------

FIRST, LAST = dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 12)

STORE_COLS = ["alert_id", "session_date", "tracker_status", "price_at_open", "close_pct_1h", "high_pct_4h", "close_4h_pct",
              "alpha_4h", "gap_from_prev_close_pct"]


def stored_outcomes(spark: SparkSession, sf_dir: str, bars: str, daily: str) -> DataFrame:
    """Outcomes of three days' alerts from stored bars, whose date folders the alerts prune."""
    some = fx.alerts_fx(spark, sf_dir).where((F.col("filing_ts") >= F.lit(FIRST)) & (F.col("filing_ts") < F.lit(LAST)))
    return oc.track_outcomes(some, R.read_bars(spark, bars), R.read_daily_bars(spark, daily), fx.FX_BENCHMARK)


def land_bars(spark: SparkSession, sf_dir: str) -> list[str]:
    bars, daily = folder(spark, "bars", "minute", "daily")
    R.write_bars(fx.bars_fx(spark, sf_dir), bars)
    fx.daily_fx(spark, sf_dir).write.parquet(daily)
    return [bars, daily]


@register("bar_store", lambda: osql.with_outcomes(f"""
SELECT alert_id, CAST(session_date AS VARCHAR) AS session_date, {', '.join(STORE_COLS[2:])}
FROM outcomes WHERE filing_ts >= TIMESTAMP '{FIRST}' AND filing_ts < TIMESTAMP '{LAST}'"""))
def bar_store(spark, sf_dir):
    """S7 + S8 + J10: bars written by date, read for the dates that some alerts need."""
    o = stored_outcomes(spark, sf_dir, *land_bars(spark, sf_dir))
    return o.select("alert_id", F.col("session_date").cast("string").alias("session_date"), *STORE_COLS[2:])


# ---- ST4 + ST5 + S10: tracker steps ----------------------------------------------------

STEPS = (dt.date(2024, 1, 12), dt.date(2024, 1, 22), dt.date(2024, 12, 31))

TRACK_COLS = ["tracker_status", "price_at_open", "close_pct_15m", "close_4h_pct", "alpha_4h", "first_touch_at",
              "target_sustained", "gap_from_prev_close_pct"]


@register("tracker_steps", lambda: osql.with_outcomes(f"""
SELECT alert_id, CAST(session_date AS VARCHAR) AS session_date,
       CASE WHEN session_date <= DATE '{STEPS[0]}' AND filing_ts < TIMESTAMP '{STEPS[0]}' THEN '{STEPS[0]}'
            WHEN session_date <= DATE '{STEPS[1]}' AND filing_ts < TIMESTAMP '{STEPS[1]}' THEN '{STEPS[1]}'
            ELSE '{STEPS[2]}' END AS as_of, {', '.join(TRACK_COLS)}
FROM outcomes WHERE session_date <= DATE '{STEPS[2]}'"""))
def tracker_steps(spark, sf_dir):
    """ST4 + ST5 + S10: alerts and bars land in three parts, the tracker runs after each (twice after the first), and
    the outcome log holds what one run over everything gives, each outcome under the step that found it.

    An alert filed on the day of a step lands after it, so the next step measures it."""
    alerts, bars, outcomes = folder(spark, "tracker", "alerts", "bars", "outcomes")
    all_alerts, all_bars = fx.alerts_fx(spark, sf_dir), fx.bars_fx(spark, sf_dir)
    midnight = lambda d: F.lit(d).cast("timestamp_ntz")
    before = None
    for day in STEPS:
        # a step runs at the end of its day: the day's bars are there, alerts filed on it land with the next part
        after = dt.timedelta(1)
        new_alerts, new_bars = F.col("filing_ts") < midnight(day), F.col("ts") < midnight(day + after)
        if before:
            new_alerts &= F.col("filing_ts") >= midnight(before)
            new_bars &= F.col("ts") >= midnight(before + after)
        R.append_log(all_alerts.where(new_alerts), alerts)
        R.write_bars(all_bars.where(new_bars), bars)
        for _ in range(1 if before else 2):
            TJ.track_step(spark, alerts, bars, outcomes, day, fx.FX_BENCHMARK)
        before = day
    log = spark.read.parquet(outcomes)
    return log.select("alert_id", F.col("session_date").cast("string").alias("session_date"),
                      F.col("as_of").cast("string").alias("as_of"), *TRACK_COLS)


# ---- J1 + S9 on a stream ----------------------------------------------------------------

@register("ledger_stream", lambda: sql(FEED_SQL, query="""
SELECT accession, arg_min(k, feed_rank) AS k, arg_min(feed, feed_rank) AS feed, min(feed_rank) AS feed_rank,
       CAST(CASE WHEN arg_min(feed, feed_rank) = 'backup' THEN 2 ELSE arg_min(k, feed_rank) % 2 END AS BIGINT) AS batch_id
FROM merged WHERE accession IS NOT NULL AND accession NOT IN (SELECT accession FROM ledger_fx)
GROUP BY accession"""))
def ledger_stream(spark, sf_dir):
    """J1 + S9 + W2 on a stream: the feed lands in three parts, the middle batch is delivered twice, and the ledger
    gains each new accession once, under the batch that brought it."""
    landed, book, checkpoint = folder(spark, "ledger", "feed", "ledger", "checkpoint")
    rows = feed_ids(spark, sf_dir).select("accession", "k", "feed", "feed_rank")
    known = fxf.ledger_fx(spark, sf_dir).select("accession", *(F.lit(None).cast(t).alias(c) for c, t in rows.dtypes[1:]))
    LS.seed_ledger(known, book)
    part = F.when(F.col("feed") == "backup", 2).otherwise(F.col("k") % 2)
    for i in range(3):
        some = rows.where(part == i)
        some.write.mode("append").parquet(landed)
        LS.run_ledger_stream(S.file_stream(spark, landed, rows.schema), book, checkpoint)
        if i == 1:
            LS.ledger_sink(book)(some, 1)
    return LS.read_stream_ledger(spark, book, rows.schema).where(F.col(LS.BATCH) >= 0)


# ---- J11 + J12 at any time ----------------------------------------------------------------

GAP_MINUTES = 120


@register("price_at_alert", lambda: "WITH " + ",".join([osql.BARS_FX, osql.ALERTS_FX]) + f"""
, b AS (SELECT a.alert_id, a.ticker, a.filing_ts, p.ts AS t, p.close AS c
        FROM alerts_fx a ASOF LEFT JOIN bars_fx p ON a.ticker = p.ticker AND a.filing_ts >= p.ts),
f AS (SELECT a.alert_id, p.ts AS t, p.open AS o
      FROM alerts_fx a ASOF LEFT JOIN bars_fx p ON a.ticker = p.ticker AND a.filing_ts <= p.ts)
SELECT b.alert_id, b.ticker, CASE WHEN b.t >= b.filing_ts - INTERVAL {GAP_MINUTES} MINUTE THEN b.c END AS last_close,
       strftime(b.t, '%Y-%m-%d %H:%M:%S') AS last_ts, f.o AS next_open, strftime(f.t, '%Y-%m-%d %H:%M:%S') AS next_ts
FROM b JOIN f ON f.alert_id = b.alert_id""")
def price_at_alert(spark, sf_dir):
    """J11 + J12 at the alert's own time: the last bar before it (its close if not too old) and the first after."""
    a = fx.alerts_fx(spark, sf_dir).select("alert_id", "ticker", "filing_ts")
    bars = fx.bars_fx(spark, sf_dir).select("ticker", "ts", "open", "close")
    out = asof_join(a, bars, "ticker", "filing_ts", "ts", ["close"], prefix="last_", by="alert_id")
    out = asof_join(out, bars, "ticker", "filing_ts", "ts", ["open"], "forward", prefix="next_", by="alert_id")
    fresh = F.col("last_ts") >= F.col("filing_ts") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(GAP_MINUTES), F.lit(0))
    return out.select("alert_id", "ticker", F.when(fresh, F.col("last_close")).alias("last_close"),
                      tf.ntz_text(F.col("last_ts")).alias("last_ts"), "next_open", tf.ntz_text(F.col("next_ts")).alias("next_ts"))


# ---- P10 + P11 corrected -----------------------------------------------------------------

def _exchange_sql() -> str:
    shut = ", ".join(f"(DATE '{d}')" for d in us_holidays(1990, 2040))
    return sql(f"""
holiday(d) AS (VALUES {shut})""", """
sessions AS (SELECT CAST(d AS DATE) AS d FROM range(DATE '1990-01-01', DATE '2040-01-01', INTERVAL 1 DAY) r(d)
             WHERE isodow(d) < 6 AND CAST(d AS DATE) NOT IN (SELECT d FROM holiday))""", """
there AS (SELECT k, published_ts, timezone('America/New_York', timezone('UTC', published_ts)) AS l FROM filings_fx)""", """
timed AS (SELECT *, CAST(l AS DATE) AS day, hour(l) * 60 + minute(l) AS minute,
                 CAST(l AS DATE) + (CASE WHEN hour(l) >= 16 THEN 1 ELSE 0 END) AS start FROM there)""", query="""
SELECT t.k, CASE WHEN isodow(t.day) >= 6 THEN 'weekend' WHEN t.day IN (SELECT d FROM holiday) THEN 'holiday'
                 WHEN t.minute < 570 THEN 'pre-market' WHEN t.minute < 960 THEN 'market-hours' ELSE 'after-hours' END AS filing_context,
       CAST(s.d AS VARCHAR) AS session_date,
       strftime(timezone('UTC', timezone('America/New_York', CAST(s.d AS TIMESTAMP) + INTERVAL 570 MINUTE)), '%Y-%m-%d %H:%M') AS opens_utc
FROM timed t ASOF LEFT JOIN sessions s ON t.start <= s.d""")


@register("exchange_sessions", _exchange_sql)
def exchange_sessions(spark, sf_dir):
    """P10 + P11 corrected: context and session by the exchange's zone, daylight saving and holidays, and the UTC time
    at which that session opens."""
    exchange, ts = Exchange(), F.col("published_ts")
    f = fxf.filings_fx(spark, sf_dir).select("k", "published_ts").withColumn("day", exchange.session_date(ts))
    return f.select("k", exchange.context(ts).alias("filing_context"), F.col("day").cast("string").alias("session_date"),
                    tf.fmt_minute(exchange.utc(F.col("day"), exchange.open_minute)).alias("opens_utc"))


# ---- J15 + S10 as a stored upsert -----------------------------------------------------------

@register("history_store", lambda: ORACLES["history_upsert"]())
def history_store_query(spark, sf_dir):
    """J15 + S10: nested records in two appends (the second twice) and a compaction after each; the flat columns of
    the current table are what one upsert gives."""
    h = route.history_rows(gates.routed(routed_frame(spark, sf_dir)))
    records = history_store.nested_record(h)
    store = history_store.HistoryStore(spark, *folder(spark, "history", "store"), records.schema)
    store.append(records.where("feed_rank % 3 <> 0"), 0)
    store.compact(0)
    store.append(records.where("feed_rank % 3 = 0"), 1)
    store.append(records.where("feed_rank % 3 = 0"), 1)
    store.compact(1)
    return store.read().select(*HIST_COLS)


# ---- ST2 bounded ----------------------------------------------------------------------------

DEDUP_DELAY_H = 24
DEDUP_SPLIT = "1998-01-01"


@register("stream_dedup_bounded", lambda: sql(FEED_SQL, f"""
timed AS (SELECT accession, feed, published_ts AS t FROM feed_ids WHERE accession IS NOT NULL AND published_ts IS NOT NULL)""", f"""
early AS (SELECT * FROM timed WHERE feed = 'primary' AND t < TIMESTAMP '{DEDUP_SPLIT}')""", f"""
mark AS (SELECT max(t) - INTERVAL {DEDUP_DELAY_H} HOUR AS w FROM early)""", f"""
later AS (SELECT t.*, t.t < m.w AS late FROM timed t, mark m WHERE NOT (feed = 'primary' AND t.t < TIMESTAMP '{DEDUP_SPLIT}'))""", query="""
SELECT accession, (SELECT count(*) FROM later WHERE late) AS n_late
FROM (SELECT accession FROM early UNION SELECT l.accession FROM later l WHERE NOT late)"""))
def stream_dedup_bounded(spark, sf_dir):
    """ST2 bounded: each accession once, with state for a day of event time.  The primary feed's early years land
    first; the backup feed lands with the rest, so its copies of them come late and are dropped and counted."""
    timed, = folder(spark, "dedup-bounded", "timed")
    feed_ids(spark, sf_dir).select("accession", "feed", "published_ts").write.parquet(timed)   # parse the times once
    rows = spark.read.parquet(timed).where("accession IS NOT NULL AND published_ts IS NOT NULL").select(
        "accession", "feed", S.utc_instant(F.col("published_ts")).alias("event_time"))
    early = (F.col("feed") == "primary") & (F.col("event_time") < F.lit(f"{DEDUP_SPLIT} 00:00:00 UTC").cast("timestamp"))
    landed, sink, checkpoint = folder(spark, "dedup-bounded", "feed", "sink", "checkpoint")
    late = 0
    for some in (rows.where(early), rows.where(~early)):
        some.write.mode("append").parquet(landed)
        stream = S.dedup_within_watermark(S.file_stream(spark, landed, rows.schema), "accession", "event_time",
                                          f"{DEDUP_DELAY_H} hours")
        late += S.run_available_now(stream, sink, checkpoint)
    return spark.read.schema(rows.schema).parquet(sink).select("accession", F.lit(late).cast("bigint").alias("n_late"))
