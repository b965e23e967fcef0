"""Registered queries: the filing pipeline (identifiers, feeds, ledger,
lookups, market, roles, scores, routing, history, funnel, diagnostics)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealflow.functions import identifiers as ids
from dealflow.functions import text as T
from dealflow.functions import timefns as tf
from dealflow.operators import enrich, gates, ledger, route, score
from dealflow.operators.lookup import lookup
from dealflow.plans import fx_filings as fxf
from dealflow.plans import ox_filings as oxf
from dealflow.plans import ox_ids as oi
from dealflow.plans import ox_text as ot
from dealflow.plans.oracle import filing_context_sql
from dealflow.plans.registry import register

BASE = [oxf.FILINGS_FX, oxf.FEED_ENTRIES_FX, oxf.LEDGER_FX, oxf.ISSUERS_FX, oxf.SUBMISSIONS_FX,
        oxf.SUB_TICKERS_FX, oxf.NAMES_FX, oxf.NAME_QUOTES_FX, oxf.MARKET_FX, oxf.FILING_DOCS_FX,
        oxf.ANALYSIS_FX]

FEED_SQL = f"""
feed_ids AS (
  SELECT k, feed, feed_rank, title, link, entry_id, published_raw,
         {oi.acc_v2_sql('link', 'entry_id')} AS accession, {oi.cik_v2_sql('link', 'entry_id')} AS cik,
         {oi.ticker_hint_sql('title')} AS ticker_hint, {oi.parse_published_sql('published_raw')} AS published_ts
  FROM feed_entries_fx WHERE contains(title, '8-K')),
merged AS (
  SELECT * FROM feed_ids WHERE feed = 'primary'
  UNION ALL
  SELECT * FROM feed_ids WHERE feed = 'backup' AND accession IS NOT NULL
    AND accession NOT IN (SELECT accession FROM feed_ids WHERE feed = 'primary' AND accession IS NOT NULL)),
flagged AS (
  SELECT m.*, (l.accession IS NOT NULL) OR m.feed_rank > min(m.feed_rank) OVER (PARTITION BY m.accession)
           AS is_processed
  FROM merged m LEFT JOIN (SELECT DISTINCT accession FROM ledger_fx) l ON m.accession = l.accession
  WHERE m.accession IS NOT NULL)"""


def sql(*extra: str, query: str) -> str:
    return "WITH " + ",".join(BASE + list(extra)) + "\n" + query


# ---- shared Spark frames ----------------------------------------------------

def feed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = gates.form_filter(fxf.feed_entries_fx(spark, sf_dir))
    link, eid = F.col("link"), F.col("entry_id")
    return e.select("k", "feed", "feed_rank", "title", "link", "entry_id", "published_raw",
                    ids.accession_v2(link, eid).alias("accession"), ids.cik_v2(link, eid).alias("cik"),
                    ids.ticker_hint(F.col("title")).alias("ticker_hint"),
                    tf.parse_published(F.col("published_raw")).alias("published_ts"))


def merged_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.merged_flags(feed_ids(spark, sf_dir)).drop("is_processed")


def flagged_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.merged_flags(feed_ids(spark, sf_dir), fxf.ledger_fx(spark, sf_dir))


# ---- identifiers --------------------------------------------------------------

@register("filing_identifiers", lambda: sql(query=f"""
SELECT k, {oi.cik_v1_sql('title', 'link')} AS cik_v1, {oi.acc_v1_sql('link')} AS accession_v1,
       {oi.viewer_v1_sql('title', 'link')} AS link_v1,
       {oi.cik_v2_sql('link', 'entry_id')} AS cik_v2, {oi.acc_v2_sql('link', 'entry_id')} AS accession_v2,
       {oi.ticker_hint_sql('title')} AS ticker_hint,
       {oi.cik_pad_sql(oi.cik_v2_sql('link', 'entry_id'))} AS cik_padded,
       replace({oi.acc_v2_sql('link', 'entry_id')}, '-', '') AS accession18,
       'https://www.sec.gov/Archives/edgar/data/' || {oi.cik_v2_sql('link', 'entry_id')} || '/' ||
         replace({oi.acc_v2_sql('link', 'entry_id')}, '-', '') || '/' || {oi.acc_v2_sql('link', 'entry_id')} || '.txt'
         AS document_url,
       {oi.acc_diag_sql('link')} AS accession_diag, {oi.cik_diag_sql('link')} AS cik_diag,
       {oi.iso_sql(oi.parse_published_sql('published_raw'))} AS published_iso
FROM filings_fx WHERE contains(title, '8-K')"""))
def filing_identifiers(spark, sf_dir):
    """P1-P8 and F1 over every 8-K fixture filing."""
    f = gates.form_filter(fxf.filings_fx(spark, sf_dir))
    t, l, e = F.col("title"), F.col("link"), F.col("entry_id")
    c2, a2 = ids.cik_v2(l, e), ids.accession_v2(l, e)
    return f.select("k", ids.cik_v1(t, l).alias("cik_v1"), ids.accession_v1(l).alias("accession_v1"),
                    ids.viewer_link_v1(t, l).alias("link_v1"), c2.alias("cik_v2"), a2.alias("accession_v2"),
                    ids.ticker_hint(t).alias("ticker_hint"), ids.cik_pad(c2).alias("cik_padded"),
                    ids.undashed(a2).alias("accession18"), ids.document_url(c2, a2).alias("document_url"),
                    ids.accession_diag(l).alias("accession_diag"), ids.cik_diag(l).alias("cik_diag"),
                    tf.iso_seconds(tf.parse_published(F.col("published_raw"))).alias("published_iso"))


# ---- feeds and ledger -----------------------------------------------------------

@register("feed_merge", lambda: sql(FEED_SQL, query="SELECT k, feed, feed_rank, accession FROM merged"))
def feed_merge(spark, sf_dir):
    """Primary feed plus backup rows the primary lacks."""
    return merged_feed(spark, sf_dir).select("k", "feed", "feed_rank", "accession")


@register("unprocessed_filings", lambda: sql(FEED_SQL, query="""
SELECT accession, arg_min(k, feed_rank) AS k, arg_min(feed, feed_rank) AS feed, min(feed_rank) AS feed_rank
FROM merged WHERE accession IS NOT NULL AND accession NOT IN (SELECT accession FROM ledger_fx)
GROUP BY accession"""))
def unprocessed_filings(spark, sf_dir):
    """New accessions, first occurrence in feed order."""
    m = ledger.drop_without(merged_feed(spark, sf_dir)).select("accession", "k", "feed", "feed_rank")
    new = ledger.not_processed(m, fxf.ledger_fx(spark, sf_dir))
    return ledger.first_per_key(new, "accession", "feed_rank")


EARLY_SQL = ["""
g AS (SELECT *, sum(CASE WHEN is_processed THEN 0 ELSE 1 END) OVER (ORDER BY feed_rank ROWS UNBOUNDED PRECEDING) AS grp
      FROM flagged)""", """
r AS (SELECT *, CASE WHEN is_processed THEN row_number() OVER (PARTITION BY grp ORDER BY feed_rank)
                     - (CASE WHEN grp > 0 THEN 1 ELSE 0 END) ELSE 0 END AS run_length FROM g)"""]


@register("early_stop", lambda: sql(FEED_SQL, *EARLY_SQL, query="""
SELECT accession, k, feed, feed_rank, is_processed, CAST(run_length AS BIGINT) AS run_length,
       (s.stop IS NULL OR feed_rank <= s.stop) AS examined
FROM r, (SELECT min(feed_rank) FILTER (WHERE run_length >= 15) AS stop FROM r) s"""))
def early_stop(spark, sf_dir):
    """Consecutive already-processed run and the examined prefix."""
    f = ledger.drop_without(flagged_feed(spark, sf_dir)).select("accession", "k", "feed", "feed_rank", "is_processed")
    return ledger.early_stop(f, 15).select("accession", "k", "feed", "feed_rank", "is_processed",
                                           F.col("run_length").cast("bigint").alias("run_length"), "examined")


# ---- lookups ------------------------------------------------------------------

@register("issuer_lookup", lambda: sql("""
dim AS (SELECT CAST(cik_str AS VARCHAR) AS cik, upper(arg_min(ticker, ordinal)) AS issuer_ticker
        FROM issuers_fx WHERE ticker IS NOT NULL AND ticker <> '' GROUP BY 1)""", query=f"""
SELECT f.k, {oi.cik_v1_sql('f.title', 'f.link')} AS cik, d.issuer_ticker
FROM filings_fx f LEFT JOIN dim d ON {oi.cik_strip_sql(oi.cik_v1_sql('f.title', 'f.link'))} = d.cik
WHERE contains(f.title, '8-K')"""))
def issuer_lookup(spark, sf_dir):
    """J3 (v1): CIK from title or path, first listed ticker of that CIK."""
    f = gates.form_filter(fxf.filings_fx(spark, sf_dir))
    f = f.select("k", ids.cik_v1(F.col("title"), F.col("link")).alias("cik"))
    return enrich.lookup_issuer(f, fxf.issuers_fx(spark, sf_dir)).select("k", "cik", "issuer_ticker")


META_SQL = f"""
meta AS (
  SELECT m.*, s.items AS meta_items, s.accession AS listed_acc,
         CASE WHEN m.cik IS NOT NULL THEN upper(t.first_ticker) END AS meta_ticker
  FROM merged m
  LEFT JOIN submissions_fx s ON {oi.cik_strip_sql('m.cik')} = {oi.cik_strip_sql('s.cik')} AND m.accession = s.accession
  LEFT JOIN sub_tickers_fx t ON {oi.cik_strip_sql('m.cik')} = {oi.cik_strip_sql('t.cik')}),
meta2 AS (
  SELECT *, CASE WHEN listed_acc IS NOT NULL AND coalesce(meta_items, '') <> '' THEN contains(meta_items, '1.01') END
            AS has_item_101 FROM meta)"""


def meta_frame(spark, sf_dir):
    m = merged_feed(spark, sf_dir)
    return enrich.item_metadata(m, fxf.submissions_fx(spark, sf_dir), fxf.sub_tickers_fx(spark, sf_dir))


@register("item_metadata", lambda: sql(FEED_SQL, META_SQL, query="""
SELECT k, feed, cik, accession, meta_ticker, meta_items, has_item_101 FROM meta2"""))
def item_metadata(spark, sf_dir):
    """J4 + F3: issuer ticker and tri-state Item 1.01 flag from submissions."""
    return meta_frame(spark, sf_dir).select("k", "feed", "cik", "accession", "meta_ticker", "meta_items",
                                            "has_item_101")


def docs_clean(spark, sf_dir):
    return T.with_clean_html(fxf.filing_docs_fx(spark, sf_dir), "raw", "clean")


def with_document_ticker(spark, sf_dir, m: DataFrame) -> DataFrame:
    """T5 from the documents of rows whose title and metadata give no ticker."""
    lacks = enrich.resolve_ticker(F.col("ticker_hint"), F.col("meta_ticker"), F.lit(None).cast("string")).isNull()
    untold = feed_ids(spark, sf_dir).where(F.coalesce("ticker_hint", F.lit("")) == "")
    d = T.with_clean_html(fxf.filing_docs_fx(spark, sf_dir, m, lacks, needed=untold), "raw", "clean")
    return d.withColumn("doc_ticker", F.when(lacks, T.ticker_v2(F.col("clean")))).drop("raw", "clean")


DOCS_SQL = f"""
docs_clean AS (SELECT *, {ot.clean_html_sql('raw')} AS clean FROM filing_docs_fx)"""


@register("ticker_resolution", lambda: sql(FEED_SQL, META_SQL, DOCS_SQL, query=f"""
SELECT m.k, m.feed, m.ticker_hint, m.meta_ticker,
       CASE WHEN coalesce(nullif(m.ticker_hint, ''), nullif(m.meta_ticker, '')) IS NULL
            THEN {ot.ticker_v2_sql('d.clean')} END AS doc_ticker,
       coalesce(nullif(m.ticker_hint, ''), nullif(m.meta_ticker, ''), nullif({ot.ticker_v2_sql('d.clean')}, ''))
         AS ticker
FROM meta2 m LEFT JOIN docs_clean d ON m.k = d.k"""))
def ticker_resolution(spark, sf_dir):
    """J9 + T5: title hint, then submissions ticker, then the document, which
    is read only for the filings that have neither."""
    j = with_document_ticker(spark, sf_dir, meta_frame(spark, sf_dir))
    return j.select("k", "feed", "ticker_hint", "meta_ticker", "doc_ticker",
                    enrich.resolve_ticker(F.col("ticker_hint"), F.col("meta_ticker"), F.col("doc_ticker")).alias("ticker"))


def _cands_sql(company: str) -> str:
    s = company
    for suf in enrich.NAME_SUFFIXES:
        s = f"replace({s}, {ot.q(suf)}, '')"
    words = f"list_filter(regexp_split_to_array({ot.strip_sql(s)}, '\\s+'), lambda w: w <> '')"
    initials = f"array_to_string(list_transform({words}, lambda w: substr(w, 1, 1)), '')"
    c1 = f"CASE WHEN len({words}) >= 2 AND length({initials}) BETWEEN 2 AND 5 THEN upper({initials}) END"
    c2 = f"CASE WHEN length({words}[1]) BETWEEN 2 AND 5 THEN upper({words}[1]) END"
    return f"list_filter([{c1}, {c2}], lambda x: x IS NOT NULL)"


@register("name_ticker_candidates", lambda: sql(f"""
cands AS (SELECT name_id, company, {_cands_sql('company')} AS candidates FROM names_fx),
valid AS (SELECT DISTINCT ticker FROM name_quotes_fx WHERE regular_market_price IS NOT NULL AND regular_market_price <> 0),
hit AS (SELECT name_id, arg_min(c, pos) AS resolved_ticker
        FROM (SELECT name_id, unnest(candidates) AS c, generate_subscripts(candidates, 1) - 1 AS pos FROM cands) x
        WHERE c IN (SELECT ticker FROM valid) GROUP BY name_id)""", query="""
SELECT c.name_id, c.company, array_to_string(c.candidates, ',') AS candidates, h.resolved_ticker
FROM cands c LEFT JOIN hit h ON c.name_id = h.name_id"""))
def name_ticker_candidates(spark, sf_dir):
    """T11 + J8: guess tickers from company names; first valid candidate wins."""
    r = enrich.resolve_by_name(fxf.names_fx(spark, sf_dir), fxf.name_quotes_fx(spark, sf_dir))
    return r.select("name_id", "company", F.array_join("candidates", ",").alias("candidates"), "resolved_ticker")


# ---- market -----------------------------------------------------------------------

def _first_truthy_sql(*cols):
    out = cols[-1]
    for c in reversed(cols[:-1]):
        out = f"(CASE WHEN {c} IS NOT NULL AND {c} <> 0 THEN {c} ELSE {out} END)"
    return out


def _tr(c):
    return f"({c} IS NOT NULL AND {c} <> 0)"


def cap_label_sql(cap: str, strict: bool = False) -> str:
    op = ">" if strict else ">="
    return (f"(CASE WHEN NOT {_tr(cap)} THEN 'Unknown' WHEN {cap} {op} 1e9 THEN printf('$%.2fB', {cap} / 1e9) "
            f"ELSE printf('$%.1fM', {cap} / 1e6) END)")


SNAP_SQL = f"""
snap AS (
  SELECT *, {_first_truthy_sql('current_price', 'regular_market_price', 'previous_close', 'regular_market_previous_close')} AS price,
         (CASE WHEN {_tr('market_cap')} THEN market_cap
               WHEN {_tr('shares_outstanding')} AND {_tr(_first_truthy_sql('previous_close', 'regular_market_previous_close'))}
               THEN shares_outstanding * {_first_truthy_sql('previous_close', 'regular_market_previous_close')}
               ELSE market_cap END) AS cap,
         CASE WHEN {_tr('avg_volume')} THEN volume / avg_volume ELSE 1.0 END AS volume_spike
  FROM market_fx)"""


@register("market_enrich", lambda: sql(SNAP_SQL, query=f"""
SELECT custkey, ticker, price, cap, {cap_label_sql('cap')} AS cap_formatted,
       {cap_label_sql('market_cap', strict=True)} AS cap_formatted_v1, volume_spike
FROM snap"""))
def market_enrich(spark, sf_dir):
    """E1, E2, E4 over every market snapshot (J6 inputs)."""
    s = enrich.market_snapshot(fxf.market_fx(spark, sf_dir))
    return s.select("custkey", "ticker", "price", "cap", "cap_formatted",
                    enrich.cap_label(F.col("market_cap"), strict=True).alias("cap_formatted_v1"), "volume_spike")


@register("market_completeness", lambda: sql(query=f"""
SELECT custkey, ticker,
       array_to_string(list_filter([CASE WHEN NOT {_tr(_first_truthy_sql('current_price', 'regular_market_price'))} THEN 'current_price' END,
                                    CASE WHEN NOT {_tr('market_cap')} THEN 'market_cap' END,
                                    CASE WHEN NOT {_tr('volume')} THEN 'volume' END], lambda x: x IS NOT NULL), ',') AS missing
FROM market_fx"""))
def market_completeness(spark, sf_dir):
    """Missing key fields per snapshot."""
    c = enrich.completeness(fxf.market_fx(spark, sf_dir))
    return c.select("custkey", "ticker", F.array_join("missing", ",").alias("missing"))


LIQ_SQL = """(CASE WHEN NOT (cap IS NOT NULL AND cap <> 0) THEN 'no_cap' WHEN cap < 100000000.0 THEN 'low_cap'
     WHEN avg_volume IS NULL OR avg_volume < 100000.0 THEN 'low_volume'
     WHEN avg_volume * (CASE WHEN price IS NOT NULL AND price <> 0 THEN price ELSE 0.0 END) < 500000.0
       THEN 'low_dollar_volume' ELSE 'OK' END)"""


@register("liquidity_gate", lambda: sql(SNAP_SQL, query=f"SELECT custkey, ticker, {LIQ_SQL} AS liquidity FROM snap"))
def liquidity_gate(spark, sf_dir):
    """first failing liquidity rule per snapshot."""
    s = enrich.market_snapshot(fxf.market_fx(spark, sf_dir))
    return s.select("custkey", "ticker", gates.liquidity_reason(F.col("cap"), F.col("avg_volume"),
                                                                  F.col("price")).alias("liquidity"))


# ---- roles, premiums, signals, scores --------------------------------------------------

def roles_frame(spark, sf_dir, texts=True):
    return enrich.resolve_roles(fxf.analysis_fx(spark, sf_dir, texts), fxf.market_fx(spark, sf_dir))


def _snap_cols(prefix):
    return ", ".join(f"{c} AS {prefix}{c}" for c in enrich.SNAP_COLS)


ROLES_SQL = f"""
snap2 AS (SELECT ticker, price, cap, {cap_label_sql('cap')} AS cap_formatted, volume_spike, short_percent,
                 institutional_pct, week_change_pct, error
          FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY custkey) AS rn FROM snap
                WHERE ticker IS NOT NULL) z WHERE rn = 1),
r0 AS (
  SELECT a.*, f.*, CASE WHEN a.filer_role = 'acquirer' AND nullif(a.target_ticker, '') IS NOT NULL
                         AND nullif(a.target_ticker, '') IS DISTINCT FROM a.filer_ticker THEN nullif(a.target_ticker, '')
                        WHEN a.filer_role = 'target' AND nullif(a.acquirer_ticker, '') IS NOT NULL
                         AND nullif(a.acquirer_ticker, '') IS DISTINCT FROM a.filer_ticker THEN nullif(a.acquirer_ticker, '')
                   END AS cp_key
  FROM analysis_fx a LEFT JOIN (SELECT {_snap_cols('f_')} FROM snap2) f ON a.filer_ticker = f.f_ticker),
r1 AS (SELECT r0.*, c.* FROM r0 LEFT JOIN (SELECT {_snap_cols('c_')} FROM snap2) c ON r0.cp_key = c.c_ticker),
roles AS (
  SELECT *, {', '.join(
      f"CASE WHEN filer_role = 'acquirer' THEN (CASE WHEN c_ticker IS NOT NULL AND c_error IS NULL AND {_tr('c_cap')} THEN c_{c} END) "
      f"ELSE (CASE WHEN f_ticker IS NOT NULL THEN f_{c} END) END AS tgt_{c}, "
      f"CASE WHEN filer_role = 'acquirer' THEN (CASE WHEN f_ticker IS NOT NULL THEN f_{c} END) "
      f"WHEN filer_role = 'target' THEN (CASE WHEN c_ticker IS NOT NULL AND c_error IS NULL THEN c_{c} END) END AS acq_{c}"
      for c in enrich.SNAP_COLS)}
  FROM r1),
roles2 AS (
  SELECT *, CASE WHEN {_tr('offer_price_per_share')} AND {_tr('tgt_price')} AND tgt_price > 0
                 THEN round((offer_price_per_share - tgt_price) / tgt_price * 100, 1) END AS upside_pct,
            CASE WHEN {_tr('offer_price_per_share')} THEN premium_pct END AS premium_pct_checked,
            CASE WHEN acq_ticker IS NOT NULL AND acq_error IS NULL AND {_tr('acq_price')} AND {_tr('acq_cap')}
                  AND {_tr('tgt_cap')} THEN acq_cap / tgt_cap END AS cap_ratio
  FROM roles)"""

ROLE_COLS = ["k", "filer_role", "tgt_ticker", "tgt_price", "tgt_cap", "acq_ticker", "acq_price", "acq_cap",
             "upside_pct", "premium_pct_checked", "cap_ratio"]


@register("role_resolution", lambda: sql(SNAP_SQL, ROLES_SQL, query=f"SELECT {', '.join(ROLE_COLS)} FROM roles2"))
def role_resolution(spark, sf_dir):
    """target/acquirer market rows by filer role."""
    return roles_frame(spark, sf_dir).select(*ROLE_COLS)


@register("deal_premium", lambda: sql(SNAP_SQL, query="""
SELECT a.k, round(CASE WHEN s.shares_outstanding IS NOT NULL AND s.shares_outstanding <> 0
                       THEN a.deal_value_usd / s.shares_outstanding END, 4) AS implied_offer,
       round(CASE WHEN s.cap IS NOT NULL AND s.cap <> 0 THEN (a.deal_value_usd - s.cap) / s.cap END * 100, 2)
         AS premium_vs_cap,
       CASE WHEN a.is_full_acquisition THEN
         round(CASE WHEN s.price IS NOT NULL AND s.price <> 0 THEN
                 ((CASE WHEN s.shares_outstanding IS NOT NULL AND s.shares_outstanding <> 0
                        THEN a.deal_value_usd / s.shares_outstanding END) - s.price) / s.price END * 100, 2) END
         AS premium_vs_price
FROM analysis_fx a LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY custkey) AS rn
                                            FROM snap WHERE ticker IS NOT NULL) z WHERE rn = 1) s
  ON a.filer_ticker = s.ticker"""))
def deal_premium(spark, sf_dir):
    """Premium over cap (v1) and implied offer over price (v2)."""
    s = enrich.first_snapshot(fxf.market_fx(spark, sf_dir)).select("ticker", "cap", "price", "shares_outstanding")
    a = fxf.analysis_fx(spark, sf_dir).select("k", "filer_ticker", "deal_value_usd", "is_full_acquisition")
    j = lookup(a, s, [(F.col("filer_ticker"), "ticker")], "k")
    return enrich.deal_premiums(j).select("k", "implied_offer", "premium_vs_cap", "premium_vs_price")


def _label_sql(spike, short, inst, chg):
    sp = f"({short} * 100)"
    ip = f"(coalesce({inst}, 0.0) * 100)"
    return f"""CASE WHEN {spike} >= 10 THEN 'extreme' WHEN {spike} >= 5 THEN 'very_high' WHEN {spike} >= 2 THEN 'elevated' END AS volume_label,
       CASE WHEN NOT {_tr(short)} THEN NULL WHEN {sp} >= 15 THEN 'high' WHEN {sp} >= 7 THEN 'moderate' ELSE 'low' END AS short_label,
       CASE WHEN {ip} <= 0 THEN NULL WHEN {ip} >= 80 THEN 'near_certain' WHEN {ip} >= 50 THEN 'significant' ELSE 'low' END AS institutions_label,
       CASE WHEN abs({chg}) > 5 THEN 'already_moved' END AS week_label"""


ALERT_SIGNAL_SQL = """CASE WHEN filer_role = 'target' AND coalesce(is_full_acquisition, false) THEN
         (CASE WHEN deal_structure = 'all-cash' THEN 'BUY_TARGET'
               WHEN deal_structure IN ('all-stock', 'mixed') THEN 'SPECULATIVE_BUY_TARGET' ELSE 'WATCH_TARGET' END)
       WHEN filer_role = 'acquirer' THEN
         (CASE WHEN (target_ticker IS NOT NULL AND target_ticker <> '') OR (tgt_price IS NOT NULL AND tgt_price <> 0)
               THEN 'WATCH_ACQUIRER_PUBLIC_TARGET' ELSE 'WATCH_ACQUIRER_PRIVATE_TARGET' END)
       WHEN coalesce(is_full_acquisition, false) THEN 'BUY_TARGET' ELSE 'WATCH' END"""
HIST_SIGNAL_SQL = """CASE WHEN filer_role = 'target' AND coalesce(is_full_acquisition, false) THEN 'KUPUJ_TARGET'
            WHEN filer_role = 'acquirer' THEN 'OBSERWUJ_ACQUIRERA' ELSE 'OBSERWUJ' END"""
HIST_DIR_SQL = """CASE WHEN filer_role = 'target' AND coalesce(is_full_acquisition, false) THEN 'bullish' ELSE 'neutral' END"""


@register("signal_labels", lambda: sql(SNAP_SQL, ROLES_SQL, query=f"""
SELECT k, {HIST_SIGNAL_SQL} AS history_signal, {HIST_DIR_SQL} AS direction, {ALERT_SIGNAL_SQL} AS alert_signal,
       {_label_sql('tgt_volume_spike', 'tgt_short_percent', 'tgt_institutional_pct', 'tgt_week_change_pct')}
FROM roles2"""))
def signal_labels(spark, sf_dir):
    """History signal and direction, alert signal, market labels."""
    r = roles_frame(spark, sf_dir)
    sig, direction = route.history_signal(F.col("filer_role"), F.col("is_full_acquisition"))
    return r.select("k", sig.alias("history_signal"), direction.alias("direction"),
                    route.alert_signal(F.col("filer_role"), F.col("is_full_acquisition"), F.col("deal_structure"),
                                       F.col("target_ticker"), F.col("tgt_price")).alias("alert_signal"),
                    route.volume_label(F.col("tgt_volume_spike")).alias("volume_label"),
                    route.short_label(F.col("tgt_short_percent")).alias("short_label"),
                    route.institutions_label(F.col("tgt_institutional_pct")).alias("institutions_label"),
                    route.week_move_label(F.col("tgt_week_change_pct")).alias("week_label"))


def _priority_sql(score: str) -> str:
    s = f"TRY_CAST(CAST({score} AS VARCHAR) AS DOUBLE)"
    return f"(CASE WHEN {s} >= 9 THEN 'MEGA' WHEN {s} >= 7 THEN 'MAJOR' WHEN {s} >= 5 THEN 'STANDARD' END)"


def _rule_score_sql(section, deal_type, full, structure, premium, short):
    credit = f"({ot.any_pattern_sql(section, T.MA_EXCLUSIONS)} AND NOT {ot.any_pattern_sql(section, T.MA_KEYWORDS_STRONG)})"
    acq = f"({deal_type} = 'acquisition')"
    sq = f"coalesce({short} > 0.15, false)"
    fu = f"coalesce({full}, false)"
    base = (f"(CASE WHEN coalesce({credit}, false) THEN 1 "
            f"WHEN {fu} AND ({structure} = 'all-cash' OR coalesce({premium} > 40, false) OR ({sq} AND {acq})) THEN 9 "
            f"WHEN {fu} AND ({structure} IN ('mixed', 'all-stock') OR coalesce({premium} BETWEEN 20 AND 40, false)) THEN 7 "
            f"WHEN ({acq} AND NOT {fu}) OR {deal_type} = 'merger' THEN 5 ELSE 1 END)")
    bonus = f"(CASE WHEN NOT coalesce({credit}, false) AND {acq} AND {sq} THEN 1 ELSE 0 END)"
    return f"least({base} + {bonus}, 10)"


@register("rule_score", lambda: sql(SNAP_SQL, ROLES_SQL, DOCS_SQL, """
rs AS (SELECT r.*, d.clean FROM roles2 r LEFT JOIN docs_clean d ON r.k = d.k)""", f"""
rs2 AS (SELECT k, {_rule_score_sql(ot.section_v2_sql('clean'), 'deal_type', 'is_full_acquisition', 'deal_structure',
                                   'premium_pct', 'tgt_short_percent')} AS rule_score FROM rs)""", query=f"""
SELECT k, rule_score, {_priority_sql('rule_score')} AS rule_priority FROM rs2"""))
def rule_score(spark, sf_dir):
    """R2 (+R3): deterministic rubric score of each filing and its priority."""
    r = roles_frame(spark, sf_dir).select("k", "deal_type", "is_full_acquisition", "deal_structure", "premium_pct",
                                          "tgt_short_percent")
    cols = score.column_score(F.col("deal_type"), F.col("is_full_acquisition"), F.col("deal_structure"),
                              F.col("premium_pct"), F.col("tgt_short_percent"))
    at_most = score.column_score(F.col("deal_type"), F.col("is_full_acquisition"), F.col("deal_structure"),
                                 F.col("premium_pct"), F.lit(1.0))           # whatever the short interest is
    some = fxf.analysis_fx(spark, sf_dir, texts=False).where(at_most > 1)
    # one function reads a document; its cleaned text and section stay in it
    d = fxf.filing_docs_fx(spark, sf_dir, r, cols > 1, needed=some)
    d = T.with_clean_html(T.Scans(d, "clean", "section"), "raw", "clean")
    d = T.with_section_v2(d, "clean", "section", T.SECTION_CHARS_V2)
    j = score.with_credit(d, "section", "credit").run()
    s = score.rule_score(None, F.col("deal_type"), F.col("is_full_acquisition"), F.col("deal_structure"),
                         F.col("premium_pct"), F.col("tgt_short_percent"), credit=F.col("credit"))
    return j.select("k", s.alias("rule_score"), route.priority(s).alias("rule_priority"))


@register("route_priority", lambda: sql(query=f"""
SELECT k, {_priority_sql('impact_score')} AS priority,
       CASE WHEN TRY_CAST(CAST(impact_score AS VARCHAR) AS DOUBLE) IS NULL THEN 'bad_score'
            WHEN {_priority_sql('impact_score')} IS NULL THEN 'low_impact' ELSE 'alert' END AS route_outcome
FROM analysis_fx"""))
def route_priority(spark, sf_dir):
    """R3 + F8: priority bands of the scorer's impact score."""
    a = fxf.analysis_fx(spark, sf_dir)
    return a.select("k", route.priority(F.col("impact_score")).alias("priority"),
                    route.route_outcome(F.col("impact_score")).alias("route_outcome"))


def routed_frame(spark, sf_dir, texts=True):
    r = roles_frame(spark, sf_dir, texts)
    return (r.withColumn("published_ts", tf.parse_published(F.col("published_raw")))
             .withColumn("priority", route.priority(F.col("impact_score")))
             .withColumn("feed_rank", F.col("k")))


HIST_COLS = ["id", "ticker", "filing_timestamp", "filing_context", "priority", "signal", "direction", "filer_role",
             "deal_structure", "price_at_filing", "premium_pct", "upside_pct", "groq_score", "feed_rank"]


@register("history_upsert", lambda: sql(SNAP_SQL, ROLES_SQL, f"""
h0 AS (SELECT *, {oi.parse_published_sql('published_raw')} AS published_ts, {_priority_sql('impact_score')} AS priority,
              coalesce(nullif(tgt_ticker, ''), nullif(target_ticker, ''), nullif(acq_ticker, ''),
                       nullif(acquirer_ticker, '')) AS disp
       FROM roles2)""", f"""
h1 AS (SELECT disp || '-' || substr(coalesce({oi.iso_sql('published_ts')}, ''), 1, 10) AS id, disp AS ticker,
              coalesce({oi.iso_sql('published_ts')}, '') AS filing_timestamp,
              {filing_context_sql('published_ts')} AS filing_context, priority,
              {HIST_SIGNAL_SQL} AS signal, {HIST_DIR_SQL} AS direction, coalesce(filer_role, 'unknown') AS filer_role,
              coalesce(deal_structure, '') AS deal_structure, tgt_price AS price_at_filing,
              premium_pct_checked AS premium_pct, upside_pct, impact_score AS groq_score, k AS feed_rank
       FROM h0 WHERE priority IS NOT NULL AND disp IS NOT NULL)""", query=f"""
SELECT {', '.join(HIST_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY feed_rank DESC) AS rn FROM h1) z WHERE rn = 1"""))
def history_upsert(spark, sf_dir):
    """Routed alerts to history rows, upserted by id."""
    h = route.history_rows(gates.routed(routed_frame(spark, sf_dir)))
    return ledger.latest_per_key(h.select(*HIST_COLS), "id", "feed_rank")


# ---- model output (T12, R1) ---------------------------------------------------------

MODEL_SCHEMA = "impact_score double, filer_role string, deal_type string, is_full_acquisition boolean, " \
               "premium_pct double, target_ticker string, key_points array<string>"


def model_text(a: DataFrame) -> DataFrame:
    """The scorer's answer rendered four ways: bare, fenced, inside prose, broken."""
    k = F.col("k")
    num = lambda c: F.coalesce(F.col(c).cast("bigint").cast("string"), F.lit("null"))
    js = F.concat(
        F.lit('{"impact_score": '), num("impact_score"),
        F.lit(', "filer_role": "'), F.col("filer_role"), F.lit('", "deal_type": "'), F.col("deal_type"),
        F.lit('", "is_full_acquisition": '), F.when(F.col("is_full_acquisition"), F.lit("true")).otherwise(F.lit("false")),
        F.lit(', "premium_pct": '), num("premium_pct"),
        F.lit(', "target_ticker": '), F.coalesce(F.concat(F.lit('"'), F.col("target_ticker"), F.lit('"')), F.lit("null")),
        F.lit(', "key_points": ['), F.array_join(F.transform("key_points", lambda x: F.concat(F.lit('"'), x, F.lit('"'))), ", "),
        F.lit("]}"))
    text = (F.when(k % 4 == 0, js)
            .when(k % 4 == 1, F.concat(F.lit("```json\n"), js, F.lit("\n```")))
            .when(k % 4 == 2, F.concat(F.lit("Here is the analysis: "), js, F.lit(" Thanks.")))
            .otherwise(F.substring(js, F.lit(1), F.length(js) - 1)))
    return a.withColumn("model_text", text)


def _model_text_sql():
    num = lambda c: f"coalesce(CAST(CAST({c} AS BIGINT) AS VARCHAR), 'null')"
    js = ("'{\"impact_score\": ' || " + num("impact_score") + " || ', \"filer_role\": \"' || filer_role || "
          "'\", \"deal_type\": \"' || deal_type || '\", \"is_full_acquisition\": ' || "
          "CASE WHEN is_full_acquisition THEN 'true' ELSE 'false' END || ', \"premium_pct\": ' || " + num("premium_pct") +
          " || ', \"target_ticker\": ' || coalesce('\"' || target_ticker || '\"', 'null') || ', \"key_points\": [' || "
          "array_to_string(list_transform(key_points, lambda x: '\"' || x || '\"'), ', ') || ']}'")
    st = ot.strip_sql("model_text")
    b1 = (f"CASE WHEN contains({st}, '```json') THEN split_part(string_split({st}, '```json')[2], '```', 1) "
          f"WHEN contains({st}, '```') THEN split_part({st}, '```', 2) ELSE {st} END")
    return f"""
mt0 AS (SELECT *, {js} AS js FROM analysis_fx),
mt AS (SELECT *, CASE WHEN k % 4 = 0 THEN js WHEN k % 4 = 1 THEN '```json' || chr(10) || js || chr(10) || '```'
                      WHEN k % 4 = 2 THEN 'Here is the analysis: ' || js || ' Thanks.'
                      ELSE substr(js, 1, length(js) - 1) END AS model_text FROM mt0),
mp AS (SELECT *, nullif(regexp_extract(model_text, '(?s)\\{{.*\\}}', 0), '') AS b2, {ot.strip_sql(b1)} AS b1
       FROM mt)"""


def parsed_models(spark, sf_dir):
    a = model_text(fxf.analysis_fx(spark, sf_dir))
    b1 = T.json_block_v1(F.col("model_text"))
    v1 = F.from_json(b1, MODEL_SCHEMA)
    v1_ok = b1.rlike(r"(?s)^\{.*\}$") & v1.getField("filer_role").isNotNull()
    v2 = score.parse_model_output(F.col("model_text"), MODEL_SCHEMA, "filer_role")
    return a.select("k", (F.col("k") % 4).alias("render_form"), F.coalesce(v1_ok, F.lit(False)).alias("v1_ok"),
                    F.coalesce(v2.isNotNull(), F.lit(False)).alias("v2_ok"), v2.alias("m"))


@register("model_json", lambda: sql(_model_text_sql(), query="""
SELECT k, k % 4 AS render_form,
       coalesce(CASE WHEN regexp_matches(b1, '(?s)^\\{.*\\}$') AND json_valid(b1)
                     THEN json_extract_string(b1, '$.filer_role') IS NOT NULL END, false) AS v1_ok,
       coalesce(CASE WHEN json_valid(b2) THEN json_extract_string(b2, '$.filer_role') IS NOT NULL END, false) AS v2_ok,
       CASE WHEN json_valid(b2) THEN CAST(json_extract(b2, '$.impact_score') AS DOUBLE) END AS impact_score,
       CASE WHEN json_valid(b2) THEN json_extract_string(b2, '$.filer_role') END AS filer_role,
       CASE WHEN json_valid(b2) THEN CAST(json_array_length(b2, '$.key_points') AS INTEGER) END AS n_key_points
FROM mp"""))
def model_json(spark, sf_dir):
    """T12 + R1: structured JSON out of the scorer's free text (v1 fences, v2 braces)."""
    p = parsed_models(spark, sf_dir)
    return p.select("k", "render_form", "v1_ok", "v2_ok", F.col("m.impact_score").alias("impact_score"),
                    F.col("m.filer_role").alias("filer_role"),
                    F.when(F.col("v2_ok"), F.size("m.key_points")).alias("n_key_points"))


# ---- whole pipeline: funnel and diagnostics ----------------------------------------------

def funnel_frame(spark, sf_dir):
    """Each feed row's outcome.  What columns settle is settled first; documents, market and model answers are
    joined to the rows that are still open, and a document is cleaned only where its ticker is needed."""
    meta = enrich.item_metadata(flagged_feed(spark, sf_dir), fxf.submissions_fx(spark, sf_dir), fxf.sub_tickers_fx(spark, sf_dir))
    early = (F.when(F.col("accession").isNull(), F.lit("no_accession"))
             .when(F.col("is_processed"), F.lit("already_processed"))
             .when(F.col("cik").isNotNull() & (F.col("has_item_101") == F.lit(False)), F.lit("no_item_101_meta")))
    meta = meta.withColumn("_early", early)
    open_ = F.col("_early").isNull()
    done = meta.where(~open_).select("feed_rank", F.col("_early").alias("outcome"))
    rows = meta.where(open_).select("k", "feed_rank", "cik", "accession", "is_processed", "has_item_101", "ticker_hint",
                                    "meta_ticker")
    lacks = enrich.resolve_ticker(F.col("ticker_hint"), F.col("meta_ticker"), F.lit(None).cast("string")).isNull()
    j = fxf.filing_docs_fx(spark, sf_dir, rows)
    # the rows that need a document's ticker give their text to the cleaner; the others an empty one
    j = T.with_clean_html(j.withColumn("_text", F.when(lacks, F.col("raw")).otherwise(F.lit(""))), "_text", "clean")
    j = j.withColumn("doc_ticker", F.when(lacks, T.ticker_v2(F.col("clean"))))
    # all that the outcome asks of a text is settled here; no text goes on to the joins
    j = j.withColumn("_raw_ok", F.length(F.coalesce(F.col("raw"), F.lit(""))) > 0)
    j = j.withColumn("_item_text", F.when(F.col("has_item_101").isNull(), T.has_item_101_v2(F.col("raw")))).drop(
        "raw", "_text", "clean")
    j = j.withColumn("ticker", enrich.resolve_ticker(F.col("ticker_hint"), F.col("meta_ticker"), F.col("doc_ticker")))
    snap = enrich.first_snapshot(fxf.market_fx(spark, sf_dir)).select(
        F.col("ticker").alias("_t"), "cap", "avg_volume", "price")
    j = lookup(j, snap, [(F.col("ticker"), "_t")], "feed_rank")
    pm = parsed_models(spark, sf_dir).select("k", "v2_ok", F.col("m.impact_score").alias("model_score"))
    j = j.join(pm, "k", "left")
    liq = gates.liquidity_reason(F.col("cap"), F.col("avg_volume"), F.col("price"))
    outcome = (F.when(~F.col("_raw_ok"), F.lit("empty_document"))
               .when(F.col("has_item_101").isNull() & ~F.col("_item_text"), F.lit("no_item_101_text"))
               .when(F.col("ticker").isNotNull() & (liq != "OK"), F.lit("liquidity"))
               .when(~F.coalesce(F.col("v2_ok"), F.lit(False)), F.lit("score_failed"))
               .otherwise(route.route_outcome(F.col("model_score"))))
    return j.select("feed_rank", outcome.alias("outcome")).unionByName(done)


@register("scan_funnel", lambda: sql(FEED_SQL, META_SQL, DOCS_SQL, SNAP_SQL, _model_text_sql(), f"""
fj AS (
  SELECT m.*, f.is_processed, d.raw,
         coalesce(nullif(m.ticker_hint, ''), nullif(m.meta_ticker, ''), nullif({ot.ticker_v2_sql('d.clean')}, '')) AS ticker
  FROM meta2 m LEFT JOIN flagged f ON m.feed_rank = f.feed_rank LEFT JOIN docs_clean d ON m.k = d.k)""", """
fj2 AS (
  SELECT fj.*, s.cap, s.avg_volume, s.price,
         coalesce(CASE WHEN json_valid(mp.b2) THEN json_extract_string(mp.b2, '$.filer_role') IS NOT NULL END, false) AS v2_ok,
         CASE WHEN json_valid(mp.b2) THEN CAST(json_extract(mp.b2, '$.impact_score') AS DOUBLE) END AS model_score
  FROM fj LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY custkey) AS rn
                                    FROM snap WHERE ticker IS NOT NULL) z WHERE rn = 1) s ON fj.ticker = s.ticker
          LEFT JOIN mp ON fj.k = mp.k)""", query=f"""
SELECT outcome, count(*) AS n FROM (
  SELECT CASE WHEN accession IS NULL THEN 'no_accession'
              WHEN is_processed THEN 'already_processed'
              WHEN cik IS NOT NULL AND has_item_101 = false THEN 'no_item_101_meta'
              WHEN length(coalesce(raw, '')) = 0 THEN 'empty_document'
              WHEN has_item_101 IS NULL AND NOT regexp_matches(raw, {ot.q('(?i)item' + T.WS_RE2 + '*1' + chr(92) + '.01')}) THEN 'no_item_101_text'
              WHEN ticker IS NOT NULL AND {LIQ_SQL} <> 'OK' THEN 'liquidity'
              WHEN NOT v2_ok THEN 'score_failed'
              WHEN TRY_CAST(CAST(model_score AS VARCHAR) AS DOUBLE) IS NULL THEN 'bad_score'
              WHEN {_priority_sql('model_score')} IS NULL THEN 'low_impact' ELSE 'alert' END AS outcome
  FROM fj2) x GROUP BY outcome"""))
def scan_funnel(spark, sf_dir):
    """Every feed row's outcome through the whole v2 pipeline, counted."""
    return funnel_frame(spark, sf_dir).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@register("feed_diagnostics", lambda: sql(query=f"""
SELECT (SELECT count(*) FROM feed_entries_fx WHERE feed = 'primary') AS entries,
       count(*) AS analysed,
       count(*) FILTER (WHERE contains(t.title, '8-K') AND {oi.acc_diag_sql('t.link')} IS NOT NULL
                          AND {oi.cik_diag_sql('t.link')} IS NOT NULL AND length(coalesce(d.raw, '')) > 0
                          AND (contains(lower(d.raw), 'item 1.01') OR contains(lower(d.raw), 'item 1.1'))) AS item_101_found
FROM (SELECT * FROM feed_entries_fx WHERE feed = 'primary' ORDER BY feed_rank LIMIT 50) t
LEFT JOIN filing_docs_fx d ON t.k = d.k"""))
def feed_diagnostics(spark, sf_dir):
    """Entries in the primary feed, entries analysed (the first 50 in
    feed order, a top-k by design) and how many carry Item 1.01."""
    e = fxf.feed_entries_fx(spark, sf_dir).where(F.col("feed") == "primary")
    top = e.orderBy("feed_rank").limit(50)
    t = fxf.filing_docs_fx(spark, sf_dir, top)
    link = F.col("link")
    found = (F.col("title").contains("8-K") & ids.accession_diag(link).isNotNull() & ids.cik_diag(link).isNotNull()
             & (F.length(F.coalesce(F.col("raw"), F.lit(""))) > 0) & T.has_item_101_v1(F.col("raw")))
    a = t.agg(F.count(F.lit(1)).alias("analysed"), F.count_if(found).alias("item_101_found"))
    n = e.agg(F.count(F.lit(1)).alias("entries"))
    both = (a.select(F.lit(None).cast("bigint").alias("entries"), "analysed", "item_101_found")
            .unionByName(n.select("entries", F.lit(None).cast("bigint").alias("analysed"),
                                  F.lit(None).cast("bigint").alias("item_101_found"))))
    return both.agg(F.max("entries").alias("entries"), F.max("analysed").alias("analysed"),
                    F.max("item_101_found").alias("item_101_found"))
