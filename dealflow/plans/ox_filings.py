"""DuckDB twins of ``dealflow.plans.fx_filings`` (CTE strings)."""

from __future__ import annotations

from dealflow.plans.fx_filings import FEED_OFFSET


def letters_sql(n: str) -> str:
    return f"translate(CAST(({n}) AS VARCHAR), '0123456789', 'ABCDEFGHIJ')"


FILINGS_FX = f"""
filings_base AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderdate, o_totalprice, o_orderpriority,
         c_custkey, c_name, CAST(o_custkey AS VARCHAR) AS cik,
         lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik10,
         lpad(CAST(o_custkey AS VARCHAR), 10, '0') || lpad(CAST(year(o_orderdate) % 100 AS VARCHAR), 2, '0')
           || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') AS acc18,
         o_orderdate + (o_orderkey * 37 % 1440) * INTERVAL 1 MINUTE AS pub
  FROM orders JOIN customer ON o_custkey = c_custkey),
filings_fx AS (
  SELECT k, cik, acc18 AS accession18,
         substr(acc18, 1, 10) || '-' || substr(acc18, 11, 2) || '-' || substr(acc18, 13, 6) AS accession_true,
         CASE WHEN o_orderstatus = 'P' THEN '10-Q' ELSE '8-K' END AS form,
         CASE WHEN o_orderstatus = 'P' THEN '10-Q' ELSE '8-K' END || ' - ' || upper(c_name) ||
           CASE WHEN k % 3 = 0 THEN ' (' || cik10 || ') (Filer)'
                WHEN k % 3 = 1 THEN ' (' || {letters_sql('c_custkey')} || ')'
                ELSE ' (' || cik10 || ')' END AS title,
         CASE WHEN k % 4 = 0 THEN 'https://www.sec.gov/Archives/edgar/data/' || cik || '/' || acc18 || '/'
                   || substr(acc18, 1, 10) || '-' || substr(acc18, 11, 2) || '-' || substr(acc18, 13, 6) || '-index.htm'
              WHEN k % 4 = 1 THEN 'https://www.sec.gov/Archives/edgar/data/' || cik || '/' || acc18 || '/'
              WHEN k % 4 = 2 THEN 'https://www.sec.gov/cgi-bin/browse-edgar?action=view&cik=' || cik || '&accession_number='
                   || substr(acc18, 1, 10) || '-' || substr(acc18, 11, 2) || '-' || substr(acc18, 13, 6)
              ELSE 'https://www.sec.gov/cgi-bin/browse-edgar?action=getcurrent' END AS link,
         CASE WHEN k % 4 = 1 THEN 'urn:tag:sec.gov,2008:accession-number='
                   || substr(acc18, 1, 10) || '-' || substr(acc18, 11, 2) || '-' || substr(acc18, 13, 6)
              ELSE 'urn:tag:sec.gov,2008:entry=' || CAST(k AS VARCHAR) END AS entry_id,
         pub AS published_ts,
         CASE WHEN k % 31 = 0 THEN ''
              WHEN k % 4 = 2 THEN strftime(pub - INTERVAL 5 HOUR, '%a, %d %b %Y %H:%M:%S') || ' -0500'
              WHEN k % 2 = 0 THEN strftime(pub, '%a, %d %b %Y %H:%M:%S') || ' +0000'
              ELSE strftime(pub, '%Y-%m-%dT%H:%M:%S') || 'Z' END AS published_raw,
         strftime(pub, '%Y-%m-%dT%H:%M:%S') || 'Z' AS updated,
         k % 5 <> 0 AS in_primary, k % 5 IN (0, 1) AS in_backup, k AS feed_rank,
         o_custkey AS custkey, c_name, o_totalprice, o_orderpriority
  FROM filings_base)"""

FEED_ENTRIES_FX = f"""
feed_entries_fx AS (
  SELECT k, title, link, entry_id, published_raw, updated, 'primary' AS feed, k AS feed_rank
  FROM filings_fx WHERE in_primary
  UNION ALL
  SELECT k, title, link, entry_id, published_raw, updated, 'backup' AS feed, k + {FEED_OFFSET} AS feed_rank
  FROM filings_fx WHERE in_backup)"""

LEDGER_FX = """
ledger_fx AS (
  SELECT accession_true AS accession FROM filings_fx
  WHERE k % 4 <> 3 AND (k % 10 < 3 OR k % 1000 >= 960))"""

ISSUERS_FX = f"""
issuers_fx AS (
  SELECT c_custkey AS ordinal, c_custkey AS cik_str,
         CASE WHEN c_custkey % 11 <> 0 THEN {letters_sql('c_custkey')} END AS ticker,
         upper(c_name) AS title
  FROM customer)"""

SUBMISSIONS_FX = f"""
submissions_fx AS (
  SELECT cik, accession_true AS accession,
         CASE WHEN k % 3 = 0 THEN '1.01,9.01' WHEN k % 3 = 1 THEN '5.02' ELSE '' END AS items,
         CASE WHEN custkey % 11 <> 0 THEN {letters_sql('custkey')} END AS first_ticker
  FROM filings_fx WHERE k % 13 <> 0)"""

SUB_TICKERS_FX = f"""
sub_tickers_fx AS (
  SELECT CAST(c_custkey AS VARCHAR) AS cik,
         CASE WHEN c_custkey % 11 <> 0 THEN {letters_sql('c_custkey')} END AS first_ticker
  FROM customer)"""

NAMES_FX = """
names_fx AS (
  SELECT p_partkey AS name_id,
         upper(p_name) || CASE p_partkey % 4 WHEN 0 THEN ' INC' WHEN 1 THEN ' CORP' WHEN 2 THEN ' LTD'
                                             ELSE ' CO' END AS company
  FROM part)"""

NAME_QUOTES_FX = """
name_quotes_fx AS (
  SELECT ticker, CASE WHEN sz > 10 THEN rp / 10 ELSE 0.0 END AS regular_market_price
  FROM (SELECT upper(split_part(p_name, ' ', 1)) AS ticker, arg_min(p_size, p_partkey) AS sz,
               arg_min(p_retailprice, p_partkey) AS rp
        FROM part GROUP BY 1) q)"""

MARKET_FX = f"""
market_fx AS (
  SELECT c_custkey AS custkey,
         CASE WHEN c_custkey % 11 <> 0 THEN {letters_sql('c_custkey')} END AS ticker,
         CASE WHEN c_custkey % 17 <> 0 THEN p_retailprice / 10 END AS current_price,
         CASE WHEN c_custkey % 2 = 1 THEN p_retailprice / 10 END AS regular_market_price,
         CASE WHEN c_custkey % 3 <> 0 THEN p_retailprice / 10 * 0.97::DOUBLE END AS previous_close,
         p_retailprice / 10 * 0.97::DOUBLE AS regular_market_previous_close,
         CAST((c_custkey % 97 + 1) * 100000 AS DOUBLE) AS shares_outstanding,
         CASE WHEN c_custkey % 13 <> 0
              THEN CAST((c_custkey % 97 + 1) * 100000 AS DOUBLE) * (p_retailprice / 10 * 0.97::DOUBLE) END AS market_cap,
         CASE WHEN c_custkey % 19 <> 0 THEN CAST((c_custkey * 7919 % 400) * 1000 AS DOUBLE) END AS avg_volume,
         CAST((c_custkey * 104729 % 2000) * 1000 AS DOUBLE) AS volume,
         (c_custkey % 30) / 100 AS short_percent,
         (c_custkey % 101) / 100 AS institutional_pct,
         CAST((c_custkey % 41) - 20 AS DOUBLE) AS week_change_pct,
         CASE WHEN c_custkey % 23 = 0 THEN 'no data' END AS error
  FROM customer JOIN part ON c_custkey % (SELECT count(*) FROM part) = p_partkey)"""




def _pick_sql(k: str, modulus: int, options) -> str:
    whens = " ".join(f"WHEN {k} % {modulus} = {i} THEN {o}" for i, o in enumerate(options))
    return f"(CASE {whens} END)"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _filing_docs_sql():
    from dealflow.plans.fx_filings import KEYWORD_SENTENCES, MONEY_SENTENCES, NBSP
    tick = letters_sql("custkey")
    n = "CAST(k % 900 + 1 AS VARCHAR)"
    l3 = _pick_sql("k", 5, [f"'Trading Symbol: ' || {tick}", f"'(NASDAQ: ' || {tick} || ')'", "'Trading Symbol:'",
                            f"'Trading{NBSP}Symbol:{NBSP}' || {tick}"])
    l4 = _pick_sql("k", 3, ["'Item 1.01 Entry into a Material Definitive Agreement'",
                            "'Item 5.02 Departure of Directors'", f"'ITEM' || chr({ord(NBSP)}) || '1.01 Entry'"])
    l5 = _pick_sql("k", len(KEYWORD_SENTENCES) + 1, [_q(s) for s in KEYWORD_SENTENCES])
    l6 = _pick_sql("k", len(MONEY_SENTENCES) + 1, [f" || {n} || ".join(_q(p) for p in s.split("{n}")) for s in MONEY_SENTENCES])
    return f"""
filing_docs_fx AS (
  SELECT k, cik, accession_true AS accession,
         CASE WHEN k % 29 = 0 THEN '' ELSE concat_ws(chr(10), '<SEC-HEADER>',
              'COMPANY CONFORMED NAME:   ' || upper(c_name), {l3}, {l4}, {l5}, {l6}, body,
              'Item 9.01 Exhibits', 'SIGNATURES') END AS raw
  FROM filings_fx f LEFT JOIN (SELECT doc_id, text AS body FROM documents) d
    ON f.k % (SELECT count(*) FROM documents) = d.doc_id)"""


def _analysis_sql():
    filer = f"(CASE WHEN custkey % 11 <> 0 THEN {letters_sql('custkey')} END)"

    def arr(m, prefix):
        return f"list_transform(range(k % {m}), lambda i: '{prefix}' || CAST(i + 1 AS VARCHAR) || ' of filing ' || CAST(k AS VARCHAR))"

    return f"""
analysis_fx AS (
  SELECT k, accession_true AS accession, {filer} AS filer_ticker,
         CASE WHEN k % 37 <> 0 THEN CAST(k % 10 + 1 AS DOUBLE) END AS impact_score,
         CAST((k * 3) % 10 + 1 AS DOUBLE) AS confidence,
         {_pick_sql('k', 3, ["'target'", "'acquirer'", "'unknown'"])} AS filer_role,
         k % 2 = 0 AS is_full_acquisition,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'all-cash' WHEN '2-HIGH' THEN 'all-stock'
              WHEN '3-MEDIUM' THEN 'mixed' WHEN '4-NOT SPECIFIED' THEN 'undisclosed' ELSE '' END AS deal_structure,
         {_pick_sql('k', 4, ["'acquisition'", "'merger'", "'partnership'", "'contract'"])} AS deal_type,
         CASE WHEN k % 7 = 0 THEN NULL WHEN k % 10 = 0 THEN {filer}
              ELSE {letters_sql('(custkey * 31 + 7) % (SELECT count(*) FROM customer)')} END AS target_ticker,
         CASE WHEN k % 8 = 0 THEN NULL WHEN k % 10 = 5 THEN {filer}
              ELSE {letters_sql('(custkey * 17 + 3) % (SELECT count(*) FROM customer)')} END AS acquirer_ticker,
         CASE WHEN k % 6 <> 0 THEN o_totalprice / 1000 END AS offer_price_per_share,
         CASE WHEN k % 9 <> 0 THEN o_totalprice * 1000 END AS deal_value_usd,
         CASE WHEN k % 5 <> 0 THEN CAST((k % 120) - 10 AS DOUBLE) END AS premium_pct,
         CASE WHEN k % 4 <> 3 THEN 'TARGET CO ' || CAST(k AS VARCHAR) END AS target_company,
         'BUYER ' || CAST(k % 97 AS VARCHAR) AS acquirer,
         {_pick_sql('k', 5, ["'$' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || 'K'", "'undisclosed'",
                             "NULL", "''", "'None'"])} AS deal_value,
         CASE WHEN k % 3 = 0 THEN 'regex_confirmed' ELSE 'document_only' END AS deal_value_source,
         {_pick_sql('k', 4, ["'high'", "'medium'", "'low'", "'none'"])} AS short_squeeze_risk,
         {arr(6, 'point ')} AS key_points, {arr(4, 'risk ')} AS risks, {arr(5, 'peer ')} AS sympathy_plays,
         k % 13 = 0 AS leak_detected,
         'Reasoning for filing ' || CAST(k AS VARCHAR) || '. ' || coalesce(vbody, '') AS reasoning,
         'Deal headline ' || CAST(k AS VARCHAR) AS alert_headline,
         coalesce(vbody, '') || CASE WHEN k % 11 = 0 THEN ' $5,000' WHEN k % 11 = 1 THEN ' 12.5%' ELSE '' END
           AS analyst_verdict,
         published_raw, title, link
  FROM filings_fx f LEFT JOIN (SELECT doc_id, text AS vbody FROM documents) d
    ON f.k % (SELECT count(*) FROM documents) = d.doc_id)"""


FILING_DOCS_FX = _filing_docs_sql()
ANALYSIS_FX = _analysis_sql()
