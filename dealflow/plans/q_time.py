"""Registered queries: trailing changes, session calendar, local time, payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from dealflow.functions import timefns as tf
from dealflow.functions.numeric import truthy
from dealflow.operators import enrich, gates, route, score
from dealflow.operators.lookup import lookup
from dealflow.operators.bars import daily_bars
from dealflow.plans import fixtures as fx
from dealflow.plans import fx_filings as fxf
from dealflow.plans import oracle as osql
from dealflow.plans import ox_ids as oi
from dealflow.plans import ox_text as ot
from dealflow.plans.q_filings import (ALERT_SIGNAL_SQL, DOCS_SQL, ROLES_SQL, SNAP_SQL, _label_sql, _priority_sql,
                                      LIQ_SQL, cap_label_sql, routed_frame, sql)
from dealflow.plans.registry import register
from dealflow.functions import text as T


@register("trailing_change", lambda: "WITH " + ",".join([osql.BARS_FX, osql.DAILY_FX]) + """
, w AS (
  SELECT ticker, d, close,
         count(*) OVER lb AS n, first_value(close) OVER lb AS first_close,
         lag(close, 4) OVER (PARTITION BY ticker ORDER BY d) AS lag_close
  FROM daily_fx
  WINDOW lb AS (PARTITION BY ticker ORDER BY (d - DATE '1970-01-01') RANGE BETWEEN 29 PRECEDING AND CURRENT ROW))
SELECT ticker, CAST(d AS VARCHAR) AS d, close, n AS rows_in_lookback,
       CASE WHEN n >= 2 AND (CASE WHEN n >= 5 THEN lag_close ELSE first_close END) IS NOT NULL
                 AND (CASE WHEN n >= 5 THEN lag_close ELSE first_close END) <> 0
            THEN round((close - (CASE WHEN n >= 5 THEN lag_close ELSE first_close END))
                       / (CASE WHEN n >= 5 THEN lag_close ELSE first_close END) * 100, 2) ELSE 0.0 END AS week_change_pct,
       CASE WHEN n >= 2 AND first_close IS NOT NULL AND first_close <> 0
            THEN round((close - first_close) / first_close * 100, 2) ELSE 0.0 END AS month_change_pct
FROM w""")
def trailing_change(spark, sf_dir):
    """E3 + W1: week and month change of the daily close per ticker and day."""
    t = enrich.trailing_changes(daily_bars(fx.bars_fx(spark, sf_dir)))
    return t.select("ticker", F.col("d").cast("string").alias("d"), "close", "rows_in_lookback",
                    "week_change_pct", "month_change_pct")


@register("session_calendar", lambda: sql(query=f"""
SELECT k, {osql.filing_context_sql('published_ts')} AS filing_context,
       CAST({osql.next_session_sql('published_ts')} AS VARCHAR) AS session_date
FROM filings_fx"""))
def session_calendar(spark, sf_dir):
    """P10 + P11 for every fixture filing time (all weekdays and hours)."""
    f = fxf.filings_fx(spark, sf_dir)
    ts = F.col("published_ts")
    return f.select("k", tf.filing_context(ts).alias("filing_context"),
                    tf.next_session_date(ts).cast("string").alias("session_date"))


def _local_v1_sql(ts):
    m, d = f"month({ts})", f"day({ts})"
    summer = f"(({m} > 3 AND {m} < 10) OR ({m} = 3 AND {d} >= 25) OR ({m} = 10 AND {d} < 25))"
    return (f"strftime({ts} + (CASE WHEN {summer} THEN 2 ELSE 1 END) * INTERVAL 1 HOUR, '%Y-%m-%d o %H:%M:%S ') || "
            f"CASE WHEN {summer} THEN 'CEST' ELSE 'CET' END")


def _local_v2_sql(ts):
    summer = f"(month({ts}) > 3 AND month({ts}) < 10)"
    return (f"strftime({ts} + (CASE WHEN {summer} THEN 2 ELSE 1 END) * INTERVAL 1 HOUR, '%Y-%m-%d %H:%M ') || "
            f"CASE WHEN {summer} THEN 'CEST' ELSE 'CET' END")


@register("local_time", lambda: sql(query=f"""
SELECT k, {_local_v1_sql('published_ts')} AS local_v1, {_local_v2_sql('published_ts')} AS local_v2,
       strftime(timezone('Europe/Warsaw', timezone('UTC', published_ts)), '%Y-%m-%d %H:%M') AS local_iana
FROM filings_fx"""))
def local_time(spark, sf_dir):
    """Both fixed-offset approximations and the IANA zone."""
    f = fxf.filings_fx(spark, sf_dir)
    ts = F.col("published_ts")
    return f.select("k", tf.local_time_v1(ts).alias("local_v1"), tf.local_time_v2(ts).alias("local_v2"),
                    tf.local_time_iana(ts).alias("local_iana"))


REQUEST_SQL = lambda: [SNAP_SQL, DOCS_SQL, f"""
snap1 AS (SELECT *, {cap_label_sql('cap')} AS cap_formatted FROM (
            SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY custkey) AS rn FROM snap WHERE ticker IS NOT NULL) z
          WHERE rn = 1)""", f"""
sect AS (SELECT k, {ot.company_sql('clean')} AS company, {ot.section_v2_sql('clean')} AS section FROM docs_clean)""", f"""
req AS (
  SELECT a.k, d.company, d.section,
         CASE WHEN s.ticker IS NOT NULL AND s.error IS NULL THEN concat_ws(' | ', 'ticker ' || s.ticker,
           'price ' || coalesce(CAST(s.price AS VARCHAR), 'unknown'), 'capitalisation ' || s.cap_formatted,
           CASE WHEN s.shares_outstanding IS NOT NULL AND s.shares_outstanding <> 0
                THEN 'shares ' || format('{{:,}}', CAST(round(s.shares_outstanding) AS BIGINT)) ELSE 'shares unknown' END,
           printf('volume %.1fx', coalesce(s.volume_spike, 1.0)), printf('week %+.1f%%', coalesce(s.week_change_pct, 0.0)),
           printf('short %.1f%% of float', coalesce(s.short_percent, 0.0) * 100),
           printf('institutions %.0f%%', coalesce(s.institutional_pct, 0.0) * 100)) ELSE 'no market data' END AS market_line,
         {ot.deal_value_sql('d.section', True)} AS deal_value_regex,
         CASE WHEN s.ticker IS NOT NULL AND coalesce(s.short_percent, 0.0) > {score.SHORT_NOTE_LEVEL}
              THEN printf('high short interest: %.1f%% of float', s.short_percent * 100) END AS short_note
  FROM analysis_fx a LEFT JOIN sect d ON a.k = d.k LEFT JOIN snap1 s ON a.filer_ticker = s.ticker
  WHERE s.ticker IS NULL OR {LIQ_SQL} = 'OK')"""]  # noqa: E731


def section_facts(spark, sf_dir, rows, alerts=None):
    """``rows`` (by ``k``) with the company, section and value found in their filings' documents; for ``alerts`` (which
    hold the filings' numbers ``k``) with the texts of their analysis instead of the section."""
    d = fxf.filing_docs_fx(spark, sf_dir, rows, analysis=alerts is not None, needed=alerts)
    d = T.Scans(d, "clean", *(["section"] if alerts is not None else []))
    d = T.with_clean_html(d, "raw", "clean")
    d = T.with_company_name(d, "clean", "company", 50).withColumn("company", F.when(F.col("raw").isNotNull(), F.col("company")))
    d = T.with_section_v2(d, "clean", "section", T.SECTION_CHARS_V2)
    return T.with_deal_value(d, "section", "deal_value_regex").run().drop("raw")


def request_frame(spark, sf_dir):
    """T13 inputs of the filings that pass the liquidity gate (F5; an unlisted filer passes): section, the value
    found in it and the filer's market snapshot.  Only their documents are cleaned."""
    a = fxf.analysis_fx(spark, sf_dir).select("k", "filer_ticker")
    snap = enrich.first_snapshot(fxf.market_fx(spark, sf_dir)).drop("custkey")
    a = lookup(a, snap.withColumn("_t", F.col("ticker")), [(F.col("filer_ticker"), "_t")], "k")
    reason = gates.liquidity_reason(F.col("cap"), F.col("avg_volume"), F.col("price"))
    a = a.where(F.col("ticker").isNull() | (reason == "OK"))
    return score.scoring_requests(section_facts(spark, sf_dir, a))


@register("score_requests", lambda: sql(*REQUEST_SQL(), query="""
SELECT k, company, length(section) AS section_len, market_line, short_note,
       CASE WHEN deal_value_regex IS NOT NULL AND deal_value_regex <> 0
            THEN 'value in text: $' || format('{:,}', CAST(round(deal_value_regex) AS BIGINT))
            ELSE 'no value found in text' END AS value_anchor
FROM req"""))
def score_requests(spark, sf_dir):
    """The scoring request of every filing that passes the gate."""
    r = request_frame(spark, sf_dir)
    return r.select("k", "company", F.length("section").cast("bigint").alias("section_len"), "market_line", "short_note",
                    "value_anchor")


def length_scorer(batches):
    """A deterministic stand-in for a model: answers in JSON, scored by the lengths of what it was told."""
    import json

    import pandas as pd

    for rows in batches:
        answers = []
        for company, section, line, note in zip(rows["company"], rows["section"], rows["market_line"], rows["short_note"]):
            n = len(section) if isinstance(section, str) else 0
            answers.append("Answer: " + json.dumps({
                "impact_score": 1 + n % 10, "confidence": 1 + len(line) % 10, "filer_role": "target" if n % 2 else "acquirer",
                "is_full_acquisition": n % 3 == 0, "target_company": company, "key_points": ["length %d" % n, line],
                "short_squeeze_risk": "high" if isinstance(note, str) else "none"}) if n else "nothing to read")
        yield pd.DataFrame({"k": rows["k"], "model_text": answers})


@register("batch_scorer", lambda: sql(*REQUEST_SQL(), query="""
SELECT k, CAST(1 + n % 10 AS DOUBLE) AS impact_score, CAST(1 + length(market_line) % 10 AS DOUBLE) AS confidence,
       CASE WHEN n % 2 = 1 THEN 'target' ELSE 'acquirer' END AS filer_role, n % 3 = 0 AS is_full_acquisition,
       company AS target_company, market_line AS second_point, CASE WHEN short_note IS NOT NULL THEN 'high' ELSE 'none' END
         AS short_squeeze_risk
FROM (SELECT *, length(section) AS n FROM req) r WHERE n > 0"""))
def batch_scorer(spark, sf_dir):
    """R1 + T12: requests through a batch scorer, its answers parsed with the whole analysis schema."""
    r = request_frame(spark, sf_dir).select("k", "company", "section", "market_line", "short_note")
    out = score.apply_scorer(r, length_scorer, "k bigint, model_text string")
    m = out.select("k", score.parse_model_output(F.col("model_text"), score.ANALYSIS, "impact_score").alias("m"))
    return m.where(F.col("m").isNotNull()).select(
        "k", "m.impact_score", "m.confidence", "m.filer_role", "m.is_full_acquisition", "m.target_company",
        F.try_element_at("m.key_points", F.lit(2)).alias("second_point"), "m.short_squeeze_risk")


def _alert_payload_sql() -> str:
    """Twin of ``route.alert_embed`` under the reference's caps; names and values of the fields as one string each."""
    tr = lambda c: f"({c} IS NOT NULL AND {c} <> 0)"
    has = lambda c: f"({c} IS NOT NULL AND {c} <> '')"
    bullets = lambda c, n: f"array_to_string(list_transform({c}[1:{n}], lambda x: '• ' || x), chr(10))"
    paren = lambda c: f"(CASE WHEN {has(c)} THEN ' (' || {c} || ')' ELSE '' END)"
    desc = f"""concat_ws(chr(10),
      CASE WHEN {has('alert_headline')} THEN '*' || alert_headline || '*' END,
      'Target: ' || coalesce(target_name, 'Unknown') || {paren('tgt_ticker')} || ' | Acquirer: '
        || coalesce(acquirer, 'Unknown') || {paren('acq_ticker')},
      CASE WHEN dv_ok THEN 'Value: ' || dv || (CASE WHEN deal_value_source = 'regex_confirmed' THEN ' (confirmed)' ELSE '' END)
           WHEN {tr('deal_value_regex')} THEN 'Value: $' || format('{{:,}}', CAST(round(deal_value_regex) AS BIGINT)) || ' (regex)' END,
      CASE WHEN {tr('offer_price_per_share')} AND {tr('tgt_price')}
           THEN 'Offer: $' || CAST(offer_price_per_share AS VARCHAR) || ' | Price: $' || CAST(tgt_price AS VARCHAR) END,
      CASE WHEN premium_pct_checked IS NOT NULL THEN printf('Premium: +%.1f%%', premium_pct_checked) END,
      CASE WHEN upside_pct IS NOT NULL THEN printf('Upside to offer: %+.1f%%', upside_pct) END,
      CASE WHEN short_squeeze_risk IN ('high', 'medium') THEN printf('Short squeeze: %s (%.1f%% of float)',
           upper(short_squeeze_risk), coalesce(tgt_short_percent, 0.0) * 100) END,
      'Signal: ' || ({ALERT_SIGNAL_SQL}),
      'Score ' || coalesce(CAST(impact_score AS VARCHAR), '0') || '/10 | Confidence ' || coalesce(CAST(confidence AS VARCHAR), '0')
        || '/10 | ' || coalesce(nullif(deal_structure, ''), 'N/A'))"""
    target = f"""concat_ws(chr(10), 'Valuation: ' || tgt_cap_formatted,
      CASE WHEN {tr('tgt_price')} THEN 'Price: $' || CAST(tgt_price AS VARCHAR) END,
      CASE WHEN tgt_volume_spike > 1.5 THEN printf('Volume: %.1fx avg', tgt_volume_spike)
           || (CASE WHEN volume_label IS NOT NULL THEN ' (' || volume_label || ')' ELSE '' END) END,
      CASE WHEN tgt_week_change_pct IS NOT NULL THEN printf('Week: %+.2f%%', tgt_week_change_pct)
           || (CASE WHEN week_label IS NOT NULL THEN ' (already moved)' ELSE '' END) END,
      CASE WHEN short_label IS NOT NULL THEN printf('Short: %.1f%% of float (', tgt_short_percent * 100) || short_label || ')' END,
      CASE WHEN institutions_label IS NOT NULL
           THEN printf('Institutions: %.0f%% (', tgt_institutional_pct * 100) || institutions_label || ')' END)"""
    acquirer = f"""concat_ws(chr(10), 'Valuation: ' || acq_cap_formatted, 'Price: $' || CAST(acq_price AS VARCHAR),
      CASE WHEN acq_week_change_pct IS NOT NULL THEN printf('Week: %+.2f%% (', acq_week_change_pct)
           || (CASE WHEN acq_week_change_pct >= 0 THEN 'market_accepts' ELSE 'market_doubts' END) || ')' END,
      CASE WHEN cap_ratio IS NOT NULL THEN printf('Acquirer/target: %.1fx valuation', cap_ratio) END)"""
    private = """'Company: ' || target_company || chr(10) || 'Private company, not listed'
      || (CASE WHEN dv_ok THEN chr(10) || 'Value: ' || dv ELSE '' END)"""
    fields = [
        ("Target data", f"CASE WHEN tgt_ticker IS NOT NULL AND tgt_error IS NULL THEN {target} "
                        f"WHEN {has('target_company')} THEN {private} END"),
        ("Acquirer data", f"CASE WHEN acq_ticker IS NOT NULL AND acq_error IS NULL AND {tr('acq_price')} THEN {acquirer} END"),
        ("Analyst view", f"CASE WHEN verdict <> '' THEN {ot.truncate_sql('verdict', route.CAP_FIELD_TEXT)} END"),
        ("Key points", f"CASE WHEN len(key_points) > 0 THEN "
                       f"{ot.truncate_sql('(' + bullets('key_points', route.CAP_KEY_POINTS) + ')', route.CAP_FIELD_TEXT)} END"),
        ("Risks", f"CASE WHEN len(risks) > 0 THEN {bullets('risks', route.CAP_RISKS)} END"),
        ("Related companies", f"CASE WHEN len(sympathy_plays) > 0 THEN {bullets('sympathy_plays', route.CAP_SYMPATHY)} END"),
        ("Leak detected", f"CASE WHEN leak_detected THEN substr(reasoning, 1, {route.CAP_REASONING}) END"),
        ("Form", "'8-K · Item 1.01' || chr(10) || coalesce(link, '#')"),
        ("Published (8-K)", _local_v2_sql("published_ts"))]
    names = ", ".join(f"CASE WHEN f{i} IS NOT NULL THEN '{n}' END" for i, (n, _) in enumerate(fields))
    values = ", ".join(f"f{i}" for i in range(len(fields)))
    colors = " ".join(f"WHEN '{p}' THEN {c}" for p, c in route.PRIORITY_COLOR.items())
    verdict = ot.strip_sql("coalesce(analyst_verdict, '')")
    return sql(SNAP_SQL, ROLES_SQL, DOCS_SQL, f"""
facts AS (SELECT k, {ot.company_sql('clean')} AS company, {ot.section_v2_sql('clean')} AS section FROM docs_clean)""", f"""
p0 AS (SELECT r.*, d.company, {ot.deal_value_sql('d.section', True)} AS deal_value_regex,
              {oi.parse_published_sql('published_raw')} AS published_ts, {_priority_sql('impact_score')} AS priority
       FROM roles2 r LEFT JOIN facts d ON r.k = d.k)""", f"""
p1 AS (SELECT *, coalesce(nullif(tgt_ticker, ''), nullif(target_ticker, ''), nullif(acq_ticker, '')) AS title_tick,
              coalesce(nullif(target_company, ''), company) AS target_name, trim(coalesce(deal_value, '')) AS dv,
              trim(coalesce(deal_value, '')) <> '' AND lower(trim(coalesce(deal_value, ''))) NOT IN ('null', 'undisclosed', 'none') AS dv_ok,
              CASE WHEN regexp_matches({verdict}, {ot.q(ot.re2_guard())}) THEN '' ELSE {verdict} END AS verdict,
              {_label_sql('tgt_volume_spike', 'tgt_short_percent', 'tgt_institutional_pct', 'tgt_week_change_pct')}
       FROM p0 WHERE priority IS NOT NULL)""", f"""
p2 AS (SELECT *, {', '.join(f'({v}) AS f{i}' for i, (_, v) in enumerate(fields))} FROM p1)""", query=f"""
SELECT k, priority, priority || ' M&A - ' || coalesce(title_tick, target_name, 'Unknown') AS title, {desc} AS description,
       CASE priority {colors} ELSE 0 END AS color,
       CASE WHEN title_tick IS NOT NULL THEN 'https://www.tradingview.com/symbols/' || title_tick || '/' END AS url,
       concat_ws('|', {names}) AS field_names, concat_ws(' ## ', {values}) AS field_values
FROM p2""")


@register("alert_payload", _alert_payload_sql)
def alert_payload(spark, sf_dir):
    """R6, R7, E9, S11 (v2 layout, the reference's caps): title, text, colour, link and fields of each routed
    alert.  Only routed filings' documents are cleaned."""
    r = gates.routed(routed_frame(spark, sf_dir, texts=False))
    some = fxf.analysis_fx(spark, sf_dir, texts=False).where(route.priority(F.col("impact_score")).isNotNull())
    e = route.alert_embed(section_facts(spark, sf_dir, r, some), route.V2_CAPS)
    joined = lambda part, sep: F.array_join(F.transform("fields", lambda f: f[part]), sep)
    return e.select("k", "priority", "title", "description", "color", "url", joined("name", "|").alias("field_names"),
                    joined("value", " ## ").alias("field_values"))


def _alert_v1_sql() -> str:
    """Twin of ``route.alert_embed_v1`` under the reference's caps, over the columns of ``v1_frame``."""
    tr = lambda c: f"({c} IS NOT NULL AND {c} <> 0)"
    has = lambda c: f"({c} IS NOT NULL AND {c} <> '')"
    bullets = lambda c, n: f"CASE WHEN len({c}) > 0 THEN array_to_string(list_transform({c}[1:{n}], lambda x: '• ' || x), chr(10)) END"  # noqa: E731,E501
    listed = "(tgt_ticker IS NOT NULL AND tgt_error IS NULL)"
    desc = f"""concat_ws(chr(10), coalesce(target_company, company, 'Unknown') || ' → ' || coalesce(acquirer, 'Unknown'),
      CASE WHEN {has('deal_value')} THEN 'Deal value: ' || deal_value END,
      CASE WHEN {tr('premium_pct')} THEN 'Premium: ' || CAST(premium_pct AS VARCHAR) || '%'
           || (CASE WHEN {listed} AND {tr('tgt_price')} THEN ' (from $' || CAST(tgt_price AS VARCHAR) || ')' ELSE '' END) END,
      CASE WHEN {tr('offer_price_per_share')} THEN 'Offer price: $' || CAST(offer_price_per_share AS VARCHAR) || '/share' END,
      CASE WHEN upside_pct IS NOT NULL THEN 'Upside to offer: ' || CAST(upside_pct AS VARCHAR) || '%' END,
      'Impact: ' || coalesce(CAST(impact_score AS VARCHAR), '0') || '/10', 'Verdict: ' || coalesce(verdict, 'N/A'),
      'Short term: ' || coalesce(short_term_move, 'N/A'),
      'Confidence: ' || coalesce(CAST(confidence AS VARCHAR), '0') || '/10',
      CASE WHEN {has('deal_structure')} THEN 'Structure: ' || deal_structure END)"""
    market = f"""concat_ws(chr(10), CASE WHEN {has('tgt_cap_formatted')} THEN 'Market cap: ' || tgt_cap_formatted END,
      CASE WHEN {tr('tgt_price')} THEN 'Price: $' || CAST(tgt_price AS VARCHAR) END,
      CASE WHEN tgt_volume_spike > 2 THEN printf('Volume spike: %.1fx normal', tgt_volume_spike) END,
      CASE WHEN {tr('tgt_week_change_pct')} THEN printf('Week: %+.2f%%', tgt_week_change_pct) END,
      CASE WHEN {tr('tgt_institutional_pct')} THEN printf('Institutions: %.1f%%', tgt_institutional_pct * 100) END)"""
    warnings = f"""concat_ws(chr(10), CASE WHEN leak_detected THEN 'Leak detected: ' || coalesce(leak_reasoning, 'Unusual price action') END,
      CASE WHEN {has('liquidity_warning')} THEN 'Liquidity: ' || liquidity_warning END)"""
    n = route.V1_CAPS
    fields = [
        ("Market data", f"CASE WHEN {listed} THEN nullif({market}, '') END"),
        ("Premium calculation", f"substr(nullif(premium_calculation, ''), 1, {n['text']})"),
        ("Strategic rationale", f"substr(nullif(strategic_rationale, ''), 1, {n['text']})"),
        ("Key points", bullets("key_points", n["key_points"])), ("Risks", bullets("risks", n["risks"])),
        ("Trading warnings", f"nullif({warnings}, '')"), ("Sympathy plays", bullets("sympathy_plays", n["sympathy"]))]
    names = ", ".join(f"CASE WHEN f{i} IS NOT NULL THEN '{x}' END" for i, (x, _) in enumerate(fields))
    values = ", ".join(f"f{i}" for i in range(len(fields)))
    colors = " ".join(f"WHEN '{p}' THEN {c}" for p, c in route.PRIORITY_COLOR.items())
    return sql(SNAP_SQL, ROLES_SQL, f"""
v0 AS (SELECT *, {oi.parse_published_sql('published_raw')} AS published_ts, {_priority_sql('impact_score')} AS priority,
              CASE WHEN k % 3 <> 0 THEN title END AS company, CASE WHEN k % 4 <> 0 THEN 'hold for ' || CAST(k % 7 AS VARCHAR) || ' days' END
                AS verdict,
              CASE WHEN upside_pct > 5 THEN 'up' WHEN upside_pct < -5 THEN 'down' END AS short_term_move,
              CASE WHEN {tr('tgt_price')} THEN CAST(offer_price_per_share AS VARCHAR) || ' against ' || CAST(tgt_price AS VARCHAR) END
                AS premium_calculation, reasoning AS strategic_rationale, CASE WHEN k % 2 = 0 THEN alert_headline END AS leak_reasoning,
              CASE WHEN tgt_volume_spike < 0.5 THEN 'thin volume' END AS liquidity_warning FROM roles2)""", f"""
v1 AS (SELECT *, {', '.join(f'({v}) AS f{i}' for i, (_, v) in enumerate(fields))} FROM v0 WHERE priority IS NOT NULL)""", query=f"""
SELECT k, priority, priority || ' M&A - Item 1.01' AS title, {desc} AS description, CASE priority {colors} END AS color,
       concat_ws('|', {names}) AS field_names, concat_ws(' ## ', {values}) AS field_values,
       coalesce({_local_v1_sql('published_ts')}, '') AS footer, nullif(link, '') AS url,
       'View ' || nullif(tgt_ticker, '') || ' Chart' AS author, '{route.V1_CHART}' || nullif(tgt_ticker, '') AS author_url
FROM v1""")


def v1_frame(spark, sf_dir):
    """Routed filings with the further answers that the v1 layout shows, derived from the given columns."""
    k = F.col("k")
    r = gates.routed(routed_frame(spark, sf_dir, texts=False))
    return fxf.with_analysis_texts(spark, sf_dir, r).select(
        "*", F.when(k % 3 != 0, F.col("title")).alias("company"),
        F.when(k % 4 != 0, F.concat(F.lit("hold for "), (k % 7).cast("string"), F.lit(" days"))).alias("verdict"),
        F.when(F.col("upside_pct") > 5, F.lit("up")).when(F.col("upside_pct") < -5, F.lit("down")).alias("short_term_move"),
        F.when(truthy(F.col("tgt_price")), F.concat(F.col("offer_price_per_share").cast("string"), F.lit(" against "),
                                                   F.col("tgt_price").cast("string"))).alias("premium_calculation"),
        F.col("reasoning").alias("strategic_rationale"), F.when(k % 2 == 0, F.col("alert_headline")).alias("leak_reasoning"),
        F.when(F.col("tgt_volume_spike") < 0.5, F.lit("thin volume")).alias("liquidity_warning"))


@register("alert_payload_v1", _alert_v1_sql)
def alert_payload_v1(spark, sf_dir):
    """R6, R7, S11 (v1 layout, the reference's caps): no filing document is read for it."""
    e = route.alert_embed_v1(v1_frame(spark, sf_dir), route.V1_CAPS)
    joined = lambda part, sep: F.array_join(F.transform("fields", lambda f: f[part]), sep)
    return e.select("k", "priority", "title", "description", "color", joined("name", "|").alias("field_names"),
                    joined("value", " ## ").alias("field_values"), "footer", "url", "author", "author_url")
