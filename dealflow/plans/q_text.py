"""Registered queries: text jobs over documents, filing documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from dealflow.functions import text as T
from dealflow.functions.numeric import rnd
from dealflow.plans import fx_filings as fxf
from dealflow.plans import ox_text as ot
from dealflow.plans.q_filings import BASE, DOCS_SQL, docs_clean, sql
from dealflow.plans.registry import register
from dealflow.sources.tables import table


@register("item_filter", lambda: sql(query=f"""
SELECT k, length(raw) = 0 AS is_empty,
       contains(lower(raw), 'item 1.01') OR contains(lower(raw), 'item 1.1') AS item_v1,
       regexp_matches(raw, {ot.q('(?i)item' + T.WS_RE2 + '*1' + chr(92) + '.01')}) AS item_v2
FROM filing_docs_fx"""))
def item_filter(spark, sf_dir):
    """F2 (v1 substring, v2 regex) and F7 (empty document) per filing document."""
    d = fxf.filing_docs_fx(spark, sf_dir)
    raw = F.col("raw")
    return d.select("k", (F.length(raw) == 0).alias("is_empty"), T.has_item_101_v1(raw).alias("item_v1"),
                    T.has_item_101_v2(raw).alias("item_v2"))


@register("keyword_gate", lambda: f"""
SELECT doc_id, {ot.any_pattern_sql('text', T.MA_KEYWORDS_STRONG)} AS strong,
       {ot.any_pattern_sql('text', T.MA_EXCLUSIONS)} AS excluded,
       {ot.any_pattern_sql('text', T.MA_KEYWORDS_WEAK)} AS weak,
       {ot.keyword_gate_sql('text')} AS passes
FROM documents""")
def keyword_gate(spark, sf_dir):
    """F4 over every document's whole text."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    t = F.col("text")
    return d.select("doc_id", T.any_pattern(t, T.MA_KEYWORDS_STRONG).alias("strong"),
                    T.any_pattern(t, T.MA_EXCLUSIONS).alias("excluded"),
                    T.any_pattern(t, T.MA_KEYWORDS_WEAK).alias("weak"), T.keyword_gate(t).alias("passes"))


@register("section_cut_v1", lambda: sql(query=f"""
SELECT k, {ot.section_v1_sql('raw')} AS section, length({ot.section_v1_sql('raw')}) AS section_len
FROM filing_docs_fx"""))
def section_cut_v1(spark, sf_dir):
    """v1 marker cut of the raw document (6,000 characters, as called)."""
    d = fxf.filing_docs_fx(spark, sf_dir).withColumn("section", T.section_v1(F.col("raw"), T.SECTION_CHARS_V1))
    return d.select("k", "section", F.length("section").cast("bigint").alias("section_len"))


@register("section_cut_v2", lambda: sql(DOCS_SQL, query=f"""
SELECT k, {ot.section_v2_sql('clean')} AS section, length({ot.section_v2_sql('clean')}) AS section_len
FROM docs_clean"""))
def section_cut_v2(spark, sf_dir):
    """T1 + T7: v2 pattern cut of the cleaned document (12,000 characters)."""
    d = T.with_section_v2(docs_clean(spark, sf_dir), "clean", "section", T.SECTION_CHARS_V2)
    return d.select("k", "section", F.length("section").cast("bigint").alias("section_len"))


@register("deal_value", lambda: sql(DOCS_SQL, f"""
sec AS (SELECT k, {ot.section_v2_sql('clean')} AS section FROM docs_clean)""", query=f"""
SELECT k, {ot.deal_value_sql('section', True)} AS deal_value_compat,
       {ot.deal_value_sql('section', False)} AS deal_value_fixed
FROM sec"""))
def deal_value(spark, sf_dir):
    """T8 + T9 on the Item 1.01 section: reference reading and bounded unit."""
    d = T.with_section_v2(docs_clean(spark, sf_dir), "clean", "section", T.SECTION_CHARS_V2).select("k", "section")
    d = T.with_deal_value(d, "section", "deal_value_compat", "deal_value_fixed")
    return d.select("k", "deal_value_compat", "deal_value_fixed")


@register("company_name", lambda: sql(DOCS_SQL, query=f"""
SELECT k, {ot.company_sql('raw')} AS company_raw, {ot.company_sql('clean')} AS company_clean FROM docs_clean"""))
def company_name(spark, sf_dir):
    """T3 on the raw (v1) and the cleaned (v2) document."""
    d = docs_clean(spark, sf_dir)
    return d.select("k", T.company_name(F.col("raw"), 50).alias("company_raw"),
                    T.company_name(F.col("clean"), 50).alias("company_clean"))


def _ticker_v1_line_sql(l: str, segment: int | None = T.V1_TICKER_SEGMENT) -> str:
    u = f"upper({l})"
    parts = f"string_split({l}, ':')"
    has_parts = f"(len({parts}) > 1)"
    tok = f"regexp_extract(coalesce({parts}[2], ''), {ot.q('^' + T.WS_RE2 + '*(' + T.NOT_WS_RE2 + '+)')}, 1)"
    clean = f"regexp_replace({tok}, '[,.()]', '', 'g')"
    ok = f"({clean} <> '' AND length({clean}) <= 5)"
    r1 = f"(contains({u}, 'TRADING SYMBOL') OR contains({u}, 'TICKER SYMBOL'))"
    r2 = f"(contains({u}, 'NASDAQ:') OR contains({u}, 'NYSE:'))"
    r3 = f"(contains({u}, '(NASDAQ:') OR contains({u}, '(NYSE:'))"
    start = f"(CASE WHEN contains({u}, '(NASDAQ:') THEN instr({u}, '(NASDAQ:') ELSE instr({u}, '(NYSE:') END)"
    seg = f"substr({l}, {start}, {segment})" if segment else f"substr({l}, {start})"
    t3 = f"regexp_replace({ot.strip_sql(f'split_part(string_split({seg}, chr(58))[2], chr(41), 1)')}, '[,.]', '', 'g')"
    ok3 = f"({t3} <> '' AND length({t3}) <= 5)"
    pot = ot.strip_sql(f"split_part(string_split({l}, '(')[-1], ')', 1)")
    r4 = f"(contains({u}, 'COMPANY') AND contains({l}, '(') AND contains({l}, ')'))"
    ok4 = f"(length({pot}) BETWEEN 2 AND 5 AND regexp_full_match(replace({pot}, '.', ''), '\\p{{L}}+'))"
    return (f"CASE WHEN {r1} AND {has_parts} AND {tok} = '' THEN '!ERR' "
            f"WHEN {r1} AND {has_parts} AND {ok} THEN upper({clean}) "
            f"WHEN {r2} AND {has_parts} AND {tok} = '' THEN '!ERR' "
            f"WHEN {r2} AND {has_parts} AND {ok} THEN upper({clean}) "
            f"WHEN {r3} AND {ok3} THEN upper({t3}) WHEN {r4} AND {ok4} THEN upper({pot}) END")


def _ticker_v1_sql(doc: str, compat: bool, head: int | None = T.V1_TICKER_LINES,
                   segment: int | None = T.V1_TICKER_SEGMENT) -> str:
    lines = f"string_split({doc}, chr(10))" + (f"[1:{head}]" if head else "")
    keep = "x IS NOT NULL" if compat else "x IS NOT NULL AND x <> '!ERR'"
    first = (f"list_filter(list_transform({lines}, lambda l: {_ticker_v1_line_sql('l', segment)}), "
             f"lambda x: {keep})[1]")
    return f"(CASE WHEN {first} <> '!ERR' THEN {first} END)"


@register("ticker_v1", lambda: sql(query=f"""
SELECT k, {_ticker_v1_sql('raw', True)} AS ticker_compat, {_ticker_v1_sql('raw', False)} AS ticker_fixed
FROM filing_docs_fx"""))
def ticker_v1(spark, sf_dir):
    """T4: the v1 line rules over the first 200 lines of the raw document."""
    d = fxf.filing_docs_fx(spark, sf_dir)
    d = T.with_ticker_v1(d, "raw", "ticker_compat", T.V1_TICKER_LINES, T.V1_TICKER_SEGMENT, corrected="ticker_fixed")
    return d.select("k", "ticker_compat", "ticker_fixed")


@register("document_facts_whole", lambda: sql(DOCS_SQL, f"""
whole AS (SELECT k, raw, clean, {ot.section_v1_sql('raw', None)} AS s1, {ot.section_v2_sql('clean', None)} AS s2
          FROM docs_clean)""", query=f"""
SELECT k, length(s1) AS section_v1_len, length(s2) AS section_v2_len, {ot.deal_value_sql('s2', True)} AS deal_value_compat,
       {ot.deal_value_sql('s2', False)} AS deal_value_fixed, {ot.company_sql('clean', None)} AS company,
       {_ticker_v1_sql('raw', True, None, None)} AS ticker_compat, {_ticker_v1_sql('raw', False, None, None)} AS ticker_fixed
FROM whole"""))
def document_facts_whole(spark, sf_dir):
    """T3, T4, T6, T7, T8 without the reference's bounds: every line and character of a document is read."""
    # one function reads a document for all of them; cleaned texts and sections stay in it
    d = T.with_clean_html(T.Scans(fxf.filing_docs_fx(spark, sf_dir), "clean", "s1", "s2"), "raw", "clean")
    d = T.with_length(T.with_section_v1(d, "raw", "s1"), "s1", "section_v1_len")
    d = T.with_length(T.with_section_v2(d, "clean", "s2"), "s2", "section_v2_len")
    d = T.with_deal_value(d, "s2", "deal_value_compat", "deal_value_fixed")
    d = T.with_company_name(d, "clean", "company")
    d = T.with_ticker_v1(d, "raw", "ticker_compat", corrected="ticker_fixed")
    return d.run().select("k", "section_v1_len", "section_v2_len", "deal_value_compat", "deal_value_fixed", "company",
                          "ticker_compat", "ticker_fixed")


@register("clean_html", lambda: f"""
WITH c AS (SELECT page_id, html, {ot.clean_html_sql('html')} AS clean FROM pages)
SELECT page_id, clean, length(clean) AS clean_len,
       CASE WHEN length(html) > 0 THEN round(length(clean) / length(html) * 100, 2) ELSE 0.0 END AS clean_ratio
FROM c""")
def clean_html(spark, sf_dir):
    """T1 + T2 over every page: text nodes as lines, kept-character ratio."""
    p = table(spark, sf_dir, "pages").select("page_id", "html")
    c = T.with_clean_html(p, "html", "clean")
    return c.select("page_id", "clean", F.length("clean").cast("bigint").alias("clean_len"),
                    rnd(T.cleaning_ratio(F.col("html"), F.col("clean")), 2).alias("clean_ratio"))


@register("verdict_guard", lambda: f"""
SELECT doc_id, regexp_matches({ot.strip_sql("coalesce(text, '')")}, {ot.q(ot.re2_guard())}) AS verdict_blanked,
       length(CASE WHEN regexp_matches({ot.strip_sql("coalesce(text, '')")}, {ot.q(ot.re2_guard())}) THEN ''
                   ELSE {ot.strip_sql("coalesce(text, '')")} END) AS verdict_len
FROM documents""")
def verdict_guard(spark, sf_dir):
    """F11 over every document used as a free-text verdict."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    g = T.verdict_guard(F.col("text"))
    t = T.pystrip(F.coalesce(F.col("text"), F.lit("")))
    return d.select("doc_id", t.rlike(T.MONEY_OR_PERCENT).alias("verdict_blanked"), F.length(g).cast("bigint").alias("verdict_len"))


@register("truncate_sentence", lambda: f"""
SELECT doc_id, {ot.truncate_sql('text')} AS truncated, length({ot.truncate_sql('text')}) AS truncated_len
FROM documents""")
def truncate_sentence(spark, sf_dir):
    """T10 over every document's whole text (1,020 characters)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    t = T.truncate_sentence(F.col("text"), 1020)
    return d.select("doc_id", t.alias("truncated"), F.length(t).cast("bigint").alias("truncated_len"))
