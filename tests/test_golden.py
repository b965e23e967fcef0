"""Hand-written golden rows, one or more per semantic contract."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dealflow.functions import identifiers as ids
from dealflow.functions import text as T
from dealflow.functions import timefns as tf
from dealflow.operators import enrich, gates, outcomes, report, route


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first().r


def via(spark, fn, value, **kw):
    """Run a DataFrame-level text transform on one value."""
    return fn(spark.createDataFrame([(value,)], "x string"), "x", "r", **kw).first().r


def bounded(spark, value):
    return T.with_deal_value(spark.createDataFrame([(value,)], "x string"), "x", bounded="r").first().r


def col():
    return F.col("x")


# ---- P1-P8 ------------------------------------------------------------------

ARCH = "https://www.sec.gov/Archives/edgar/data/1234/000000123424000001/0000001234-24-000001-index.htm"
VIEW = "https://www.sec.gov/cgi-bin/browse-edgar?action=view&cik=0001234&accession_number=0000001234-24-000001"


def test_cik_title_filer_suffix_falls_back_to_path(spark):
    df = spark.createDataFrame([("8-K - ACME CORP (0000001234) (Filer)", ARCH), ("8-K - ACME (0000001234)", ARCH),
                                ("8-K - ACME (ACME)", VIEW)], "t string, l string")
    got = [tuple(r) for r in df.select(ids.cik_v1(F.col("t"), F.col("l")), ids.accession_v1(F.col("l")),
                                       ids.cik_v2(F.col("l"), F.lit("")), ids.accession_v2(F.col("l"), F.lit("")),
                                       ids.cik_diag(F.col("l")), ids.accession_diag(F.col("l"))).collect()]
    assert got[0] == ("1234", "0000001234-24-000001", "1234", "0000001234-24-000001", "1234", "0000001234-24-000001")
    assert got[1][0] == "0000001234"
    assert got[2] == (None, "0000001234-24-000001", "0001234", "0000001234-24-000001", "1234", "0000001234-24-000001")


def test_dashed_and_18_digit_links(spark):
    link18 = "https://www.sec.gov/Archives/edgar/data/1234/000000123424000001/"
    assert one(spark, ids.accession_v2(col(), F.lit("")), link18) == "0000001234-24-000001"
    assert one(spark, ids.accession_feed_v1(col()), link18) == "0000001234-24-000001"
    assert one(spark, ids.accession_diag(col()), link18) is None


def test_ticker_hint(spark):
    assert one(spark, ids.ticker_hint(col()), "8-K - ACME CORP (ACME)") == "ACME"
    assert one(spark, ids.ticker_hint(col()), "8-K - BERKSHIRE (BRK.B) ") == "BRK.B"
    assert one(spark, ids.ticker_hint(col()), "8-K - acme (acme)") is None


@pytest.mark.parametrize("raw,iso", [("Mon, 01 Jan 2024 10:00:00 -0500", "2024-01-01T15:00:00"),
                                     ("Mon, 01 Jan 2024 10:00:00 +0000", "2024-01-01T10:00:00"),
                                     ("2024-01-01T10:00:00Z", "2024-01-01T10:00:00"),
                                     ("", None), ("garbage", None)])
def test_published_times(spark, raw, iso):
    assert one(spark, tf.iso_seconds(tf.parse_published(col())), raw) == iso


# ---- P9-P11 -----------------------------------------------------------------

@pytest.mark.parametrize("ts,v1,v2", [
    ("2024-03-24 10:00:00", "2024-03-24 o 11:00:00 CET", "2024-03-24 11:00 CET"),
    ("2024-03-25 10:00:00", "2024-03-25 o 12:00:00 CEST", "2024-03-25 11:00 CET"),
    ("2024-04-01 10:00:00", "2024-04-01 o 12:00:00 CEST", "2024-04-01 12:00 CEST"),
    ("2024-10-24 10:00:00", "2024-10-24 o 12:00:00 CEST", "2024-10-24 11:00 CET"),
    ("2024-10-25 10:00:00", "2024-10-25 o 11:00:00 CET", "2024-10-25 11:00 CET")])
def test_local_time_approximations(spark, ts, v1, v2):
    df = spark.createDataFrame([(ts,)], "x string").select(F.to_timestamp_ntz("x").alias("t"))
    r = df.select(tf.local_time_v1(F.col("t")).alias("a"), tf.local_time_v2(F.col("t")).alias("b")).first()
    assert (r.a, r.b) == (v1, v2)


def test_local_time_iana_transition(spark):
    df = spark.createDataFrame([("2024-03-31 00:30:00",), ("2024-03-31 01:30:00",)], "x string")
    got = [r[0] for r in df.select(tf.local_time_iana(F.to_timestamp_ntz("x"))).collect()]
    assert got == ["2024-03-31 01:30", "2024-03-31 03:30"]


@pytest.mark.parametrize("ts,ctx,session", [
    ("2024-01-05 21:00:00", "after-hours", "2024-01-08"),     # Friday close rolls to Monday
    ("2024-01-07 10:00:00", "weekend", "2024-01-08"),         # Sunday
    ("2024-01-06 23:00:00", "weekend", "2024-01-08"),         # Saturday late
    ("2024-01-08 14:29:59", "pre-market", "2024-01-08"),      # seconds ignored
    ("2024-01-08 14:30:00", "market-hours", "2024-01-08"),
    ("2024-01-08 20:59:00", "market-hours", "2024-01-08"),
    ("2024-01-08 21:00:00", "after-hours", "2024-01-09")])
def test_session_calendar(spark, ts, ctx, session):
    df = spark.createDataFrame([(ts,)], "x string").select(F.to_timestamp_ntz("x").alias("t"))
    r = df.select(tf.filing_context(F.col("t")).alias("c"),
                  F.date_format(tf.next_session_date(F.col("t")), "yyyy-MM-dd").alias("s")).first()
    assert (r.c, r.s) == (ctx, session)


# ---- T1-T12 -------------------------------------------------------------------

def test_clean_html_entities_and_scripts(spark):
    html = ('<!DOCTYPE html><html><head><meta charset="utf-8"><style>p{}</style><script>var a="</p>";</script>'
            '</head><body><p>Hello &amp; world</p><!-- c --><p>  A&nbsp;</p><noscript>x</noscript>'
            '<p>x&#8212;y &lt;b&gt;</p></body></html>')
    assert via(spark, T.with_clean_html, html) == "Hello & world\nA\nx—y <b>"


def test_company_name_takes_last_colon(spark):
    doc = "<SEC-HEADER>\nCOMPANY CONFORMED NAME:   ACME: HOLDINGS  \nother"
    assert one(spark, T.company_name(col()), doc) == "HOLDINGS"
    assert one(spark, T.company_name(col()), "nothing here") == "Unknown Company"


def test_ticker_v1_empty_remainder_aborts_in_compat(spark):
    doc = "Trading Symbol:\nACME COMPANY INC (ACME)"
    assert via(spark, T.with_ticker_v1, doc) is None
    assert spark.createDataFrame([(doc,)], "x string").transform(
        lambda d: T.with_ticker_v1(d, "x", corrected="r")).first().r == "ACME"
    assert via(spark, T.with_ticker_v1, "listed (NASDAQ: XYZ) today") == "XYZ"


def test_ticker_v2_nasdaq_stock_market_trap(spark):
    assert one(spark, T.ticker_v2(col(), compat=True), "listed on the Nasdaq Stock Market") == "STOCK"
    assert one(spark, T.ticker_v2(col(), compat=True), "the Nasdaq Global Select") == "GLOBA"
    assert one(spark, T.ticker_v2(col(), compat=False), "listed on the Nasdaq Stock Market") is None
    assert one(spark, T.ticker_v2(col(), compat=False), "Trading Symbol: ACME") == "ACME"


def test_section_v2_sees_nbsp_item_header(spark):
    body = "Intro text\nITEM 1.01 Entry into agreement " + "x" * 150 + "\nItem 9.01 Exhibits"
    s = via(spark, T.with_section_v2, body)
    assert s.startswith("ITEM 1.01") and s.endswith("x")


def test_section_v1_markers(spark):
    doc = "head\nItem 1.01 Entry " + "y" * 120 + " item 2.03 next"
    s = one(spark, T.section_v1(col(), 6000), doc)
    assert s.startswith("Item 1.01") and not s.lower().count("item 2.")
    assert one(spark, T.section_v1(col(), 10), "no items here at all") == "no items h"


def test_deal_value_unit_trap(spark):
    trap = "The purchase price of $5,000,000 by the buyer is fixed."
    assert via(spark, T.with_deal_value, trap) == 5e15
    assert bounded(spark, trap) == 5e6
    assert via(spark, T.with_deal_value, "valued at approximately $2.5 bn") == 2.5e9
    assert via(spark, T.with_deal_value, "$1,000,000 in cash") is None


def test_truncate_sentence_boundaries(spark):
    exact = "a" * 1020
    assert one(spark, T.truncate_sentence(col()), exact) == exact
    long_ = "b" * 600 + ". " + "c" * 419
    assert len(long_) == 1021
    assert one(spark, T.truncate_sentence(col()), long_) == "b" * 600 + "."
    nob = "d" * 1021
    assert one(spark, T.truncate_sentence(col()), nob) == "d" * 1020 + "…"


def test_verdict_guard(spark):
    assert one(spark, T.verdict_guard(col()), "Premium of 40% is fine") == "Premium of 40% is fine"
    assert one(spark, T.verdict_guard(col()), "Premium of 40.5% is rich") == ""
    assert one(spark, T.verdict_guard(col()), "Paid $5,000") == ""


def test_keyword_gate(spark):
    rows = [("The merger agreement was signed under an indenture.", True),
            ("A definitive agreement for the credit facility.", False),
            ("A definitive agreement was signed.", True), ("Nothing to see.", False)]
    df = spark.createDataFrame(rows, "x string, want boolean")
    assert all(r.g == r.want for r in df.select(T.keyword_gate(col()).alias("g"), "want").collect())


def test_model_json_blocks(spark):
    assert one(spark, T.json_block_v1(col()), 'x ```json\n{"a": 1}\n``` y') == '{"a": 1}'
    assert one(spark, T.json_block_v2(col()), 'Here: {"a": {"b": 1}} ok') == '{"a": {"b": 1}}'


# ---- F5, R3 ---------------------------------------------------------------------

def test_liquidity_equality_passes(spark):
    rows = [(1e8, 1e5, 5.0, "OK"), (1e8 - 1, 1e5, 5.0, "low_cap"), (None, 1e5, 5.0, "no_cap"),
            (0.0, 1e5, 5.0, "no_cap"), (1e8, 99999.0, 5.0, "low_volume"), (1e8, None, 5.0, "low_volume"),
            (1e8, 1e5, 4.99, "low_dollar_volume"), (1e8, 1e6, None, "low_dollar_volume")]
    df = spark.createDataFrame(rows, "cap double, av double, px double, want string")
    got = df.select(gates.liquidity_reason(F.col("cap"), F.col("av"), F.col("px")).alias("g"), "want").collect()
    assert [r.g for r in got] == [r.want for r in got]


def test_priority_bands(spark):
    df = spark.createDataFrame([(4.0,), (5.0,), (7.0,), (9.0,), (8.5,), (None,)], "s double")
    got = [tuple(r) for r in df.select(route.priority(F.col("s")), route.route_outcome(F.col("s"))).collect()]
    assert got == [(None, "low_impact"), ("STANDARD", "alert"), ("MAJOR", "alert"), ("MEGA", "alert"),
                   ("MAJOR", "alert"), (None, "bad_score")]


def test_cap_label_boundaries(spark):
    df = spark.createDataFrame([(1e9,), (999_950_000.0,), (218_250_000.0,), (None,), (0.0,)], "c double")
    got = [r[0] for r in df.select(enrich.cap_label(F.col("c"))).collect()]
    assert got == ["$1.00B", "$1000.0M", "$218.2M", "Unknown", "Unknown"]
    assert one(spark, enrich.cap_label(col(), strict=True), 1e9, "x double") == "$1000.0M"


# ---- A1-A9 ---------------------------------------------------------------------------

def _bars(spark, rows):
    return spark.createDataFrame(
        [("T", dt.datetime.fromisoformat(t), float(o), float(h), float(lo), float(c), v) for t, o, h, lo, c, v in rows],
        "ticker string, ts timestamp_ntz, open double, high double, low double, close double, volume bigint")


def _alerts(spark, rows):
    return spark.createDataFrame(
        [(i, "T", dt.datetime.fromisoformat(t), p, d) for i, t, p, d in rows],
        "alert_id bigint, ticker string, filing_ts timestamp_ntz, price_at_filing double, direction string")


def test_neutral_alert_rising_price(spark):
    bars = _bars(spark, [("2024-01-08 14:30:00", 100, 100.5, 99.5, 100.2, 10),
                         ("2024-01-08 16:00:00", 102, 103.5, 101.0, 103.0, 30)])
    al = _alerts(spark, [(1, "2024-01-08 10:00:00", 99.0, "neutral"), (2, "2024-01-08 10:00:00", 99.0, "bullish")])
    o = {r.alert_id: r for r in outcomes.track_outcomes(al, bars, benchmark=None).collect()}
    assert o[1].first_touch_at is None and o[1].target_touched is False     # compat: -high never >= 1
    assert o[1].direction_at_4h is False                                   # neutral follows the bearish rule
    assert o[2].first_touch_at == "t_2h" and o[2].first_touch_minutes == 120 and o[2].sustained_at == "t_2h"
    assert o[2].close_pct_15m == 0.2 and o[2].high_pct_2h == 3.5 and o[2].range_low_pct == -0.5
    assert o[2].volume_ratio_15m == round(10 / (20 * 15), 2)
    c = {r.alert_id: r for r in outcomes.track_outcomes(al, bars, benchmark=None, compat=False).collect()}
    assert c[1].first_touch_at is None and c[1].direction_at_4h is None   # corrected: neutral unmeasured


def test_empty_window_and_zero_open(spark):
    bars = _bars(spark, [("2024-01-08 15:00:00", 100, 101, 99, 100.5, 5),
                         ("2024-01-09 14:30:00", 0, 1, 0, 1, 5)])
    al = _alerts(spark, [(1, "2024-01-08 09:00:00", None, "bullish"), (2, "2024-01-09 09:00:00", None, "bullish"),
                         (3, "2024-01-10 09:00:00", None, "bullish")])
    o = {r.alert_id: r for r in outcomes.track_outcomes(al, bars, benchmark=None).collect()}
    assert o[1].tracker_status == "tracked" and o[1].close_pct_15m is None and o[1].close_pct_1h == 0.5
    assert o[2].tracker_status == "tracked" and o[2].close_pct_4h is None and o[2].range_high_pct is None
    assert o[3].tracker_status == "no_data"


def test_report_needs_two_tracked(spark):
    schema = ("tracker_status string, direction_at_1h boolean, direction_at_4h boolean, target_touched boolean, "
              "target_sustained boolean, range_high_pct double, range_low_pct double, alpha_4h double, "
              "first_touch_minutes int")
    one_row = spark.createDataFrame([("tracked", True, None, True, False, 1.0, -1.0, None, 15),
                                     ("no_data", None, None, None, None, None, None, None, None)], schema)
    assert report.report_totals(one_row).count() == 0
    two = one_row.union(spark.createDataFrame([("tracked", False, True, False, False, 2.0, -2.0, 0.5, None)], schema))
    r = report.report_totals(two).first()
    assert (r.total, r.n_dir_1h, r.pct_dir_1h, r.n_touched, r.avg_range_high, r.avg_alpha, r.avg_touch_minutes) == \
        (2, 1, 50, 1, 1.5, 0.5, 15)


def test_score_buckets_skip_between_ranges(spark):
    df = spark.createDataFrame([("tracked", 8.5, True), ("tracked", None, True), ("tracked", 9.0, True),
                                ("tracked", 6.0, False)], "tracker_status string, groq_score double, target_sustained boolean")
    got = [tuple(r) for r in report.report_by_score(df).collect()]
    assert got == [("9-10 MEGA/MAJOR", 1, 1), ("5-6 STANDARD", 1, 0)]


# ---- no-break spaces and a bare "<" ----------------------------------------

NB = "\u00a0"


def test_bare_less_than_is_text(spark):
    assert via(spark, T.with_clean_html, "<p>ownership < 5% of shares</p>") == "ownership < 5% of shares"
    assert via(spark, T.with_clean_html, "<p>a <b>x</b> is < 3 and > 1</p>") == "a\nx\nis < 3 and > 1"


def test_no_break_space_is_white_space(spark):
    assert via(spark, T.with_deal_value, f"aggregate{NB}consideration of ${NB}5{NB}million") == 5e6
    assert via(spark, T.with_deal_value, f"valued at approximately $5{NB}million") == 5e6
    assert one(spark, T.ticker_v2(col()), f"Trading{NB}Symbol: ACME") == "ACME"
    assert one(spark, T.ticker_v2(col()), f"Nasdaq{NB}ACME") == "ACME"
    assert one(spark, T.ticker_v2(col(), compat=False), f"Trading Symbol:{NB}ACME") == "ACME"
    assert one(spark, T.keyword_gate(col()), f"a merger{NB}agreement") is True
    assert one(spark, ids.ticker_hint(col()), f"8-K - ACME CORP (ACME){NB}") == "ACME"


def test_long_texts_reach_section_and_value(spark):
    text = "Item 1.01 " + "word " * 4000 + "the purchase price of $7 million Item 9.01 end"
    df = T.with_section_v2(spark.createDataFrame([(text,)], "x string"), "x", "s")
    assert len(df.first().s) > 20_000
    assert T.with_deal_value(df, "s", "r").first().r == 7e6
    capped = T.with_section_v2(spark.createDataFrame([(text,)], "x string"), "x", "s", T.SECTION_CHARS_V2)
    assert len(capped.first().s) == 12_000 and T.with_deal_value(capped, "s", "r").first().r is None
    assert one(spark, F.length(T.section_v1(col())), text) > 20_000
    assert one(spark, T.company_name(col()), "\n" * 60 + "COMPANY CONFORMED NAME: LATE") == "LATE"
    assert via(spark, T.with_ticker_v1, "\n" * 300 + "Trading Symbol: LATE") == "LATE"


@pytest.mark.parametrize("text,loose,tight", [("valued at approximately $5 major", 5e6 / 1e6, None),
                                              ("valued at approximately $9 millionaires", 9e6, None),
                                              ("purchase price of $3,000,000 basic", 3e15, 3e6)])
def test_one_scan_gives_both_unit_readings(spark, text, loose, tight):
    d = T.with_deal_value(spark.createDataFrame([(text,)], "x string"), "x", "a", "b").first()
    assert d.a == (loose if loose > 1e6 else (5e6 if "major" in text else None)) and d.b == tight


MARKUP_ROWS = {
    '<a title="a > b">x</a> y': "x\ny",
    "<a title='1 > 0' href=x>z</a>": "z",
    '<p title="open>a</p>b': "a\nb",
    "<p it's>a</p><p it's>b</p>": "a\nb",
    "a<script>if (a < b) { x = '<!--'; }</script>b": "a\nb",
    "a<script src='x>y'>c": "a",
    "a<style>p > b": "a",
    "a<noscript><p>n</p></noscript >b": "a\nb",
    "a<!-- <script> --> b</p>": "a\nb",
    "a<!-- b <p>c": "a",
    "a<scripted>b</scripted>": "a\nb",
    "<!DOCTYPE html><P CLASS = \"x>\" >A": "A",
    "1 < 2 and 3 > 2, <5": "1 < 2 and 3 > 2, <5",
    "a <b": "a <b",
    "": "",
}


def test_markup_quotes_and_unclosed(spark):
    """T1 on quoted attributes, unclosed bodies and comments; the oracle's spelling gives the same."""
    import duckdb

    from dealflow.plans import ox_text
    for raw, clean in MARKUP_ROWS.items():
        assert via(spark, T.with_clean_html, raw) == clean, raw
        sql = "SELECT " + ox_text.clean_html_sql("raw") + " FROM (SELECT ? AS raw)"
        assert duckdb.execute(sql, [raw]).fetchone()[0] == clean, raw


def test_markup_long_tags(spark):
    """A tag of a megabyte is one match, without recursion."""
    many = "<p " + "a=\"x > y\" b='z' " * 60_000 + ">t</p>" + "<!-- " + "- " * 300_000 + "-->u"
    assert via(spark, T.with_clean_html, many) == "t\nu"


def test_document_scans_read_a_text_once(spark):
    """whole documents are scanned by one function of a text, not once per marker or rule."""
    d = spark.createDataFrame([("x" * 50 + " Item 1.01 " + "y" * 120 + " Item 9.01 \U0001f600 SIGNATURES",), (None,), ("",)], "x string")
    for column in (T.section_v1(col()), T.company_name(col(), 50)):
        plan = d.select(column.alias("r"))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1 and "lower(" not in plan and "split(" not in plan
    assert [r.r for r in d.select(T.section_v1(col()).alias("r")).collect()] == ["Item 1.01 " + "y" * 120 + " ", None, ""]
    emoji = spark.createDataFrame([("\U0001f600" * 3 + "Item 1.01 " + "y" * 120 + " Item 9.01",)], "x string")
    assert T.with_section_v2(emoji, "x", "s").first().s == "Item 1.01 " + "y" * 120


def test_scans_keep_java_letter_case(spark):
    """Only ASCII letters lose their case in a scan: a long s or a Kelvin sign is no letter of a pattern."""
    d = spark.createDataFrame([("Item 1.01 " + "y" * 120 + " ſIGNATURE",)], "x string")
    assert T.with_section_v2(d, "x", "s").first().s.endswith("ſIGNATURE")
