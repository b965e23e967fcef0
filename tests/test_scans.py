"""Scans of documents: one function for all of a query's scans, tried only where a match can begin."""

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from dealflow.functions import text as T
from dealflow.operators import score
from test_plans import nodes

PIECES = ["Item 1.01", "ITEM 1.01", "item 1.1", "İtem 1.01", "Item 5.02", "item 2.", "Item  9", "SIGNATURES", "ſignature",
          "Pursuant to the requirements", "Entry into a Material Definitive Agreement", "x" * 110, "\n", "\n", " ", "日本", "İ", "K",
          "COMPANY CONFORMED NAME: A: b ", "Trading Symbol: ABC", "(NASDAQ: XY)", "Company (KKR)", "Trading Symbol:", "<b>", "</b>",
          "&amp;", "total consideration of approximately $5 million", "deal value of $2,500,000 ", "valued at approximately $ 3bn.",
          "consideration of approximately $1", "$7 million in all-cash", "offer price of $9 per share", "$", "approximately",
          "merger agreement", "term  loan", "TENDER\noffer", "xlbo", " LBO ", "acquired by", "acquired byte", "all\rcash deal", "all-cash deal", "to be  acquired",
          "will acquire", "revolving loan", "line of\u00a0credit", "indenture", "at-the-market program", "agreed to merge", "agrees",
          "acquisition of the issued", "definitive business combination agreement", "senior secured term", "change in control agreement"]


def texts(n=300, seed=5):
    r = random.Random(seed)
    return [None, "", "\n", *("".join(r.choice(PIECES) + r.choice(["", " ", "\n"]) for _ in range(r.randrange(1, 25))) for _ in range(n))]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(texts())), "k int, raw string").repartition(3)


def facts(d):
    d = T.with_clean_html(d, "raw", "clean")
    d = T.with_length(T.with_section_v1(d, "raw", "s1"), "s1", "n1")
    d = T.with_length(T.with_section_v2(d, "clean", "s2"), "s2", "n2")
    d = T.with_deal_value(d, "s2", "compat", "fixed")
    d = T.with_company_name(d, "clean", "company")
    return T.with_ticker_v1(d, "raw", "ticker", corrected="ticker_fixed")


COLS = ["k", "n1", "n2", "compat", "fixed", "company", "ticker", "ticker_fixed"]


def test_scans_together_equal_scans_alone(docs):
    together = facts(T.Scans(docs, "clean", "s1", "s2")).run()
    assert "clean" not in together.columns and "s2" not in together.columns
    assert sorted(map(str, together.select(COLS).collect())) == sorted(map(str, facts(docs).select(COLS).collect()))


def test_first_match_equals_search():
    words = [(T._END_V2, T._END_WORDS_V2), (T._END_V1, T._END_WORDS_V1), *T._STARTS_V2,
             *((T.scan(p.replace("{n}", T._NUM)), w[0]) for p, w in zip(T.DEAL_VALUE_PATTERNS, T._DEAL_WORDS)),
             (re.compile("bcdef|ab|cd"), ("cd", "bcdef", "ab"))]
    for t in [*texts(400, 6)[1:], "xxabcdef", "abcdefg"]:
        low = T.ascii_lower(t)
        assert len(low) == len(t)
        for p, ws in words:
            for start in (0, 3, 100):
                t_ = low if p is T._END_V1 else t
                a, b = p.search(t_, start), T.first_match(p, ws, t_, low, start)
                assert (a and a.span()) == (b and b.span()), (p.pattern, t)


def test_scans_by_plain_python(docs):
    """The rules of T3, T6 and T8 spelled out without any short cut."""
    def section_v1(t):
        low = t.lower()
        start = low.find("item 1.01") if "item 1.01" in low else low.find("item 1.1")
        rel = t[max(start, 0):]
        ends = [e for m in T.SECTION_END_V1 if (e := rel.lower().find(m, 100)) >= 0]
        return rel[:min(ends, default=len(rel))] if start >= 0 else t

    def company(t):
        line = next((x for x in t.split("\n") if "COMPANY CONFORMED NAME" in x.upper()), None)
        return T.DEFAULT_COMPANY if line is None else line.rpartition(":")[2].strip()

    def lines(t):
        return [x for x in t.split("\n") if any(w in x.lower() for w in T._V1_TRIGGERS)]

    for t in filter(None, texts(400, 7)):
        assert T._section_v1(None)(t) == section_v1(t) and T._company(None)(t) == company(t)
        assert T._lines_with(t, T._V1_TRIGGERS) == lines(t)


def test_document_facts_reads_a_document_once(spark, sf_small):
    """one function gets each document's text; before, five got it or what the one before had made of it."""
    p = se.queries()["document_facts_whole"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert p.count("ArrowEvalPython") == 1


def test_rule_score_reads_a_document_once(spark, sf_small):
    """one function cleans, cuts and tests a document; before, two did and the patterns ran on what they returned."""
    p = se.queries()["rule_score"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert p.count("ArrowEvalPython") == 1 and "promissory" not in p


def test_credit_wording_equals_the_patterns(spark, docs):
    # Java before 19 takes letters beyond ASCII for word characters at a \b, the SQL (RE2) and the scan don't
    docs = docs.where(~F.col("raw").rlike(r"(?i)(by|with|merge|lbo)[^\x00-\x7F]|[^\x00-\x7F]lbo"))
    col = F.col("raw")
    for patterns in (T.MA_EXCLUSIONS, T.MA_KEYWORDS_STRONG, T.MA_KEYWORDS_WEAK):
        assert all(T._words(p)[0] for p in patterns)
        got = T.scanned(docs, "got", T.holds_any(patterns), "raw", "boolean")
        rows = got.select("raw", "got", T.any_pattern(col, patterns).alias("want")).collect()
        assert [r for r in rows if r.got != r.want] == []
    args = [F.lit("acquisition"), F.lit(True), F.lit("all-cash"), F.lit(50.0), F.lit(0.2)]
    d = score.with_credit(docs, "raw", "credit")
    rows = d.select("raw", score.rule_score(col, *args).alias("a"), score.rule_score(None, *args, credit=F.col("credit")).alias("b"))
    found = rows.collect()
    assert [r for r in found if r.a != r.b] == [] and {r.b for r in found} == {1, 10}


def test_words_of_patterns():
    assert T._words(r"\blbo\b") == ("lbo", "lbo")
    assert T._words(r"agree(?:d|s)?\s+to\s+(?:acquire|merge)\b") == ("agree", "agree")
    assert T._words("colou?rs? ab*") == ("colo", "colo") and T._words("a|b") == ("", "") and T._words("(?:x|y) plan") == ("", "plan")


@pytest.mark.parametrize("name", ["alert_payload", "alert_payload_v1"])
def test_no_alert_text_is_shuffled(spark, sf_small, name):
    """documents are dealt out once each; before, each alert took two whole texts through its joins."""
    df = se.queries()[name](spark, sf_small)
    moved = [n.output().toString() for n in nodes(df._jdf.queryExecution().executedPlan()) if n.nodeName() == "Exchange"]
    assert moved and not [m for m in moved if re.search(r"\bk#", m) and re.search(
        r"\b(vbody|_body|reasoning|analyst_verdict|strategic_rationale|raw|clean|section)#", m)]
