"""Every registered query equals its DuckDB oracle (small scale factor)."""

import math

import duckdb
import pytest

import __spark_entry__ as se
from dealflow.sources.tables import TABLES

QUERIES = se.queries()
ORACLES = se.oracle_sql()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


SPARK_T = {"int": "i32", "bigint": "i64", "double": "f64", "string": "str", "boolean": "bool", "date": "date"}
DUCK_T = {"INTEGER": "i32", "BIGINT": "i64", "DOUBLE": "f64", "VARCHAR": "str", "BOOLEAN": "bool", "DATE": "date"}


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    # the training-data queries, where SQL can't express them, are tested against brute force
    rows_only = {q for q in set(QUERIES) - set(ORACLES) if not q.startswith("op") and q != "pipeline"}
    assert rows_only == set()
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_small, con, name):
    df = QUERIES[name](spark, sf_small)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[name])
    ocols = list(rel.columns)
    otypes = {c: DUCK_T.get(str(t).split("(")[0], str(t)) for c, t in zip(rel.columns, rel.types)}
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert {c: SPARK_T.get(t, t) for c, t in df.dtypes} == otypes
    assert len(srows) == len(orows)
    assert _rows(df.columns, srows) == _rows(ocols, orows)


def test_entry_runs(spark):
    out = se.entry(spark)
    assert set(out.columns) == {"deal_structure", "total", "sustained"}
    assert out.count() >= 0


def test_alert_payload_rows(spark, sf_small):
    p = QUERIES["alert_payload"](spark, sf_small).limit(20).collect()
    assert p, "some filings are routed at sf0.001"
    for r in p:
        assert r.title.startswith(r.priority) and r.color in (15158332, 16753920, 16776960)
        assert "Form" in r.field_names.split("|")


def test_alert_payload_json(spark, sf_small):
    import json
    from dealflow.operators import gates, route
    from dealflow.plans.q_filings import routed_frame
    from pyspark.sql import functions as F
    r = gates.routed(routed_frame(spark, sf_small)).withColumn("company", F.lit("X")).withColumn(
        "deal_value_regex", F.lit(None).cast("double"))
    for row in route.alert_payload(r, route.V2_CAPS).limit(5).collect():
        embed = json.loads(row.payload)["embeds"][0]
        assert embed["title"].startswith(row.priority) and {f["name"] for f in embed["fields"]} >= {"Form"}


V1_ROW = ("k bigint, priority string, published_ts timestamp_ntz, company string, target_company string, acquirer string, "
          "deal_value string, premium_pct double, offer_price_per_share double, upside_pct double, impact_score double, "
          "verdict string, short_term_move string, confidence double, deal_structure string, tgt_ticker string, tgt_error string, "
          "tgt_price double, tgt_cap_formatted string, tgt_volume_spike double, tgt_week_change_pct double, "
          "tgt_institutional_pct double, premium_calculation string, strategic_rationale string, key_points array<string>, "
          "risks array<string>, leak_detected boolean, leak_reasoning string, liquidity_warning string, "
          "sympathy_plays array<string>, link string")


def test_alert_payload_v1_layout(spark):
    import datetime as dt
    import json
    from dealflow.operators import route
    full = (1, "MEGA", dt.datetime(2024, 3, 26, 10), "Filer", "Target", "Buyer", "$5M", 22.25, 12.5, 8.1, 9.0, "Buy", "up", 8.0,
            "all-cash", "TGT", None, 10.0, "$2.00B", 2.25, -3.125, 0.5, "x" * 600, "", list("abcde"), list("abcde"), True, None,
            "thin", list("abcde"), "http://f")
    bare = (2, "STANDARD", None) + (None,) * 28
    unlisted = (3, "MAJOR", None, "Filer", None, None, "", 0.0, 0.0, None, None, None, None, None, "", "TGT", "no data", 10.0,
                "$2.00B", 3.0, 1.0, 0.5, None, None, [], [], False, "x", "", [], "")
    rows = spark.createDataFrame([full, bare, unlisted], V1_ROW)
    a, b, c = [json.loads(r.payload)["embeds"][0] for r in route.alert_payload_v1(rows, route.V1_CAPS).orderBy("k").collect()]
    assert a["title"] == "MEGA M&A - Item 1.01" and a["color"] == 15158332 and a["url"] == "http://f"
    assert a["description"].split("\n")[:4] == ["Target → Buyer", "Deal value: $5M", "Premium: 22.25% (from $10.0)",
                                               "Offer price: $12.5/share"]
    fields = {f["name"]: f["value"] for f in a["fields"]}
    assert fields == {
        "Market data": "Market cap: $2.00B\nPrice: $10.0\nVolume spike: 2.2x normal\nWeek: -3.12%\nInstitutions: 50.0%",
        "Premium calculation": "x" * 500, "Key points": "• a\n• b\n• c", "Risks": "• a\n• b\n• c",
        "Trading warnings": "Leak detected: Unusual price action\nLiquidity: thin", "Sympathy plays": "• a\n• b\n• c\n• d"}
    assert a["footer"]["text"] == "2024-03-26 o 12:00:00 CEST" and a["author"]["url"].endswith("?symbol=TGT")
    assert b["description"].startswith("Unknown → Unknown\nImpact: 0/10\nVerdict: N/A") and b["fields"] == []
    assert "url" not in b and "author" not in b and b["footer"]["text"] == ""
    assert c["fields"] == [] and "Premium" not in c["description"] and "url" not in c
    whole = json.loads(route.alert_payload_v1(rows).where("k = 1").head().payload)["embeds"][0]["fields"]
    assert {f["name"]: len(f["value"]) for f in whole}["Premium calculation"] == 600
