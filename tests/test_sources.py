"""Landed-file readers: Atom XML, issuer map, submissions, documents."""

import json

from dealflow.sources import readers as R

ATOM = """<?xml version="1.0" encoding="ISO-8859-1" ?>
<feed xmlns="http://www.w3.org/2005/Atom">
<title>Latest Filings</title>
<entry>
<title>8-K - ACME CORP (0000001234) (Filer)</title>
<link rel="alternate" type="text/html" href="https://www.sec.gov/Archives/edgar/data/1234/000000123424000001/0000001234-24-000001-index.htm"/>
<updated>2024-01-08T10:00:00-05:00</updated>
<id>urn:tag:sec.gov,2008:accession-number=0000001234-24-000001</id>
</entry>
<entry>
<title>4 - SOMEONE (0000005678) (Reporting)</title>
<link rel="alternate" type="text/html" href="https://www.sec.gov/Archives/edgar/data/5678/000000567824000002/"/>
<updated>2024-01-08T11:00:00-05:00</updated>
<id>urn:tag:sec.gov,2008:accession-number=0000005678-24-000002</id>
</entry>
</feed>
"""


def test_read_feed(spark, tmp_path):
    p = tmp_path / "feed.xml"
    p.write_text(ATOM)
    rows = R.read_feed(spark, str(p)).orderBy("feed_rank").collect()
    assert [r.title[:3] for r in rows] == ["8-K", "4 -"]
    assert rows[0].link.endswith("-index.htm") and rows[0].entry_id.endswith("0000001234-24-000001")
    t = R.feed_with_times(R.read_feed(spark, str(p))).orderBy("feed_rank").first()
    assert str(t.published_ts) == "2024-01-08 15:00:00"


def test_read_issuer_map(spark, tmp_path):
    p = tmp_path / "company_tickers.json"
    p.write_text(json.dumps({"0": {"cik_str": 320193, "ticker": "AAPL", "title": "Apple Inc."},
                             "1": {"cik_str": 1045810, "ticker": "NVDA", "title": "NVIDIA CORP"}}))
    rows = sorted(map(tuple, R.read_issuer_map(spark, str(p)).collect()))
    assert rows == [(0, 320193, "AAPL", "Apple Inc."), (1, 1045810, "NVDA", "NVIDIA CORP")]


def test_read_submissions(spark, tmp_path):
    p = tmp_path / "CIK0000001234.json"
    p.write_text(json.dumps({"cik": "1234", "tickers": ["acme"],
                             "filings": {"recent": {"accessionNumber": ["0000001234-24-000001", "0000001234-24-000002"],
                                                    "items": ["1.01,9.01", ""]}}}))
    filings, tickers = R.read_submissions(spark, str(p))
    assert sorted((r.accession, r.items) for r in filings.collect()) == [
        ("0000001234-24-000001", "1.01,9.01"), ("0000001234-24-000002", "")]
    assert tickers.first().first_ticker == "ACME"


def test_read_documents(spark, tmp_path):
    d = tmp_path / "docs"
    d.mkdir()
    (d / "0000001234-24-000001.txt").write_text("line one\nItem 1.01 Entry\n")
    rows = R.read_documents(spark, str(d)).collect()
    assert rows[0].accession == "0000001234-24-000001" and "Item 1.01" in rows[0].raw


def test_feed_rank_follows_files_then_places(spark, tmp_path):
    entry = "<entry><title>8-K - {0}</title><id>{0}</id><link href='l'/><updated>2024-01-01T00:00:00Z</updated></entry>"
    for name, ids in (("a.xml", range(3)), ("b.xml", range(10, 200)), ("c.xml", range(300, 303))):
        (tmp_path / name).write_text("<feed>" + "\n".join(entry.format(i) for i in ids) + "</feed>")
    got = [int(r.entry_id) for r in R.read_feed(spark, str(tmp_path / "*.xml")).orderBy("feed_rank").collect()]
    assert got == sorted(got) and len(got) == 196


def test_daily_bars_zone_and_log(spark, tmp_path):
    import datetime as dt
    bars = spark.createDataFrame([("T", dt.datetime(2024, 1, 8, 9, 30), 1.0, 2.0, 0.5, 1.5, 10)],
                                 "ticker string, ts timestamp_ntz, open double, high double, low double, close double, volume long")
    utc = R.bars_to_utc(bars, "America/New_York")
    assert utc.first().ts == dt.datetime(2024, 1, 8, 14, 30)
    R.write_bars(utc, str(tmp_path / "bars"))
    assert R.read_bars(spark, str(tmp_path / "bars")).where("session_date = date'2024-01-08'").count() == 1
    daily = utc.selectExpr("ticker", "to_date(ts) AS d", "open", "high", "low", "close", "volume")
    daily.write.parquet(str(tmp_path / "daily"))
    assert R.read_daily_bars(spark, str(tmp_path / "daily")).first().d == dt.date(2024, 1, 8)
    for rank, price in ((1, 5.0), (2, 6.0)):
        R.append_log(spark.createDataFrame([("T-2024-01-08", rank, price)], "id string, feed_rank long, price double"),
                     str(tmp_path / "log"))
    assert [r.price for r in R.read_log(spark, str(tmp_path / "log")).collect()] == [6.0]
