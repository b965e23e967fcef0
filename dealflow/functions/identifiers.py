"""Identifier projections over feed rows: P1-P7, P12.

Three generations of the same extraction exist and differ on purpose:
``*_v1`` (split-based, first feed scanner), ``*_v2`` (regex-based, second
scanner) and ``*_diag`` (the feed diagnostic).  All are narrow column
expressions: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dealflow.functions.text import py_ws

# Fixed value: the path part of archive links.
ARCHIVE_MARK = "/Archives/edgar/data/"


def _blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def dashed(acc18: Column) -> Column:
    """18 digits to the 10-2-6 form (null unless exactly 18 digits)."""
    return F.when(acc18.rlike(r"^[0-9]{18}$"),
                  F.concat_ws("-", F.substring(acc18, 1, 10), F.substring(acc18, 11, 2),
                              F.substring(acc18, 13, 6)))


def undashed(acc: Column) -> Column:
    """P4 reverse: drop the dashes."""
    return F.replace(acc, F.lit("-"), F.lit(""))


def cik_strip(cik: Column) -> Column:
    """P5: numeric CIK without leading zeros (null if not a number)."""
    return cik.try_cast("bigint").cast("string")


def cik_pad(cik: Column) -> Column:
    """P5: CIK left-padded to 10 digits."""
    return F.lpad(cik_strip(cik), 10, "0")


# ---- v1 -------------------------------------------------------------------

def _archive_parts(link: Column):
    parts = F.split(link, "/")
    pos = F.array_position(parts, "data").cast("int")  # 1-based, 0 if absent
    ok = link.contains(ARCHIVE_MARK) & (pos > 0) & (pos + 2 <= F.size(parts))
    return parts, pos, ok


def cik_from_title_v1(title: Column) -> Column:
    """The last parenthesised text of the title if it is all digits."""
    last = F.substring_index(F.try_element_at(F.split(title, r"\("), F.lit(-1)), ")", 1)
    return F.when(title.contains("(") & title.contains(")") & last.rlike(r"^[0-9]+$"), last)


def cik_v1(title: Column, link: Column) -> Column:
    """P1 then P2: title digits, else the path part after ``data``."""
    parts, pos, ok = _archive_parts(link)
    return F.coalesce(cik_from_title_v1(title), F.when(ok, F.try_element_at(parts, pos + 1)))


def accession_feed_v1(link: Column) -> Column:
    """P3 (feed scan): only an 18-digit path part counts."""
    parts, pos, ok = _archive_parts(link)
    return F.when(ok, dashed(F.try_element_at(parts, pos + 2)))


def accession_from_link_v1(link: Column) -> Column:
    """P3 (fallback): ``accession_number=`` parameter, else an 18-digit or an
    already dashed path part."""
    param = F.regexp_extract(link, r"accession_number=([^&]*)", 1)
    parts, pos, ok = _archive_parts(link)
    part = F.try_element_at(parts, pos + 2)
    from_path = F.when(ok, F.coalesce(
        dashed(part),
        F.when(part.contains("-") & F.replace(part, F.lit("-"), F.lit("")).rlike(r"^[0-9]+$"),
               F.substring_index(part, "-index", 1))))
    return F.when(link.contains("accession_number="), _blank_to_null(param)).otherwise(from_path)


def accession_v1(link: Column) -> Column:
    return F.coalesce(accession_feed_v1(link), accession_from_link_v1(link))


def viewer_link_v1(title: Column, link: Column) -> Column:
    """Viewer URL when the feed scan found both CIK and accession."""
    cik, acc = cik_v1(title, link), accession_feed_v1(link)
    url = F.concat(F.lit("https://www.sec.gov/cgi-bin/viewer?action=view&cik="), cik,
                   F.lit("&accession_number="), acc, F.lit("&xbrl_type=v"))
    return F.when(cik.isNotNull() & acc.isNotNull(), url).otherwise(link)


# ---- v2 -------------------------------------------------------------------

def cik_v2(link: Column, entry_id: Column) -> Column:
    """P2 (v2): ``/data/N/`` in link then id, else ``cik=N`` anywhere."""
    return F.coalesce(_blank_to_null(F.regexp_extract(link, r"/data/(\d+)/", 1)),
                      _blank_to_null(F.regexp_extract(entry_id, r"/data/(\d+)/", 1)),
                      _blank_to_null(F.regexp_extract(F.concat(link, entry_id), r"(?i)cik=(\d+)", 1)))


def accession_v2(link: Column, entry_id: Column) -> Column:
    """P3 (v2): dashed form in link then id, else ``/18 digits/`` dashed."""
    d = r"(\d{10}-\d{2}-\d{6})"
    p = r"/(\d{18})/"
    return F.coalesce(_blank_to_null(F.regexp_extract(link, d, 1)),
                      _blank_to_null(F.regexp_extract(entry_id, d, 1)),
                      dashed(F.regexp_extract(link, p, 1)),
                      dashed(F.regexp_extract(entry_id, p, 1)))


def ticker_hint(title: Column) -> Column:
    """``(TICK)`` or ``(TICK.A)`` at the end of the title, case-sensitive."""
    return _blank_to_null(F.regexp_extract(title, py_ws(r"\(([A-Z]{1,5}(?:[.\-][A-Z]{1,3})?)\)\s*$"), 1))


# ---- diagnostic -----------------------------------------------------------

def accession_diag(link: Column) -> Column:
    """A15's reading: parameter, else a path part of 18+ characters with two
    dashes (``-index.htm`` removed)."""
    param = F.regexp_extract(link, r"accession_number=([^&]*)", 1)
    parts = F.split(link, "/")
    cands = F.transform(
        F.filter(parts, lambda p: (F.length(p) >= 18) & (_dashes(p) >= 2)),
        lambda p: F.replace(F.replace(p, F.lit("-index.htm"), F.lit("")), F.lit("-index.html"), F.lit("")))
    two = F.filter(cands, lambda p: _dashes(p) == 2)
    from_path = F.coalesce(F.try_element_at(two, F.lit(1)), F.try_element_at(cands, F.lit(-1)))
    return F.when(link.contains("accession_number="), _blank_to_null(param)) \
            .when(link.contains(ARCHIVE_MARK), from_path)


def _dashes(p: Column) -> Column:
    return F.length(p) - F.length(F.replace(p, F.lit("-"), F.lit("")))


def cik_diag(link: Column) -> Column:
    raw = F.regexp_extract(link, r"cik=([^&]*)", 1)
    stripped = F.regexp_replace(raw, r"^0+", "")
    path = F.regexp_extract(link, r"/data/([^/]*)", 1)
    return (F.when(link.contains("cik="), F.when(stripped == "", F.lit("0")).otherwise(stripped))
            .when(link.contains("/data/"), _blank_to_null(path)))


# ---- URLs and keys --------------------------------------------------------

def document_url(cik: Column, accession: Column) -> Column:
    """Full-text document URL of a filing."""
    return F.concat(F.lit("https://www.sec.gov/Archives/edgar/data/"), cik, F.lit("/"),
                    undashed(accession), F.lit("/"), accession, F.lit(".txt"))


def chart_url(ticker: Column) -> Column:
    return F.when(ticker.isNotNull() & (ticker != ""),
                  F.concat(F.lit("https://www.tradingview.com/symbols/"), ticker, F.lit("/")))


def alert_key(ticker: Column, published_iso: Column) -> Column:
    """``TICKER-YYYY-MM-DD`` (blank time gives ``TICKER-``)."""
    return F.concat(ticker, F.lit("-"), F.substring(F.coalesce(published_iso, F.lit("")), 1, 10))
