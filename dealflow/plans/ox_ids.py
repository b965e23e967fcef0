"""DuckDB spellings of the identifier functions (oracle side)."""

from __future__ import annotations

from dealflow.functions.text import py_ws


def dashed_sql(x: str) -> str:
    return (f"(CASE WHEN regexp_full_match({x}, '[0-9]{{18}}') THEN substr({x}, 1, 10) || '-' || "
            f"substr({x}, 11, 2) || '-' || substr({x}, 13, 6) END)")


def _parts(link: str):
    parts = f"string_split({link}, '/')"
    pos = f"coalesce(list_position({parts}, 'data'), 0)"
    ok = f"(contains({link}, '/Archives/edgar/data/') AND {pos} > 0 AND {pos} + 2 <= len({parts}))"
    return parts, pos, ok


def cik_title_v1_sql(title: str) -> str:
    last = f"split_part(string_split({title}, '(')[-1], ')', 1)"
    return (f"(CASE WHEN contains({title}, '(') AND contains({title}, ')') "
            f"AND regexp_full_match({last}, '[0-9]+') THEN {last} END)")


def cik_v1_sql(title: str, link: str) -> str:
    parts, pos, ok = _parts(link)
    return f"coalesce({cik_title_v1_sql(title)}, CASE WHEN {ok} THEN {parts}[{pos} + 1] END)"


def acc_feed_v1_sql(link: str) -> str:
    parts, pos, ok = _parts(link)
    return f"(CASE WHEN {ok} THEN {dashed_sql(f'{parts}[{pos} + 2]')} END)"


def acc_link_v1_sql(link: str) -> str:
    parts, pos, ok = _parts(link)
    part = f"{parts}[{pos} + 2]"
    from_path = (f"coalesce({dashed_sql(part)}, CASE WHEN contains({part}, '-') AND "
                 f"regexp_full_match(replace({part}, '-', ''), '[0-9]+') THEN split_part({part}, '-index', 1) END)")
    return (f"(CASE WHEN contains({link}, 'accession_number=') "
            f"THEN nullif(regexp_extract({link}, 'accession_number=([^&]*)', 1), '') "
            f"WHEN {ok} THEN {from_path} END)")


def acc_v1_sql(link: str) -> str:
    return f"coalesce({acc_feed_v1_sql(link)}, {acc_link_v1_sql(link)})"


def viewer_v1_sql(title: str, link: str) -> str:
    cik, acc = cik_v1_sql(title, link), acc_feed_v1_sql(link)
    return (f"(CASE WHEN {cik} IS NOT NULL AND {acc} IS NOT NULL THEN "
            f"'https://www.sec.gov/cgi-bin/viewer?action=view&cik=' || {cik} || '&accession_number=' || {acc} "
            f"|| '&xbrl_type=v' ELSE {link} END)")


def cik_v2_sql(link: str, eid: str) -> str:
    return (f"coalesce(nullif(regexp_extract({link}, '/data/(\\d+)/', 1), ''), "
            f"nullif(regexp_extract({eid}, '/data/(\\d+)/', 1), ''), "
            f"nullif(regexp_extract({link} || {eid}, '(?i)cik=(\\d+)', 1), ''))")


def acc_v2_sql(link: str, eid: str) -> str:
    d = "(\\d{10}-\\d{2}-\\d{6})"
    p = "/(\\d{18})/"
    return (f"coalesce(nullif(regexp_extract({link}, '{d}', 1), ''), nullif(regexp_extract({eid}, '{d}', 1), ''), "
            f"{dashed_sql(f'regexp_extract({link}, {chr(39)}{p}{chr(39)}, 1)')}, "
            f"{dashed_sql(f'regexp_extract({eid}, {chr(39)}{p}{chr(39)}, 1)')})")


def ticker_hint_sql(title: str) -> str:
    pattern = py_ws(r"\(([A-Z]{1,5}(?:[.\-][A-Z]{1,3})?)\)\s*$", re2=True)
    return f"nullif(regexp_extract({title}, '{pattern}', 1), '')"


def cik_strip_sql(c: str) -> str:
    return f"CAST(TRY_CAST({c} AS BIGINT) AS VARCHAR)"


def cik_pad_sql(c: str) -> str:
    return f"lpad({cik_strip_sql(c)}, 10, '0')"


def acc_diag_sql(link: str) -> str:
    dashes = "(length(p) - length(replace(p, '-', '')))"
    cands = (f"list_transform(list_filter(string_split({link}, '/'), lambda p: length(p) >= 18 AND {dashes} >= 2), "
             f"lambda p: replace(replace(p, '-index.htm', ''), '-index.html', ''))")
    two = f"list_filter({cands}, lambda p: {dashes} = 2)"
    return (f"(CASE WHEN contains({link}, 'accession_number=') "
            f"THEN nullif(regexp_extract({link}, 'accession_number=([^&]*)', 1), '') "
            f"WHEN contains({link}, '/Archives/edgar/data/') THEN coalesce({two}[1], {cands}[-1]) END)")


def cik_diag_sql(link: str) -> str:
    stripped = f"regexp_replace(regexp_extract({link}, 'cik=([^&]*)', 1), '^0+', '')"
    return (f"(CASE WHEN contains({link}, 'cik=') THEN (CASE WHEN {stripped} = '' THEN '0' ELSE {stripped} END) "
            f"WHEN contains({link}, '/data/') THEN nullif(regexp_extract({link}, '/data/([^/]*)', 1), '') END)")


def parse_published_sql(raw: str) -> str:
    s = f"trim({raw})"
    no_day = f"regexp_replace({s}, '^[A-Za-z]{{3}},\\s*', '')"
    body = f"substr({no_day}, 1, length({no_day}) - 6)"
    off = f"right({no_day}, 5)"
    off_min = (f"((CASE WHEN substr({off}, 1, 1) = '-' THEN -1 ELSE 1 END) * "
               f"(TRY_CAST(substr({off}, 2, 2) AS INTEGER) * 60 + TRY_CAST(substr({off}, 4, 2) AS INTEGER)))")
    rfc = (f"(CASE WHEN regexp_full_match({off}, '[+-][0-9]{{4}}') THEN "
           f"try_strptime({body}, '%d %b %Y %H:%M:%S') - {off_min} * INTERVAL 1 MINUTE END)")
    iso = f"try_strptime({s}, '%Y-%m-%dT%H:%M:%SZ')"
    bare = f"try_strptime({s}, '%Y-%m-%dT%H:%M:%S')"
    return f"coalesce({rfc}, {iso}, {bare})"


def iso_sql(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S')"
