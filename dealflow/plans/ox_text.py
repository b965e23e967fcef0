"""DuckDB spellings of the text operators, for the oracles.

RE2's ``\\s`` is ASCII and has no ``(?U)``; where the Spark pattern uses
``(?U)`` to see a no-break space, the SQL spells ``[\\s\\x{00A0}]``.
DuckDB has no HTML entity decoder: the oracle decodes the named entities
listed below and leaves others, so pages with other entities would show as
mismatches rather than pass silently.
"""

from __future__ import annotations

from dealflow.functions import text as T

# Entities decoded by the SQL oracle (a subset of HTML5's).
ORACLE_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
                   ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"),
                   ("&reg;", "®"), ("&mdash;", "—"), ("&ndash;", "–"), ("&amp;", "&"))


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def re2(p: str) -> str:
    """Python's ``\\s`` spelled as the explicit class (same as the Spark side)."""
    return T.py_ws(p, re2=True)


def chars_sql(chars: str) -> str:
    return "(" + " || ".join(f"chr({ord(c)})" for c in chars) + ")"


WS_SQL = chars_sql(T.WS_CHARS)


def strip_sql(x: str) -> str:
    return f"trim({x}, {WS_SQL})"


def rstrip_sql(x: str) -> str:
    return f"rtrim({x}, {WS_SQL})"


def clean_html_sql(raw: str) -> str:
    t = f"regexp_replace({raw}, {q(T.MARKUP_RE2)}, chr(10), 'g')"
    for ent, ch in ORACLE_ENTITIES:
        t = f"replace({t}, {q(ent)}, {q(ch)})"
    return strip_sql(f"regexp_replace({t}, {q(T.WS_NO_NL_RE2 + '*' + chr(92) + 'n' + T.WS_RE2 + '*')}, chr(10), 'g')")


def regex_pos_sql(text: str, pattern: str) -> str:
    """1-based start of the leftmost match, null when none."""
    return (f"(CASE WHEN regexp_matches({text}, {q(pattern)}) "
            f"THEN length(regexp_extract({text}, {q('(?s)^(.*?)(?:' + pattern + ')')}, 1)) + 1 END)")


def _capped_sql(x: str, max_chars: int | None) -> str:
    return f"substr({x}, 1, {max_chars})" if max_chars else x


def section_v2_sql(text: str, max_chars: int | None = T.SECTION_CHARS_V2) -> str:
    starts = [regex_pos_sql(text, "(?i)" + re2(p)) for p in T.SECTION_START_V2]
    start = f"coalesce({', '.join(starts)})"
    tail = f"substr({text}, {start} + 100)"
    ends = "(?i)(?:" + "|".join(re2(p) for p in T.SECTION_END_V2) + ")"
    end = f"({regex_pos_sql(tail, ends)} + 99)"
    length = f"coalesce({end}, length({text}) - {start} + 1)"
    section = strip_sql(f'substr({text}, {start}, {length})')
    return f"(CASE WHEN {start} IS NOT NULL THEN {_capped_sql(section, max_chars)} ELSE {_capped_sql(text, max_chars)} END)"


def section_v1_sql(doc: str, max_chars: int | None = T.SECTION_CHARS_V1) -> str:
    low = f"lower({doc})"
    start = f"(CASE WHEN instr({low}, 'item 1.01') > 0 THEN instr({low}, 'item 1.01') ELSE instr({low}, 'item 1.1') END)"
    rel = f"substr({doc}, {start})"
    ends = [f"(CASE WHEN instr(substr(lower({rel}), 101), {q(m)}) > 0 THEN instr(substr(lower({rel}), 101), {q(m)}) + 99 END)"
            for m in T.SECTION_END_V1]
    end = f"coalesce(least({', '.join(ends)}), length({rel}))"
    return (f"(CASE WHEN {start} > 0 THEN {_capped_sql(f'substr({rel}, 1, {end})', max_chars)} "
            f"ELSE {_capped_sql(doc, max_chars)} END)")


def to_usd_sql(amount: str, unit: str) -> str:
    num = f"TRY_CAST(replace({amount}, ',', '') AS DOUBLE)"
    u = f"lower({unit})"
    return (f"(CASE WHEN coalesce({unit}, '') = '' THEN {num} "
            f"WHEN {u} IN ('billion', 'billions', 'bn', 'b') THEN {num} * 1e9 "
            f"WHEN {u} IN ('million', 'millions', 'mm', 'm') THEN {num} * 1e6 "
            f"WHEN {u} IN ('thousand', 'thousands', 'k') THEN {num} * 1e3 ELSE {num} END)")


def deal_value_sql(text: str, compat: bool = True) -> str:
    n = T._NUM if compat else T._NUM_BOUNDED
    vals = []
    for p in T.DEAL_VALUE_PATTERNS:
        rx = "(?i)" + re2(p.replace("{n}", n))
        v = to_usd_sql(f"regexp_extract({text}, {q(rx)}, 1)", f"regexp_extract({text}, {q(rx)}, 2)")
        vals.append(f"(CASE WHEN regexp_matches({text}, {q(rx)}) AND {v} > {float(T.MIN_DEAL_VALUE)} THEN {v} END)")
    return f"coalesce({', '.join(vals)})"


def rfind_sql(chunk: str, pat: str) -> str:
    return (f"(CASE WHEN instr(reverse({chunk}), {q(pat[::-1])}) > 0 "
            f"THEN length({chunk}) - instr(reverse({chunk}), {q(pat[::-1])}) - {len(pat) - 1} ELSE -1 END)")


def truncate_sql(text: str, max_len: int = 1020) -> str:
    chunk = f"substr({text}, 1, {max_len})"
    last = f"greatest({', '.join(rfind_sql(chunk, p) for p in ('. ', '! ', '? ', '.' + chr(10)))})"
    return (f"(CASE WHEN length({text}) <= {max_len} THEN {text} "
            f"WHEN {last} > {max_len // 2} THEN substr({chunk}, 1, {last} + 1) "
            f"ELSE {rstrip_sql(chunk)} || '…' END)")


def any_pattern_sql(text: str, patterns) -> str:
    return f"regexp_matches({text}, {q('(?i)(?:' + '|'.join(f'(?:{re2(p)})' for p in patterns) + ')')})"


def keyword_gate_sql(text: str) -> str:
    return (f"({any_pattern_sql(text, T.MA_KEYWORDS_STRONG)} OR (NOT {any_pattern_sql(text, T.MA_EXCLUSIONS)} "
            f"AND {any_pattern_sql(text, T.MA_KEYWORDS_WEAK)}))")


def company_sql(doc: str, head: int | None = 50) -> str:
    lines = f"string_split({doc}, chr(10))" + (f"[1:{head}]" if head else "")
    hit = (f"list_filter({lines}, "
           f"lambda l: contains(upper(l), 'COMPANY CONFORMED NAME'))[1]")
    return f"coalesce({strip_sql(f'string_split({hit}, chr(58))[-1]')}, 'Unknown Company')"


def ticker_v2_sql(doc: str, compat: bool = True) -> str:
    outs = []
    for p in T.TICKER_PATTERNS_V2:
        rx = re2("(?i)" + p if compat else T._case_sensitive_capture(p))
        outs.append(f"nullif(regexp_extract({doc}, {q(rx)}, 1), '')")
    return f"upper(coalesce({', '.join(outs)}))"


def re2_guard() -> str:
    """F11's pattern in RE2 spelling (``\\x{00A0}`` is the same in both)."""
    return T.MONEY_OR_PERCENT_RE2
