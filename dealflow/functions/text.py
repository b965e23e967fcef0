"""Text extraction over document columns: T1-T12, F2, F4, F11.

Short texts and single tests are built-in column expressions.  The scans of
whole documents (T1, T3, T6, T7 and the searches of T4 and T8) are small
functions of one text, run on Arrow batches: Spark's own form of them reads a
document once per marker, line rule or pattern and measured 4 to 10 times
slower.  What they find (a line, a section, a match) goes back to columns.
Several scans of one document run as one function (``Scans``).  A pattern is
only tried where a word stands with which all its matches begin (``first_match``).

Regex notes: Java's and RE2's ``\\s`` are ASCII while Python's is Unicode.
Patterns that follow the reference's ``\\s`` spell Python's whitespace set
as an explicit class (``WS``), which Java and RE2 read the same way.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Python's whitespace: every character for which str.isspace() is true.  The
# set follows from that rule; both Spark (Java regex, trim) and the DuckDB
# oracle (RE2, trim) use it, so "\s" means the same thing in all three.
WS_CHARS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def _cls(chars: str) -> str:
    return "[" + "".join(f"\\x{{{ord(c):X}}}" for c in chars) + "]"


# Java spelling: Unicode White_Space plus the four separators Python adds
# (U+001C-U+001F).  One property lookup per character.
WS = r"[\x{1C}-\x{1F}\p{IsWhite_Space}]"
# the same set inside a class of its own, and with a colon (for ``[:\s]``)
WS_OR_COLON = r"[:\x{1C}-\x{1F}\p{IsWhite_Space}]"
WS_NO_NL = r"[\x{1C}-\x{1F}\p{IsWhite_Space}&&[^\n]]"
NOT_WS = r"[^\x{1C}-\x{1F}\p{IsWhite_Space}]"
# RE2 spelling of the same sets, for the DuckDB oracle.
WS_RE2 = _cls(WS_CHARS)
WS_NO_NL_RE2 = _cls(WS_CHARS.replace("\n", ""))
WS_OR_COLON_RE2 = "[:" + WS_RE2[1:]
NOT_WS_RE2 = "[^" + WS_RE2[1:]


def py_ws(pattern: str, re2: bool = False) -> str:
    """Spell Python's Unicode ``\\s`` and ``[:\\s]`` explicitly (the only class it occurs in)."""
    pattern = pattern.replace(r"[:\s]", WS_OR_COLON_RE2 if re2 else WS_OR_COLON)
    return pattern.replace(r"\s", WS_RE2 if re2 else WS)


def per_text(f: Callable, returns: str = "string") -> Callable:
    """``f`` of every text of a column, by Arrow batches (a null text: null); ``returns``: one of ``_KINDS``."""
    @F.arrow_udf(returns)
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else f(t) for t in texts.to_pylist()], _KINDS[returns])

    return run


_KINDS = {"string": pa.string(), "array<string>": pa.list_(pa.string()), "bigint": pa.int64(), "boolean": pa.bool_()}


class Scans:
    """Rows whose texts have scans to come: the ``with_`` operators add theirs, and ``run`` gives the DataFrame.

    All scans run as one function on Arrow batches, so that a text goes to Python once, whichever of them read it.
    ``inside`` names texts that only other scans read: they don't come back as columns.  What an operator makes of
    its scan by column expressions follows after the scans."""

    def __init__(self, df: DataFrame, *inside: str):
        self.df, self.inside, self.scans, self.after = df, inside, [], []

    def _and(self, scans: list, after: list) -> Scans:
        more = Scans(self.df, *self.inside)
        more.scans, more.after = self.scans + scans, self.after + after
        return more

    def scan(self, out: str, f: Callable, text: str, returns: str) -> Scans:
        return self._and([(out, f, text, returns)], [])

    def withColumn(self, name: str, column: Column) -> Scans:
        return self._and([], [lambda d: d.withColumn(name, column)])

    def drop(self, *names: str) -> Scans:
        return self._and([], [lambda d: d.drop(*names)])

    def run(self) -> DataFrame:
        at: dict[str, int] = {}                                 # a name's place among a row's values
        made = {out for out, *_ in self.scans}
        given = [*dict.fromkeys(text for _, _, text, _ in self.scans if text not in made)]
        for name in (*given, *(out for out, *_ in self.scans)):
            at[name] = len(at)
        steps = [(f, at[text]) for _, f, text, _ in self.scans]
        kept = [(out, kind) for out, _, _, kind in self.scans if out not in self.inside]
        places, kinds, names = [at[out] for out, _ in kept], [_KINDS[kind] for _, kind in kept], [out for out, _ in kept]

        @F.arrow_udf(", ".join(f"`{out}` {kind}" for out, kind in kept))
        def run(*texts: pa.Array) -> pa.Array:
            columns: list[list] = [[] for _ in kinds]
            for row in zip(*texts):
                values = [x.as_py() for x in row]
                for f, i in steps:
                    values.append(None if values[i] is None else f(values[i]))
                for column, i in zip(columns, places):
                    column.append(values[i])
            return pa.StructArray.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)

        d = self.df.withColumn("_scans", run(*(F.col(c) for c in given)))
        for out in names:
            d = d.withColumn(out, F.col("_scans").getField(out))
        d = d.drop("_scans")
        for step in self.after:
            d = step(d)
        return d


def scanned(df: DataFrame | Scans, out: str, f: Callable, text: str, returns: str = "string") -> DataFrame | Scans:
    """``df`` with the column ``out``: ``f`` of every text of the column ``text``."""
    if isinstance(df, Scans):
        return df.scan(out, f, text, returns)
    return df.withColumn(out, per_text(f, returns)(F.col(text)))


def with_length(df: DataFrame | Scans, text: str, out: str) -> DataFrame | Scans:
    """Characters of a text (of a Scans' inside texts too)."""
    if isinstance(df, Scans):
        return df.scan(out, len, text, "bigint")
    return df.withColumn(out, F.length(text).cast("bigint"))


def ascii_lower(t: str) -> str:
    """``t`` character by character: ASCII letters in lower case, what is beyond Latin-1 as ``?``."""
    return t.encode("latin-1", "replace").lower().decode("latin-1")


def first_match(pattern: re.Pattern, words: tuple[str, ...], t: str, low: str, start: int = 0,
                end: int | None = None) -> re.Match | None:
    """``pattern.search(t, start)`` where each match begins with one of ``words``, before ``end``; ``low`` is
    ``ascii_lower(t)``."""
    best, end = None, len(low) if end is None else end
    for w in words:
        to = min(end, best.start() + len(w) - 1) if best else end       # a further word must begin before the match
        i = low.find(w, start, to)
        while i >= 0:
            if m := pattern.match(t, i):
                best = m
                break
            i = low.find(w, i + 1, to)
    return best


def scan(pattern: str) -> re.Pattern:
    """A document pattern as Java reads it: only ASCII letters lose their case, ``\\s`` is Python's white space."""
    ws = "[" + re.escape(WS_CHARS) + "]"
    return re.compile(pattern.replace(r"[:\s]", "[:" + ws[1:]).replace(r"\s", ws), re.IGNORECASE | re.ASCII)


def pystrip(c: Column) -> Column:
    """``str.strip()``: trim Python whitespace from both ends."""
    return F.trim(c, F.lit(WS_CHARS))


def pyrstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(WS_CHARS))


# --------------------------------------------------------------------------
# HTML to text
# --------------------------------------------------------------------------

# What is not text, as one pattern, so that each piece is read once and from its own start: comments; script, style
# and noscript with their bodies (unclosed: to the end); tags.  A tag starts with ``<`` and a letter, ``/``, ``!`` or
# ``?``; any other ``<`` is text.  A quote after ``=`` hides ``>`` up to its partner; without one it is a mere character.
_GAP = r"[ \t\n\r\f]"
_ATTRIBUTES = rf"""(?:[^>=]++|={_GAP}*+"[^"]*+"|={_GAP}*+'[^']*+'|=)*+"""
_BODIES = "|".join(rf"{t}(?:(?:{_GAP}|/){_ATTRIBUTES})?>.*?(?:</{t}(?:{_GAP}|/)*+>|\z)" for t in ("script", "style", "noscript"))
MARKUP = rf"(?is)<(?:!--.*?(?:-->|\z)|{_BODIES}|[a-z]{_ATTRIBUTES}>|[a-z/!?][^>]*+>)"
# RE2 never backtracks and has no possessive form
MARKUP_RE2 = MARKUP.replace("*+", "*").replace("++", "+")


_MARKUP = re.compile(MARKUP.replace(r"\z", r"\Z"), re.ASCII)


def _text_of(raw: str, decode: bool) -> str:
    t = _MARKUP.sub("\n", raw)
    if decode:
        t = html.unescape(t)
    return "\n".join(filter(None, map(str.strip, t.split("\n"))))


def with_clean_html(df: DataFrame | Scans, raw: str, out: str, decode: bool = True) -> DataFrame | Scans:
    """Text nodes, one stripped non-blank line each, joined by newlines.

    Comments, doctype and the bodies of script, style and noscript go; every
    other tag becomes a line break.  A ``>`` inside a quoted attribute does not
    end its tag; an unclosed comment or body goes to the end of the text."""
    return scanned(df, out, lambda t: _text_of(t, decode), raw)


def cleaning_ratio(raw: Column, clean: Column) -> Column:
    """Characters kept as a percentage of the raw length (0 for empty)."""
    return F.when(F.length(raw) > 0, F.length(clean) / F.length(raw) * 100).otherwise(F.lit(0.0))


# --------------------------------------------------------------------------
# T3 company name, T4/T5 ticker from document
# --------------------------------------------------------------------------

DEFAULT_COMPANY = "Unknown Company"


def company_name(doc: Column, head_lines: int | None = None) -> Column:
    """Text after the last colon of the first ``COMPANY CONFORMED NAME``
    line (``head_lines``: only within so many first lines)."""
    return F.coalesce(per_text(_company(head_lines))(doc), F.lit(DEFAULT_COMPANY))


def with_company_name(df: DataFrame | Scans, doc: str, out: str, head_lines: int | None = None) -> DataFrame | Scans:
    """T3 as a scan."""
    return scanned(df, out, _company(head_lines), doc).withColumn(out, F.coalesce(out, F.lit(DEFAULT_COMPANY)))


def _head(t: str, lines: int | None) -> str:
    return "\n".join(t.split("\n", lines)[:lines]) if lines else t


def _lines_with(t: str, words: tuple[str, ...]) -> list[str]:
    """The lines that hold one of ``words`` (ASCII, lower case), in order."""
    low, found = ascii_lower(t), {}
    for w in words:
        i = low.find(w)
        while i >= 0:
            end = low.find("\n", i)
            end = len(low) if end < 0 else end
            found[low.rfind("\n", 0, i) + 1] = end
            i = low.find(w, end)
    return [t[a:found[a]] for a in sorted(found)]


def _company(head_lines: int | None) -> Callable[[str], str]:
    def name(t: str) -> str:
        t = _head(t, head_lines)
        i = ascii_lower(t).find("company conformed name")
        return t[i:].partition("\n")[0].rpartition(":")[2].strip() if i >= 0 else DEFAULT_COMPANY

    return name


_ERR = "!ERR"


def _ticker_line_v1(l: Column, segment: int | None = None) -> Column:
    u = F.upper(l)
    parts = F.split(l, ":")
    has_parts = F.size(parts) > 1
    tok = F.regexp_extract(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")), "^" + WS + "*(" + NOT_WS + "+)", 1)
    clean = F.regexp_replace(tok, r"[,.()]", "")
    ok = (clean != "") & (F.length(clean) <= 5)
    r1 = u.contains("TRADING SYMBOL") | u.contains("TICKER SYMBOL")
    r2 = u.contains("NASDAQ:") | u.contains("NYSE:")
    r3 = u.contains("(NASDAQ:") | u.contains("(NYSE:")
    start = F.when(u.contains("(NASDAQ:"), F.instr(u, "(NASDAQ:")).otherwise(F.instr(u, "(NYSE:"))
    seg = F.substring(l, start, segment or 2147483647)
    t3 = F.regexp_replace(pystrip(F.substring_index(F.try_element_at(F.split(seg, ":"), F.lit(2)), ")", 1)),
                          r"[,.]", "")
    ok3 = (t3 != "") & (F.length(t3) <= 5)
    pot = pystrip(F.substring_index(F.try_element_at(F.split(l, r"\("), F.lit(-1)), ")", 1))
    r4 = u.contains("COMPANY") & l.contains("(") & l.contains(")")
    ok4 = (F.length(pot) >= 2) & (F.length(pot) <= 5) & F.replace(pot, F.lit("."), F.lit("")).rlike(r"^\p{L}+$")
    return (F.when(r1 & has_parts & (tok == ""), F.lit(_ERR))
            .when(r1 & has_parts & ok, F.upper(clean))
            .when(r2 & has_parts & (tok == ""), F.lit(_ERR))
            .when(r2 & has_parts & ok, F.upper(clean))
            .when(r3 & ok3, F.upper(t3))
            .when(r4 & ok4, F.upper(pot)))


# Lines that can satisfy a rule contain one of these (any case).
_V1_TRIGGERS = ("symbol", "nasdaq:", "nyse:", "company")


# The v1 scanner's bounds, for readings that must equal it.
V1_TICKER_LINES, V1_TICKER_SEGMENT = 200, 20


def with_ticker_v1(df: DataFrame | Scans, doc: str, out: str | None = None, head_lines: int | None = None,
                   segment: int | None = None, corrected: str | None = None) -> DataFrame | Scans:
    """T4: four line rules, line order first.  A rule-1/2 line whose remainder
    is empty aborts the document (null) in the reference's reading (``out``);
    the ``corrected`` reading skips that line.  ``head_lines`` and ``segment``
    (characters looked at after an exchange mark) bound it as the reference
    does; without them whole texts and lines are read.

    Only lines holding a rule's trigger word can match, so one pass picks
    those lines (in order), the rules run on them once, and both readings are
    taken from the same hits."""
    tmp, picked = f"_{out or corrected}_hits", f"_{out or corrected}_lines"

    d = scanned(df, picked, lambda t: _lines_with(_head(t, head_lines), _V1_TRIGGERS), doc, "array<string>")
    d = d.withColumn(tmp, F.filter(F.transform(picked, lambda l: _ticker_line_v1(l, segment)), lambda x: x.isNotNull()))
    first = F.try_element_at(F.col(tmp), F.lit(1))
    if out:
        d = d.withColumn(out, F.when(first != _ERR, first))
    if corrected:
        d = d.withColumn(corrected, F.try_element_at(F.filter(tmp, lambda x: x != _ERR), F.lit(1)))
    return d.drop(tmp, picked)


_TICK = r"([A-Z]{1,5}(?:[.\-][A-Z]{1,3})?)"
# The v2 document ticker patterns, in priority order.
TICKER_PATTERNS_V2 = (
    r"trading\s+symbol[:\s]+" + _TICK,
    r"ticker\s+symbol[:\s]+" + _TICK,
    r"nasdaq[:\s]+" + _TICK,
    r"nyse[:\s]+" + _TICK,
    r"nyse\s+(?:american|arca)[:\s]+([A-Z]{1,5})",
)


def ticker_v2(doc: Column, compat: bool = True) -> Column:
    """T5: first pattern that matches, upper-cased.  Compat is the reference's
    case-insensitive capture; corrected capture is case-sensitive with a right
    word boundary."""
    outs = []
    for p in TICKER_PATTERNS_V2:
        rx = "(?i)" + p if compat else _case_sensitive_capture(p)
        outs.append(F.nullif(F.regexp_extract(doc, py_ws(rx), 1), F.lit("")))
    return F.upper(F.coalesce(*outs))


def _case_sensitive_capture(p: str) -> str:
    i = p.index("[:\\s]+")
    return "(?i:" + p[:i] + ")[:\\s]+" + p[i + len("[:\\s]+"):] + r"\b"


# --------------------------------------------------------------------------
# Section cut
# --------------------------------------------------------------------------

# v1 markers.
SECTION_END_V1 = ("item 2.", "item 3.", "item 5.", "item 7.", "item 8.", "item 9.", "signature")
_END_V1 = re.compile("|".join(map(re.escape, SECTION_END_V1)))
_END_WORDS_V1 = ("item ", "signature")


def _capped(c: Column, max_chars: int | None) -> Column:
    return F.substring(c, 1, max_chars) if max_chars else c


# The reference's section lengths, for readings that must equal it.
SECTION_CHARS_V1, SECTION_CHARS_V2 = 6000, 12000


def section_v1(doc: Column, max_chars: int | None = None) -> Column:
    """From ``item 1.01`` (else ``item 1.1``) to the earliest end marker
    found from offset 100; without a start, the whole text.  ``max_chars``
    caps either as the reference does."""
    return per_text(_section_v1(max_chars))(doc)


def with_section_v1(df: DataFrame | Scans, doc: str, out: str, max_chars: int | None = None) -> DataFrame | Scans:
    """T6 as a scan."""
    return scanned(df, out, _section_v1(max_chars), doc)


def _section_v1(max_chars: int | None) -> Callable[[str], str]:
    def cut(t: str) -> str:
        longer = "\u0130" in t                                  # the one letter whose lower case is two characters
        low = t.lower() if longer else ascii_lower(t)
        start = low.find("item 1.01")
        if start < 0:
            start = low.find("item 1.1")
        if start < 0:
            return t[:max_chars]
        rel = t[start:]
        low = rel.lower() if longer else low[start:]
        end = first_match(_END_V1, _END_WORDS_V1, low, low, 100)
        return rel[:end.start() if end else len(rel)][:max_chars]

    return cut


# v2 start patterns (priority order) and end patterns.
SECTION_START_V2 = (r"Item\s*1\.01", r"Item\s*1\s*\.\s*01", r"ITEM\s*1\.01",
                    r"Entry into a Material Definitive Agreement")
SECTION_END_V2 = (r"Item\s*[2-9]\.\d+", r"ITEM\s*[2-9]", r"SIGNATURES?",
                  r"Pursuant\s+to\s+the\s+requirements", r"SIGNATURE\s+PAGE")
_STARTS_V2 = tuple((scan(p), (w,)) for p, w in zip(SECTION_START_V2, ("item", "item", "item", "entry")))
_END_V2 = scan("|".join(SECTION_END_V2))
_END_WORDS_V2 = ("item", "signature", "pursuant")


def with_section_v2(df: DataFrame | Scans, text: str, out: str, max_chars: int | None = None) -> DataFrame | Scans:
    """Start at the first start *pattern* that matches anywhere; end at the
    earliest end-pattern match from start+100 (one alternation finds the
    leftmost match of any end pattern); strip.  Without a start, the whole
    text.  ``max_chars`` caps either as the reference does."""
    def cut(t: str) -> str:
        low = ascii_lower(t)
        # priority order, not earliest position: a later pattern only runs while every earlier one has found nothing
        start = next((m.start() for p, ws in _STARTS_V2 if (m := first_match(p, ws, t, low))), None)
        if start is None:
            return t[:max_chars]
        end = first_match(_END_V2, _END_WORDS_V2, t, low, start + 100)
        return t[start:end.start() if end else len(t)].strip()[:max_chars]

    return scanned(df, out, cut, text)


# --------------------------------------------------------------------------
# Deal value
# --------------------------------------------------------------------------

_NUM = r"\$\s*([\d,]+\.?\d*)\s*(billion|millions?|bn|mm?|b|k)?"
_NUM_BOUNDED = r"\$\s*([\d,]+\.?\d*)\s*(?:(billion|millions?|bn|mm?|b|k)\b)?"
# Money patterns in priority order ({n} is the number).
DEAL_VALUE_PATTERNS = (
    r"(?:aggregate|total|purchase|transaction|deal|enterprise)\s+(?:consideration|price|value|amount)\s+of\s+approximately\s+{n}",
    r"(?:aggregate|total|purchase|transaction|deal|enterprise)\s+(?:consideration|price|value|amount)\s+of\s+{n}",
    r"consideration\s+of\s+approximately\s+{n}",
    r"valued\s+at\s+approximately\s+{n}",
    r"{n}\s+in\s+(?:cash|all.cash)",
    r"offer\s+price\s+of\s+{n}\s+per\s+share",
)
MIN_DEAL_VALUE = 1_000_000


def to_usd(amount: Column, unit: Column) -> Column:
    """Number with thousands separators times its unit."""
    num = F.replace(amount, F.lit(","), F.lit("")).try_cast("double")
    u = F.lower(unit)
    mult = (F.when(u.isin("billion", "billions", "bn", "b"), F.lit(1e9))
            .when(u.isin("million", "millions", "mm", "m"), F.lit(1e6))
            .when(u.isin("thousand", "thousands", "k"), F.lit(1e3))
            .otherwise(F.lit(None).cast("double")))
    return F.when(F.coalesce(unit, F.lit("")) == "", num).otherwise(F.when(mult.isNull(), num)
                                                                       .otherwise(num * mult))


# For each pattern: words of which every match begins with one; a word before its ``$`` and one after, for a cheap skip.
_DEAL_SUBJECTS = ("aggregate", "total", "purchase", "transaction", "deal", "enterprise")
_DEAL_WORDS = ((_DEAL_SUBJECTS, "approximately", ""), (_DEAL_SUBJECTS, "", ""), (("consideration",), "approximately", ""),
               (("valued",), "approximately", ""), (("$",), "", "cash"), (("offer",), "price", "share"))


def with_deal_value(df: DataFrame | Scans, text: str, out: str | None = None, bounded: str | None = None,
                    patterns=DEAL_VALUE_PATTERNS, minimum: float = MIN_DEAL_VALUE) -> DataFrame | Scans:
    """First pattern whose first match converts to more than ``minimum``.

    ``out`` is the reference's reading of the unit, ``bounded`` the corrected
    one, which needs a word boundary after the unit.  Every pattern needs a
    ``$`` and its keywords, so its scan only runs on texts that contain them
    (checked on a lower-cased copy made once), from its first words before the
    last ``$``.  A pattern is scanned once for both readings: its first match is
    the same in either, and the amount, the unit and the character after it are
    read from that short match.  The conversions run over the list of matches,
    in one piece of code."""
    keys = _DEAL_WORDS if patterns is DEAL_VALUE_PATTERNS else ((None, "", ""),) * len(patterns)
    loose = ["(?i)" + py_ws(p.replace("{n}", _NUM)) for p in patterns]
    tight = ["(?i)" + py_ws(p.replace("{n}", _NUM_BOUNDED)) for p in patterns]
    scans = [(scan(p.replace("{n}", _NUM) + "[A-Za-z0-9_]?"), *ws) for p, ws in zip(patterns, keys)]
    name = out or bounded
    found, hits = f"_{name}_found", f"_{name}_hits"

    def matches(t: str) -> list[str | None]:
        if "$" not in t:
            return []
        low = ascii_lower(t)
        first, end = low.find("$"), low.rfind("$") + 1
        ms = ((first_match(p, begins, t, low, 0, end) if begins else p.search(t))
              if low.find(before, 0, end) >= 0 and low.find(after, first) >= 0 else None for p, begins, before, after in scans)
        return [m and m[0] for m in ms]

    d = scanned(df, found, matches, text, "array<string>")
    m = [F.get(found, F.lit(i)) for i in range(len(patterns))]
    none = F.lit(None).cast("struct<amount:string,unit:string,whole:string>")
    d = d.withColumn(hits, F.array_compact(F.array(*(
        F.when(F.coalesce(x, F.lit("")) != "", F.struct(
            F.regexp_extract(x, rx, 1).alias("amount"), F.regexp_extract(x, rx, 2).alias("unit"),
            F.regexp_extract(x, rt, 2).alias("whole"))).otherwise(none)
        for x, rx, rt in zip(m, loose, tight)))))
    for c, unit in ((out, "unit"), (bounded, "whole")):
        if c:
            values = F.transform(hits, lambda h: to_usd(h["amount"], h[unit]))
            d = d.withColumn(c, F.try_element_at(F.filter(values, lambda v: v > F.lit(float(minimum))), F.lit(1)))
    return d.drop(found, hits)


# --------------------------------------------------------------------------
# T10 truncation, F11 guard
# --------------------------------------------------------------------------

def _rfind(chunk: Column, pat: str) -> Column:
    """0-based index of the last occurrence of ``pat`` in ``chunk``, or -1."""
    i = F.instr(F.reverse(chunk), pat[::-1])
    return F.when(i > 0, F.length(chunk) - i - F.lit(len(pat) - 1)).otherwise(F.lit(-1))


def truncate_sentence(text: Column, max_len: int = 1020) -> Column:
    """Unchanged when short; else cut after the last sentence end past
    the middle, or right-strip and add an ellipsis."""
    chunk = F.substring(text, 1, max_len)
    last = F.greatest(*[_rfind(chunk, p) for p in (". ", "! ", "? ", ".\n")])
    cut = F.when(last > F.lit(max_len // 2), F.substring(chunk, 1, last + 1)) \
           .otherwise(F.concat(pyrstrip(chunk), F.lit("…")))
    return F.when(F.length(text) <= max_len, text).otherwise(cut)


# Fixed value: money or decimal-percent guard, as written in the reference:
#   \$[\d,]+|\b\d+[.,]\d+\s*%
# spelled with an explicit Unicode word boundary so that Java and RE2 agree.
_MONEY = r"\$[\d,]+|(?:^|[^\p{L}\p{N}_])\d+[.,]\d+{ws}*%"
MONEY_OR_PERCENT = _MONEY.replace("{ws}", WS)
MONEY_OR_PERCENT_RE2 = _MONEY.replace("{ws}", WS_RE2)


def verdict_guard(text: Column) -> Column:
    """strip, then blank the verdict if it quotes money or a decimal percent."""
    t = pystrip(F.coalesce(text, F.lit("")))
    return F.when(t.rlike(MONEY_OR_PERCENT), F.lit("")).otherwise(t)


# --------------------------------------------------------------------------
# F2 item tests, F4 keyword gate
# --------------------------------------------------------------------------

def has_item_101_v1(doc: Column) -> Column:
    """F2 (v1): substring test, so ``item 1.10`` also passes."""
    low = F.lower(doc)
    return low.contains("item 1.01") | low.contains("item 1.1")


def has_item_101_v2(doc: Column) -> Column:
    """F2 (v2): ``item\\s*1\\.01`` on raw text; a no-break space counts."""
    return doc.rlike("(?i)item" + WS + r"*1\.01")


# Keyword lists of the M&A gate (strong, weak, exclusions).
MA_KEYWORDS_STRONG = (
    r"merger\s+agreement", r"acquisition\s+agreement", r"to\s+be\s+acquired", r"will\s+acquire",
    r"has\s+agreed\s+to\s+(?:acquire|merge)", r"all.cash\s+(?:offer|transaction|deal|merger)",
    r"tender\s+offer", r"going\s+private", r"take.private", r"leveraged\s+buyout", r"\blbo\b",
    r"acquired\s+by\b", r"acquisition\s+of\s+(?:all|the)\s+(?:outstanding|issued)",
    r"merger\s+with\b", r"agree(?:d|s)?\s+to\s+(?:acquire|merge)\b",
    r"definitive\s+(?:merger|acquisition|business\s+combination)\s+agreement",
)
MA_KEYWORDS_WEAK = (
    r"definitive\s+agreement", r"cash\s+consideration", r"purchase\s+(?:price|agreement)",
    r"offer\s+price", r"business\s+combination",
)
MA_EXCLUSIONS = (
    r"revolving\s+(?:credit|loan)", r"credit\s+(?:facility|agreement|line)", r"term\s+loan",
    r"line\s+of\s+credit", r"credit\s+and\s+security\s+agreement",
    r"senior\s+secured\s+(?:credit|revolving|term)", r"indenture", r"promissory\s+note",
    r"employment\s+agreement", r"executive\s+(?:employment|compensation|severance)",
    r"change\s+in\s+control\s+agreement", r"registration\s+rights\s+agreement",
    r"at.the.market\s+(?:offering|program)", r"equity\s+distribution\s+agreement",
    r"underwriting\s+agreement", r"loan\s+(?:agreement|amendment)", r"security\s+agreement",
)


def any_pattern(text: Column, patterns) -> Column:
    """One case-insensitive alternation per list (one regex pass per row).
    ``\\s`` is Python's, ``\\b`` ASCII as in RE2."""
    return text.rlike("(?i)(?:" + "|".join(f"(?:{py_ws(p)})" for p in patterns) + ")")


def _words(pattern: str) -> tuple[str, str]:
    """Of a keyword pattern (lower case): the letters with which all its matches begin, the longest that all hold."""
    flat = pattern.replace(r"\b", "")
    while "(" in flat:
        flat = re.sub(r"\([^()]*\)[?*]?", " ", flat)
    flat = re.sub(r"\\.|\[[^]]*\]|.[?*{]", " ", flat)          # classes, and letters that may be missing
    runs = [] if "|" in flat else re.findall("[a-z]+", flat)
    return runs[0] if runs and flat.startswith(runs[0]) else "", max(runs, key=len, default="")


_DOT = r"[^\n\r\x85\u2028\u2029]"


def holds_any(patterns) -> Callable[[str], bool]:
    """``any_pattern`` as a function of one text, for a scan: ``.`` is Java's, ``\\b`` ASCII whatever the Java."""
    tests = [(scan(p.replace(".", _DOT)), *_words(p)) for p in patterns]

    def holds(t: str) -> bool:
        low = ascii_lower(t)
        return any(word in low and (first_match(p, (begin,), t, low) if begin else p.search(t)) for p, begin, word in tests)

    return holds


def keyword_gate(text: Column, strong=MA_KEYWORDS_STRONG, weak=MA_KEYWORDS_WEAK,
                 exclusions=MA_EXCLUSIONS) -> Column:
    """strong wins; otherwise weak only when no exclusion matches."""
    return any_pattern(text, strong) | (~any_pattern(text, exclusions) & any_pattern(text, weak))


# --------------------------------------------------------------------------
# Model JSON out of free text
# --------------------------------------------------------------------------

def json_block_v2(text: Column) -> Column:
    """T12 (v2): greedy from the first ``{`` to the last ``}``."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def json_block_v1(text: Column) -> Column:
    """T12 (v1): inside the first json fence, else the first fence, else all."""
    t = pystrip(text)
    after_json = F.try_element_at(F.split(t, "```json", 2), F.lit(2))
    after_fence = F.try_element_at(F.split(t, "```", 3), F.lit(2))
    body = (F.when(t.contains("```json"), F.substring_index(after_json, "```", 1))
            .when(t.contains("```"), F.substring_index(after_fence, "```", 1))
            .otherwise(t))
    return pystrip(body)
