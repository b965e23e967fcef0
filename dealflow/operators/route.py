"""Routing, signals, alert payloads and history rows: R3-R8, E9, T10, F11.

All column expressions; the payload is a struct serialised with
``to_json`` so a sink can write one JSON document per alert.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealflow.functions.identifiers import alert_key, chart_url
from dealflow.functions.numeric import shown, truthy
from dealflow.functions.text import _capped, truncate_sentence, verdict_guard
from dealflow.functions.timefns import filing_context, iso_seconds, local_time_v1, local_time_v2

# Fixed values (reference): priority thresholds and embed colours.
PRIORITY_BANDS = (("MEGA", 9), ("MAJOR", 7), ("STANDARD", 5))
PRIORITY_COLOR = {"MEGA": 15158332, "MAJOR": 16753920, "STANDARD": 16776960}
# Fixed values (reference): history signal codes.
SIGNAL_BUY_TARGET = "KUPUJ_TARGET"
SIGNAL_WATCH_ACQUIRER = "OBSERWUJ_ACQUIRERA"
SIGNAL_WATCH = "OBSERWUJ"
# Fixed values (reference): list caps of the v2 payload; text caps.
CAP_KEY_POINTS, CAP_RISKS, CAP_SYMPATHY = 4, 2, 3
CAP_FIELD_TEXT, CAP_REASONING = 1020, 200


def priority(score: Column) -> Column:
    """MEGA >= 9, MAJOR >= 7, STANDARD >= 5, else null (dropped, F8).
    A score that is not a number is null here; see ``route_outcome``."""
    s = score.cast("string").try_cast("double")
    out = F.lit(None).cast("string")
    for name, lo in reversed(PRIORITY_BANDS):
        out = F.when(s >= F.lit(float(lo)), F.lit(name)).otherwise(out)
    return out


def route_outcome(score: Column) -> Column:
    s = score.cast("string").try_cast("double")
    return (F.when(s.isNull(), F.lit("bad_score"))
            .when(priority(score).isNull(), F.lit("low_impact")).otherwise(F.lit("alert")))


def history_signal(role: Column, full: Column) -> tuple[Column, Column]:
    """(signal, direction) stored with the alert history."""
    is_buy = (role == "target") & F.coalesce(full, F.lit(False))
    sig = (F.when(is_buy, F.lit(SIGNAL_BUY_TARGET))
           .when(role == "acquirer", F.lit(SIGNAL_WATCH_ACQUIRER)).otherwise(F.lit(SIGNAL_WATCH)))
    direction = F.when(is_buy, F.lit("bullish")).otherwise(F.lit("neutral"))
    return sig, direction


def alert_signal(role: Column, full: Column, structure: Column, target_ticker: Column,
                 target_price: Column) -> Column:
    """The alert's trade signal by deal structure, as a stable code."""
    full_ = F.coalesce(full, F.lit(False))
    public_target = truthy_str(target_ticker) | truthy(target_price)
    return (F.when((role == "target") & full_,
                   F.when(structure == "all-cash", F.lit("BUY_TARGET"))
                   .when(structure.isin("all-stock", "mixed"), F.lit("SPECULATIVE_BUY_TARGET"))
                   .otherwise(F.lit("WATCH_TARGET")))
            .when(role == "acquirer", F.when(public_target, F.lit("WATCH_ACQUIRER_PUBLIC_TARGET"))
                  .otherwise(F.lit("WATCH_ACQUIRER_PRIVATE_TARGET")))
            .when(full_, F.lit("BUY_TARGET"))
            .otherwise(F.lit("WATCH")))


def truthy_str(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def volume_label(spike: Column) -> Column:
    """Volume spike label, shown only above 1.5x."""
    return (F.when(spike >= 10, F.lit("extreme")).when(spike >= 5, F.lit("very_high"))
            .when(spike >= 2, F.lit("elevated")))


def short_label(short_pct: Column) -> Column:
    """Short interest label in percent of float (only when truthy)."""
    sp = short_pct * 100
    return (F.when(~truthy(short_pct), F.lit(None).cast("string"))
            .when(sp >= 15, F.lit("high")).when(sp >= 7, F.lit("moderate")).otherwise(F.lit("low")))


def institutions_label(inst: Column) -> Column:
    """Institutional ownership label (only when above 0)."""
    p = F.coalesce(inst, F.lit(0.0)) * 100
    return (F.when(p <= 0, F.lit(None).cast("string"))
            .when(p >= 80, F.lit("near_certain")).when(p >= 50, F.lit("significant")).otherwise(F.lit("low")))


def week_move_label(chg: Column) -> Column:
    """A weekly move above 5 % in either direction."""
    return F.when(F.abs(chg) > 5, F.lit("already_moved"))


def display_ticker(df_cols: dict[str, Column], with_acquirer_model: bool = True) -> Column:
    """R8 key order: target market, target (model), acquirer market, acquirer
    (model).  The alert title leaves out the last step."""
    steps = [df_cols["tgt_ticker"], df_cols["target_ticker"], df_cols["acq_ticker"]]
    if with_acquirer_model:
        steps.append(df_cols["acquirer_ticker"])
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in steps])


def history_rows(df: DataFrame) -> DataFrame:
    """R8 + P12: one history row per routed alert with a ticker; the
    outcome fields are left for the tracker."""
    cols = {c: F.col(c) for c in ("tgt_ticker", "target_ticker", "acq_ticker", "acquirer_ticker")}
    tick = display_ticker(cols)
    sig, direction = history_signal(F.col("filer_role"), F.col("is_full_acquisition"))
    iso = F.coalesce(iso_seconds(F.col("published_ts")), F.lit(""))
    out = df.where(tick.isNotNull()).select(
        alert_key(tick, iso).alias("id"), tick.alias("ticker"), iso.alias("filing_timestamp"),
        filing_context(F.col("published_ts")).alias("filing_context"), F.col("priority"),
        sig.alias("signal"), direction.alias("direction"),
        F.coalesce(F.col("filer_role"), F.lit("unknown")).alias("filer_role"),
        "deal_type", F.coalesce(F.col("deal_structure"), F.lit("")).alias("deal_structure"),
        F.coalesce(F.col("is_full_acquisition"), F.lit(False)).alias("is_full_acquisition"),
        F.col("tgt_price").alias("price_at_filing"), F.col("offer_price_per_share").alias("offer_price"),
        F.col("premium_pct_checked").alias("premium_pct"), "deal_value_usd", "upside_pct",
        F.col("tgt_cap").alias("market_cap"), F.col("tgt_volume_spike").alias("volume_spike"),
        F.col("tgt_short_percent").alias("short_pct"), F.col("tgt_institutional_pct").alias("institutional_pct"),
        "acquirer", F.coalesce(F.nullif(F.col("acq_ticker"), F.lit("")), F.col("acquirer_ticker")).alias("acquirer_ticker"),
        F.col("impact_score").alias("groq_score"), F.col("confidence").alias("groq_confidence"),
        "short_squeeze_risk", F.lit("pending").alias("tracker_status"), "feed_rank")
    return out


def acquirer_week_label(chg: Column) -> Column:
    """How the market took the acquirer's week."""
    return F.when(chg >= 0, F.lit("market_accepts")).when(chg < 0, F.lit("market_doubts"))


def _bullets(arr: Column, cap: int | None) -> Column:
    some = F.coalesce(arr, F.array().cast("array<string>"))
    return F.array_join(F.transform(F.slice(some, 1, cap) if cap else some, lambda x: F.concat(F.lit("• "), x)), "\n")


def _tail(condition: Column, *parts: Column) -> Column:
    """Text that follows only where the condition holds."""
    return F.when(condition, F.concat(*parts)).otherwise(F.lit(""))


# Fixed values (reference): what the v2 payload shows of lists and texts at most.
V2_CAPS = {"key_points": CAP_KEY_POINTS, "risks": CAP_RISKS, "sympathy": CAP_SYMPATHY, "text": CAP_FIELD_TEXT,
           "reasoning": CAP_REASONING}


def alert_embed(df: DataFrame, caps: dict[str, int] | None = None) -> DataFrame:
    """R6 + R7 (v2 layout) as columns: ``title``, ``description``, ``color``,
    ``url`` and ``fields``, a list of (name, value, inline); parts whose
    condition fails are skipped.  ``caps`` bounds lists and texts (none: all
    is shown)."""
    caps = caps or {}
    cap_text = lambda c: truncate_sentence(c, caps["text"]) if "text" in caps else c
    # pieces used more than once get their own projection (smaller generated code)
    df = df.select(
        "*",
        display_ticker({c: F.col(c) for c in ("tgt_ticker", "target_ticker", "acq_ticker", "acquirer_ticker")},
                       with_acquirer_model=False).alias("_title_tick"),
        F.coalesce(F.nullif(F.col("target_company"), F.lit("")), F.col("company")).alias("_target_name"),
        F.trim(F.coalesce(F.col("deal_value"), F.lit(""))).alias("_dv"),
        volume_label(F.col("tgt_volume_spike")).alias("_vol_label"),
        short_label(F.col("tgt_short_percent")).alias("_short_label"),
        institutions_label(F.col("tgt_institutional_pct")).alias("_inst_label"),
        verdict_guard(F.col("analyst_verdict")).alias("_verdict"))
    title_tick, target_name, dv = F.col("_title_tick"), F.col("_target_name"), F.col("_dv")
    dv_ok = (dv != "") & ~F.lower(dv).isin("null", "undisclosed", "none")
    prem = F.col("premium_pct_checked").cast("string").try_cast("double")
    desc = F.concat_ws(
        "\n",
        F.when(truthy_str(F.col("alert_headline")), F.concat(F.lit("*"), F.col("alert_headline"), F.lit("*"))),
        F.concat(F.lit("Target: "), F.coalesce(target_name, F.lit("Unknown")),
                 _tail(truthy_str(F.col("tgt_ticker")), F.lit(" ("), F.col("tgt_ticker"), F.lit(")")),
                 F.lit(" | Acquirer: "), F.coalesce(F.col("acquirer"), F.lit("Unknown")),
                 _tail(truthy_str(F.col("acq_ticker")), F.lit(" ("), F.col("acq_ticker"), F.lit(")"))),
        F.when(dv_ok, F.concat(F.lit("Value: "), dv,
                               _tail(F.col("deal_value_source") == "regex_confirmed", F.lit(" (confirmed)"))))
         .when(truthy(F.col("deal_value_regex")), F.concat(F.lit("Value: $"), shown(F.col("deal_value_regex"), 0, commas=True), F.lit(" (regex)"))),
        F.when(truthy(F.col("offer_price_per_share")) & truthy(F.col("tgt_price")),
               F.concat(F.lit("Offer: $"), F.col("offer_price_per_share").cast("string"),
                        F.lit(" | Price: $"), F.col("tgt_price").cast("string"))),
        F.when(prem.isNotNull(), F.concat(F.lit("Premium: +"), shown(prem, 1), F.lit("%"))),
        F.when(F.col("upside_pct").isNotNull(), F.concat(F.lit("Upside to offer: "), shown(F.col("upside_pct"), 1, plus=True), F.lit("%"))),
        F.when(F.col("short_squeeze_risk").isin("high", "medium"),
               F.concat(F.lit("Short squeeze: "), F.upper("short_squeeze_risk"), F.lit(" ("),
                        shown(F.coalesce(F.col("tgt_short_percent"), F.lit(0.0)) * 100, 1), F.lit("% of float)"))),
        F.concat(F.lit("Signal: "), alert_signal(F.col("filer_role"), F.col("is_full_acquisition"),
                                                F.col("deal_structure"), F.col("target_ticker"), F.col("tgt_price"))),
        F.format_string("Score %s/10 | Confidence %s/10 | %s",
                        F.coalesce(F.col("impact_score").cast("string"), F.lit("0")),
                        F.coalesce(F.col("confidence").cast("string"), F.lit("0")),
                        F.coalesce(F.nullif(F.col("deal_structure"), F.lit("")), F.lit("N/A"))))
    verdict = F.col("_verdict")
    fld = lambda name, value, inline: F.struct(F.lit(name).alias("name"), value.alias("value"),
                                               F.lit(inline).alias("inline"))
    target_block = F.concat_ws(
        "\n",
        F.concat(F.lit("Valuation: "), F.col("tgt_cap_formatted")),
        F.when(truthy(F.col("tgt_price")), F.concat(F.lit("Price: $"), F.col("tgt_price").cast("string"))),
        F.when(F.col("tgt_volume_spike") > 1.5,
               F.concat(F.lit("Volume: "), shown(F.col("tgt_volume_spike"), 1), F.lit("x avg"),
                        F.when(F.col("_vol_label").isNotNull(),
                               F.concat(F.lit(" ("), F.col("_vol_label"), F.lit(")"))).otherwise(F.lit("")))),
        F.when(F.col("tgt_week_change_pct").isNotNull(),
               F.concat(F.lit("Week: "), shown(F.col("tgt_week_change_pct"), 2, plus=True), F.lit("%"),
                        _tail(week_move_label(F.col("tgt_week_change_pct")).isNotNull(), F.lit(" (already moved)")))),
        F.when(F.col("_short_label").isNotNull(),
               F.concat(F.lit("Short: "), shown(F.col("tgt_short_percent") * 100, 1), F.lit("% of float ("),
                        F.col("_short_label"), F.lit(")"))),
        F.when(F.col("_inst_label").isNotNull(),
               F.concat(F.lit("Institutions: "), shown(F.col("tgt_institutional_pct") * 100, 0), F.lit("% ("),
                        F.col("_inst_label"), F.lit(")"))))
    has_tgt = F.col("tgt_ticker").isNotNull() & F.col("tgt_error").isNull()
    fields = F.array_compact(F.array(
        F.when(has_tgt, fld("Target data", target_block, True))
         .when(truthy_str(F.col("target_company")),
               fld("Target data", F.concat(F.lit("Company: "), F.col("target_company"),
                                           F.lit("\nPrivate company, not listed"),
                                           F.when(dv_ok, F.concat(F.lit("\nValue: "), dv)).otherwise(F.lit(""))), True)),
        F.when(F.col("acq_ticker").isNotNull() & F.col("acq_error").isNull() & truthy(F.col("acq_price")),
               fld("Acquirer data", F.concat_ws(
                   "\n", F.concat(F.lit("Valuation: "), F.col("acq_cap_formatted")),
                   F.concat(F.lit("Price: $"), F.col("acq_price").cast("string")),
                   F.when(F.col("acq_week_change_pct").isNotNull(), F.concat(
                       F.lit("Week: "), shown(F.col("acq_week_change_pct"), 2, plus=True), F.lit("% ("),
                       acquirer_week_label(F.col("acq_week_change_pct")), F.lit(")"))),
                   F.when(F.col("cap_ratio").isNotNull(),
                          F.concat(F.lit("Acquirer/target: "), shown(F.col("cap_ratio"), 1), F.lit("x valuation")))), True)),
        F.when(verdict != "", fld("Analyst view", cap_text(verdict), False)),
        F.when(F.size(F.coalesce(F.col("key_points"), F.array())) > 0,
               fld("Key points", cap_text(_bullets(F.col("key_points"), caps.get("key_points"))), False)),
        F.when(F.size(F.coalesce(F.col("risks"), F.array())) > 0, fld("Risks", _bullets(F.col("risks"), caps.get("risks")), True)),
        F.when(F.size(F.coalesce(F.col("sympathy_plays"), F.array())) > 0,
               fld("Related companies", _bullets(F.col("sympathy_plays"), caps.get("sympathy")), True)),
        F.when(F.coalesce(F.col("leak_detected"), F.lit(False)),
               fld("Leak detected", _capped(F.coalesce(F.col("reasoning"), F.lit("")), caps.get("reasoning")), False)),
        fld("Form", F.concat(F.lit("8-K · Item 1.01\n"), F.coalesce(F.col("link"), F.lit("#"))), True),
        F.when(F.col("published_ts").isNotNull(), fld("Published (8-K)", local_time_v2(F.col("published_ts")), True))))
    color = F.create_map(*[x for kv in PRIORITY_COLOR.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return df.select(
        "k", "priority",
        F.concat(F.col("priority"), F.lit(" M&A - "), F.coalesce(title_tick, target_name, F.lit("Unknown"))).alias("title"),
        desc.alias("description"), F.coalesce(color[F.col("priority")], F.lit(0)).alias("color"),
        chart_url(title_tick).alias("url"), fields.alias("fields"))


def alert_payload(df: DataFrame, caps: dict[str, int] | None = None) -> DataFrame:
    """The embed as one JSON document per alert, for the sink."""
    e = alert_embed(df, caps)
    embed = F.struct("title", "description", "color", "fields", "url")
    return e.select("k", "priority", F.to_json(F.struct(F.array(embed).alias("embeds"))).alias("payload"))


# Fixed values (reference): what the v1 payload shows of lists and texts at most; its chart address.
V1_CAPS = {"key_points": 3, "risks": 3, "sympathy": 4, "text": 500}
V1_CHART = "https://www.tradingview.com/chart/?symbol="


def alert_embed_v1(df: DataFrame, caps: dict[str, int] | None = None) -> DataFrame:
    """R6 + R7 (v1 layout) as columns: one market block, calculation and
    rationale, lists, trading warnings, the footer with the local time, the
    filing's ``url`` and a chart link as ``author``.  Null or empty parts and
    numbers that are null or 0 are skipped; ``caps`` as in ``alert_embed``."""
    caps = caps or {}
    line = lambda name, value, shown_if: F.when(shown_if, F.concat(F.lit(name + ": "), value))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("N/A"))
    listed = F.col("tgt_ticker").isNotNull() & F.col("tgt_error").isNull()
    price, week = F.col("tgt_price"), F.col("tgt_week_change_pct")
    desc = F.concat_ws(
        "\n",
        F.concat(F.coalesce("target_company", "company", F.lit("Unknown")), F.lit(" → "), F.coalesce("acquirer", F.lit("Unknown"))),
        line("Deal value", F.col("deal_value"), truthy_str(F.col("deal_value"))),
        line("Premium", F.concat(F.col("premium_pct").cast("string"), F.lit("%"),
                                 _tail(listed & truthy(price), F.lit(" (from $"), price.cast("string"), F.lit(")"))),
             truthy(F.col("premium_pct"))),
        line("Offer price", F.concat(F.lit("$"), F.col("offer_price_per_share").cast("string"), F.lit("/share")),
             truthy(F.col("offer_price_per_share"))),
        line("Upside to offer", F.concat(F.col("upside_pct").cast("string"), F.lit("%")), F.col("upside_pct").isNotNull()),
        F.concat(F.lit("Impact: "), F.coalesce(F.col("impact_score").cast("string"), F.lit("0")), F.lit("/10")),
        F.concat(F.lit("Verdict: "), text("verdict")), F.concat(F.lit("Short term: "), text("short_term_move")),
        F.concat(F.lit("Confidence: "), F.coalesce(F.col("confidence").cast("string"), F.lit("0")), F.lit("/10")),
        line("Structure", F.col("deal_structure"), truthy_str(F.col("deal_structure"))))
    market = F.concat_ws(
        "\n",
        line("Market cap", F.col("tgt_cap_formatted"), truthy_str(F.col("tgt_cap_formatted"))),
        line("Price", F.concat(F.lit("$"), price.cast("string")), truthy(price)),
        line("Volume spike", F.concat(shown(F.col("tgt_volume_spike"), 1), F.lit("x normal")), F.col("tgt_volume_spike") > 2),
        line("Week", F.concat(shown(week, 2, plus=True), F.lit("%")), truthy(week)),
        line("Institutions", F.concat(shown(F.col("tgt_institutional_pct") * 100, 1), F.lit("%")),
             truthy(F.col("tgt_institutional_pct"))))
    warnings = F.concat_ws(
        "\n",
        line("Leak detected", F.coalesce(F.col("leak_reasoning"), F.lit("Unusual price action")),
             F.coalesce(F.col("leak_detected"), F.lit(False))),
        line("Liquidity", F.col("liquidity_warning"), truthy_str(F.col("liquidity_warning"))))
    fld = lambda name, value, shown_if: F.when(shown_if, F.struct(
        F.lit(name).alias("name"), value.alias("value"), F.lit(False).alias("inline")))
    some = lambda c: F.size(F.coalesce(F.col(c), F.array().cast("array<string>"))) > 0
    fields = F.array_compact(F.array(
        fld("Market data", market, listed & (market != "")),
        *(fld(name, _capped(F.col(c), caps.get("text")), truthy_str(F.col(c)))
          for name, c in (("Premium calculation", "premium_calculation"), ("Strategic rationale", "strategic_rationale"))),
        fld("Key points", _bullets(F.col("key_points"), caps.get("key_points")), some("key_points")),
        fld("Risks", _bullets(F.col("risks"), caps.get("risks")), some("risks")),
        fld("Trading warnings", warnings, warnings != ""),
        fld("Sympathy plays", _bullets(F.col("sympathy_plays"), caps.get("sympathy")), some("sympathy_plays"))))
    color = F.create_map(*[x for kv in PRIORITY_COLOR.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    ticker = F.nullif(F.col("tgt_ticker"), F.lit(""))
    return df.select(
        "k", "priority", F.concat(F.col("priority"), F.lit(" M&A - Item 1.01")).alias("title"), desc.alias("description"),
        color[F.col("priority")].alias("color"), fields.alias("fields"),
        F.coalesce(local_time_v1(F.col("published_ts")), F.lit("")).alias("footer"),
        F.nullif(F.col("link"), F.lit("")).alias("url"),
        F.concat(F.lit("View "), ticker, F.lit(" Chart")).alias("author"), F.concat(F.lit(V1_CHART), ticker).alias("author_url"))


def alert_payload_v1(df: DataFrame, caps: dict[str, int] | None = None) -> DataFrame:
    """The v1 embed as one JSON document per alert."""
    author = F.when(F.col("author").isNotNull(), F.struct(F.col("author").alias("name"), F.col("author_url").alias("url")))
    embed = F.struct("title", "description", "color", "fields", F.struct(F.col("footer").alias("text")).alias("footer"), "url",
                     author.alias("author"))
    return alert_embed_v1(df, caps).select("k", "priority", F.to_json(F.struct(F.array(embed).alias("embeds"))).alias("payload"))
