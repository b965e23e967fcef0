"""Dimension lookups and market arithmetic: J3, J4, J6-J9, E1-E10.

Dimension tables (issuers, submissions, market snapshots) are joined with
plain equi-joins; Spark's planner and AQE broadcast them when their
run-time size is under the broadcast threshold and fall back to a shuffle
join otherwise.  Nothing here collects to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealflow.functions.identifiers import cik_strip
from dealflow.functions.numeric import fixed, rnd, truthy
from dealflow.functions.text import pystrip
from dealflow.operators.lookup import lookup


def _first_truthy(*cols: Column) -> Column:
    """Python ``a or b or c``: the first truthy value, else the last one."""
    out = cols[-1]
    for c in reversed(cols[:-1]):
        out = F.when(truthy(c), c).otherwise(out)
    return out


# ---- J3: CIK to ticker ----------------------------------------------------

def issuer_tickers(issuers: DataFrame) -> DataFrame:
    """First listed ticker per CIK in file order (``ordinal``)."""
    return (issuers.where(F.col("ticker").isNotNull() & (F.col("ticker") != ""))
            .groupBy(F.col("cik_str").cast("string").alias("_cik"))
            .agg(F.upper(F.min_by("ticker", "ordinal")).alias("issuer_ticker")))


def lookup_issuer(df: DataFrame, issuers: DataFrame, cik: str = "cik", by: str = "k", salts: int = 1) -> DataFrame:
    """Rows without a CIK are spread by the column ``by``."""
    return lookup(df, issuer_tickers(issuers), [(cik_strip(F.col(cik)), "_cik")], by, salts)


# ---- J4 / F3: submissions metadata ---------------------------------------

def item_metadata(df: DataFrame, sub_filings: DataFrame, sub_tickers: DataFrame,
                  cik: str = "cik", accession: str = "accession", by: str = "feed_rank") -> DataFrame:
    """Ticker of the issuer and the tri-state Item 1.01 flag of the filing.

    Of a listing's or issuer's several rows the first counts (by ``pos``, if
    there is such a column).  Rows without a key are spread by ``by``.

    ``has_item_101`` is null when the accession is not listed or its item
    list is empty, else whether the list contains ``1.01``."""
    first = lambda d, col: F.min_by(col, F.col("pos") if "pos" in d.columns else F.col(col))
    subs = (sub_filings.groupBy(cik_strip(F.col("cik")).alias("_s_cik"), F.col("accession").alias("_s_acc"))
            .agg(first(sub_filings, "items").alias("meta_items")).withColumn("_listed", F.lit(True)))
    tk = (sub_tickers.groupBy(cik_strip(F.col("cik")).alias("_t_cik"))
          .agg(F.upper(first(sub_tickers, "first_ticker")).alias("meta_ticker")))
    own = cik_strip(F.col(cik))
    j = lookup(df, subs, [(own, "_s_cik"), (F.col(accession), "_s_acc")], by)
    j = lookup(j, tk, [(own, "_t_cik")], by)
    has = F.when(F.col("_listed") & (F.coalesce(F.col("meta_items"), F.lit("")) != ""),
                 F.col("meta_items").contains("1.01"))
    return (j.withColumn("has_item_101", has)
            .withColumn("meta_ticker", F.when(F.col(cik).isNotNull(), F.col("meta_ticker")))
            .drop("_listed"))


# ---- J9: ticker resolution -------------------------------------------------

def resolve_ticker(hint: Column, meta: Column, doc: Column) -> Column:
    """Title hint, then metadata, then the document."""
    blank = lambda c: F.nullif(c, F.lit(""))
    return F.coalesce(blank(hint), blank(meta), blank(doc))


# ---- E1, E2, E4: market snapshot ------------------------------------------

def market_snapshot(market: DataFrame, v1: bool = False) -> DataFrame:
    """Price and cap fallback chains, volume spike and the cap label."""
    prev = _first_truthy(F.col("previous_close"), F.col("regular_market_previous_close"))
    if v1:
        price = _first_truthy(F.col("current_price"), F.col("regular_market_price"))
        cap = F.col("market_cap")
    else:
        price = _first_truthy(F.col("current_price"), F.col("regular_market_price"),
                              F.col("previous_close"), F.col("regular_market_previous_close"))
        cap = (F.when(truthy(F.col("market_cap")), F.col("market_cap"))
               .when(truthy(F.col("shares_outstanding")) & truthy(prev), F.col("shares_outstanding") * prev)
               .otherwise(F.col("market_cap")))
    out = (market.withColumn("price", price).withColumn("cap", cap))
    out = out.withColumn("volume_spike", F.when(truthy(F.col("avg_volume")),
                                                F.try_divide(F.col("volume"), F.col("avg_volume")))
                         .otherwise(F.lit(1.0)))
    return out.withColumn("cap_formatted", cap_label(F.col("cap"), strict=v1))


def cap_label(cap: Column, strict: bool = False) -> Column:
    """``$x.xxB`` at or above one billion (``strict``: above), else
    ``$x.xM``; null or zero is ``Unknown``."""
    big = (cap > F.lit(1e9)) if strict else (cap >= F.lit(1e9))
    return (F.when(~truthy(cap), F.lit("Unknown"))
            .when(big, F.concat(F.lit("$"), fixed(cap / F.lit(1e9), 2), F.lit("B")))
            .otherwise(F.concat(F.lit("$"), fixed(cap / F.lit(1e6), 1), F.lit("M"))))


def completeness(market: DataFrame) -> DataFrame:
    """Which key fields are missing (falsy) per ticker."""
    price = _first_truthy(F.col("current_price"), F.col("regular_market_price"))
    missing = F.array_compact(F.array(
        F.when(~truthy(price), F.lit("current_price")),
        F.when(~truthy(F.col("market_cap")), F.lit("market_cap")),
        F.when(~truthy(F.col("volume")), F.lit("volume"))))
    return market.withColumn("missing", missing).withColumn("complete", F.size("missing") == 0)


# ---- E3 / W1: trailing changes -------------------------------------------

def trailing_changes(daily: DataFrame, lookback_days: int = 30, week_rows: int = 5,
                     min_rows: int = 2) -> DataFrame:
    """Per (ticker, day): change of the close against the close ``week_rows``
    rows back (or the first row of the lookback when fewer) and against the
    first close of the lookback.  Fewer than ``min_rows`` rows give 0.

    The window is per ticker over one row per day, so a partition holds one
    row per trading day regardless of how many bars the ticker has."""
    from pyspark.sql import Window
    day_no = F.datediff(F.col("d"), F.lit("1970-01-01").cast("date"))
    d = daily.withColumn("_day", day_no)
    frame = Window.partitionBy("ticker").orderBy("_day").rangeBetween(-(lookback_days - 1), 0)
    order = Window.partitionBy("ticker").orderBy("_day")
    d = (d.withColumn("_n", F.count(F.lit(1)).over(frame))
          .withColumn("_first", F.first("close").over(frame))
          .withColumn("_lag", F.lag("close", week_rows - 1).over(order)))
    base_w = F.when(F.col("_n") >= week_rows, F.col("_lag")).otherwise(F.col("_first"))
    ok = F.col("_n") >= min_rows
    week = F.when(ok & truthy(base_w), rnd((F.col("close") - base_w) / base_w * 100, 2)).otherwise(F.lit(0.0))
    month = F.when(ok & truthy(F.col("_first")),
                   rnd((F.col("close") - F.col("_first")) / F.col("_first") * 100, 2)).otherwise(F.lit(0.0))
    return d.select("ticker", "d", "close", F.col("_n").alias("rows_in_lookback"),
                    week.alias("week_change_pct"), month.alias("month_change_pct"))


# ---- T11 / J8: tickers from a company name ------------------------------

# Suffixes removed (in this order, as substrings) before guessing.
NAME_SUFFIXES = (" INC", " CORP", " LTD", " CO", ",")


def name_candidates(company: Column) -> Column:
    """Candidate tickers in order: initials (two or more words, 2-5
    letters), then the first word (2-5 characters)."""
    s = company
    for suf in NAME_SUFFIXES:
        s = F.replace(s, F.lit(suf), F.lit(""))
    s = pystrip(s)
    words = F.filter(F.split(s, r"\s+"), lambda w: w != "")
    initials = F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")
    first = F.try_element_at(words, F.lit(1))
    c1 = F.when((F.size(words) >= 2) & F.length(initials).between(2, 5), F.upper(initials))
    c2 = F.when(F.length(first).between(2, 5), F.upper(first))
    return F.array_compact(F.array(c1, c2))


def resolve_by_name(names: DataFrame, quotes: DataFrame, key: str = "name_id",
                    company: str = "company") -> DataFrame:
    """The first candidate with a non-zero quote wins (ordered semi-join)."""
    valid = quotes.where(truthy(F.col("regular_market_price"))).select(
        F.col("ticker").alias("_cand")).distinct()
    c = names.select(key, F.posexplode(name_candidates(F.col(company))).alias("_pos", "_cand"))
    hit = c.join(valid, "_cand", "left_semi").groupBy(key).agg(F.min_by("_cand", "_pos").alias("resolved_ticker"))
    return names.withColumn("candidates", name_candidates(F.col(company))).join(hit, key, "left")


# ---- J6 / J7 / E6 / E8 / F10: role resolution ------------------------------

SNAP_COLS = ("ticker", "price", "cap", "cap_formatted", "volume_spike", "short_percent",
             "institutional_pct", "week_change_pct", "error")


def _snap(market: DataFrame, prefix: str) -> DataFrame:
    return market.select(*[F.col(c).alias(f"{prefix}{c}") for c in SNAP_COLS])


def first_snapshot(market: DataFrame, order: str = "custkey") -> DataFrame:
    """One snapshot per ticker: the first in ``order``."""
    s = market_snapshot(market).where(F.col("ticker").isNotNull())
    others = [c for c in s.columns if c != "ticker"]
    one = s.groupBy("ticker").agg(F.min_by(F.struct(*others), F.col(order)).alias("_s"))
    return one.select("ticker", *(F.col(f"_s.{c}").alias(c) for c in others))


def resolve_roles(analysis: DataFrame, market: DataFrame, by: str = "k") -> DataFrame:
    """Target and acquirer market rows by the filer's role.

    acquirer filer: the target row is looked up only for a different,
    non-empty target ticker and kept only with no error and a truthy cap;
    target filer: the acquirer row for a different, non-empty ticker with no
    error; unknown: the filer is the target.  Then E6 upside, F10 premium
    validity and E8 cap ratio."""
    snap = first_snapshot(market)
    a = lookup(analysis, _snap(snap, "f_").withColumn("_k", F.col("f_ticker")), [(F.col("filer_ticker"), "_k")], by)
    role = F.col("filer_role")
    ft = F.col("filer_ticker")
    tt, at = F.nullif(F.col("target_ticker"), F.lit("")), F.nullif(F.col("acquirer_ticker"), F.lit(""))
    # counterparty key: target for an acquirer filer, acquirer for a target filer
    cp_key = (F.when((role == "acquirer") & tt.isNotNull() & ~tt.eqNullSafe(ft), tt)
              .when((role == "target") & at.isNotNull() & ~at.eqNullSafe(ft), at))
    a = lookup(a, _snap(snap, "c_").withColumn("_k", F.col("c_ticker")), [(cp_key, "_k")], by)
    cp_ok_t = F.col("c_ticker").isNotNull() & F.col("c_error").isNull() & truthy(F.col("c_cap"))
    cp_ok_a = F.col("c_ticker").isNotNull() & F.col("c_error").isNull()
    filer_present = F.col("f_ticker").isNotNull()

    def pick(field):
        f, c = F.col(f"f_{field}"), F.col(f"c_{field}")
        tgt = (F.when(role == "acquirer", F.when(cp_ok_t, c))
               .otherwise(F.when(filer_present, f)))
        acq = (F.when(role == "acquirer", F.when(filer_present, f))
               .when(role == "target", F.when(cp_ok_a, c)))
        return tgt.alias(f"tgt_{field}"), acq.alias(f"acq_{field}")

    cols = []
    for field in SNAP_COLS:
        cols += list(pick(field))
    a = a.select(*analysis.columns, *cols)
    offer, tprice = F.col("offer_price_per_share"), F.col("tgt_price")
    a = a.withColumn("upside_pct", F.when(truthy(offer) & truthy(tprice) & (tprice > 0),
                                          rnd((offer - tprice) / tprice * 100, 1)))
    a = a.withColumn("premium_pct_checked", F.when(truthy(offer), F.col("premium_pct")))
    ok_acq = F.col("acq_ticker").isNotNull() & F.col("acq_error").isNull() & truthy(F.col("acq_price"))
    a = a.withColumn("cap_ratio", F.when(ok_acq & truthy(F.col("acq_cap")) & truthy(F.col("tgt_cap")),
                                         F.col("acq_cap") / F.col("tgt_cap")))
    return a


def deal_premiums(df: DataFrame) -> DataFrame:
    """v1 premium of the deal value over the market cap; v2 premium of
    the implied offer (value / shares) over the price, full deals only."""
    dv, cap, sh, px = (F.col("deal_value_usd"), F.col("cap"), F.col("shares_outstanding"), F.col("price"))
    offer = F.try_divide(dv, F.when(truthy(sh), sh))
    return (df.withColumn("implied_offer", rnd(offer, 4))
              .withColumn("premium_vs_cap", rnd(F.try_divide(dv - cap, F.when(truthy(cap), cap)) * 100, 2))
              .withColumn("premium_vs_price", F.when(F.col("is_full_acquisition"),
                                                     rnd(F.try_divide(offer - px, F.when(truthy(px), px)) * 100, 2))))
