"""Scoring: R1 (pluggable batch scorer) and R2 (deterministic rule rubric).

The reference sends each filing to a hosted language model.  Here the
scorer is a plain ``Iterator[pandas.DataFrame] -> Iterator[pandas.DataFrame]``
run by ``mapInPandas`` (Arrow batches, one Python worker per task), so a
deployment can plug in any batch model; nothing networked ships.  The
default scorer is the rule rubric below, which is pure Spark columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dealflow.functions.numeric import shown, truthy
from dealflow.functions.text import (MA_EXCLUSIONS, MA_KEYWORDS_STRONG, Scans, any_pattern, holds_any, json_block_v2,
                                     scanned)

Scorer = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]

# The keys of the scorer's JSON answer (v2), and those that only the first generation has.
ANALYSIS = ("impact_score double, deal_type string, is_full_acquisition boolean, target_company string, acquirer string, "
            "deal_value string, deal_value_usd double, deal_value_source string, offer_price_per_share double, "
            "current_price double, premium_pct double, premium_calculation string, upside_to_offer string, "
            "deal_structure string, short_squeeze_risk string, verdict string, short_term_move string, confidence double, "
            "strategic_rationale string, key_points array<string>, risks array<string>, sympathy_plays array<string>, "
            "leak_detected boolean, filer_role string, target_ticker string, acquirer_ticker string, "
            "alert_headline string, analyst_verdict string, reasoning string")
ANALYSIS_V1_ONLY = ("deal_value_numeric double, sector_context string, liquidity_warning string, leak_reasoning string, "
                    "approval_probability string")

SHORT_NOTE_LEVEL = 0.15


def scoring_requests(df: DataFrame) -> DataFrame:
    """What a scorer is told of a filing besides its section, as columns.

    Needs the snapshot columns of ``enrich.market_snapshot`` (null where there
    is none), ``company`` and ``deal_value_regex``.  ``market_line`` sums up the
    market, ``value_anchor`` the value found in the text, and ``short_note``
    is set where short interest is above 15 % of float."""
    known = F.col("ticker").isNotNull() & F.col("error").isNull()
    short = F.coalesce(F.col("short_percent"), F.lit(0.0))
    line = F.concat_ws(
        " | ", F.concat(F.lit("ticker "), F.col("ticker")),
        F.concat(F.lit("price "), F.coalesce(F.col("price").cast("string"), F.lit("unknown"))),
        F.concat(F.lit("capitalisation "), F.col("cap_formatted")),
        F.when(truthy(F.col("shares_outstanding")), F.concat(F.lit("shares "), shown(F.col("shares_outstanding"), 0, commas=True)))
        .otherwise(F.lit("shares unknown")),
        F.concat(F.lit("volume "), shown(F.coalesce(F.col("volume_spike"), F.lit(1.0)), 1), F.lit("x")),
        F.concat(F.lit("week "), shown(F.coalesce(F.col("week_change_pct"), F.lit(0.0)), 1, plus=True), F.lit("%")),
        F.concat(F.lit("short "), shown(short * 100, 1), F.lit("% of float")),
        F.concat(F.lit("institutions "), shown(F.coalesce(F.col("institutional_pct"), F.lit(0.0)) * 100, 0), F.lit("%")))
    value = F.col("deal_value_regex")
    return (df.withColumn("market_line", F.when(known, line).otherwise(F.lit("no market data")))
            .withColumn("value_anchor", F.when(truthy(value), F.concat(F.lit("value in text: $"), shown(value, 0, commas=True)))
                        .otherwise(F.lit("no value found in text")))
            .withColumn("short_note", F.when(F.col("ticker").isNotNull() & (short > SHORT_NOTE_LEVEL),
                                             F.concat(F.lit("high short interest: "), shown(short * 100, 1), F.lit("% of float")))))


def with_credit(df: DataFrame | Scans, section: str, out: str) -> DataFrame | Scans:
    """The credit rule's test of R2 as a scan: credit/loan/employment/offering wording, no strong M&A wording."""
    excluded, strong = holds_any(MA_EXCLUSIONS), holds_any(MA_KEYWORDS_STRONG)
    return scanned(df, out, lambda t: excluded(t) and not strong(t), section, "boolean")


def rule_score(section: Column | None, deal_type: Column, full: Column, structure: Column, premium: Column,
               short_percent: Column, squeeze_level: float = 0.15, credit: Column | None = None) -> Column:
    """R2: the rubric as exact integers (the lower end of each band).

    credit/loan/employment/offering agreement (and no strong M&A wording): 1;
    full acquisition with all-cash, premium > 40 or a squeeze setup: 9;
    full acquisition mixed/stock or premium 20-40: 7; partial acquisition or
    merger: 5; else 1.  Short interest above ``squeeze_level`` on an
    acquisition adds 1, capped at 10.  ``credit`` is the first test's outcome
    where ``with_credit`` has made it; the section is not needed then."""
    if credit is None:
        credit = any_pattern(section, MA_EXCLUSIONS) & ~any_pattern(section, MA_KEYWORDS_STRONG)
    columns = column_score(deal_type, full, structure, premium, short_percent, squeeze_level)
    return F.when((columns > 1) & F.coalesce(credit, F.lit(False)), F.lit(1)).otherwise(columns)


def column_score(deal_type: Column, full: Column, structure: Column, premium: Column, short_percent: Column,
                 squeeze_level: float = 0.15) -> Column:
    """R2 without the credit rule, which can only lower it to 1: where this is 1 the section need not be read."""
    acq = deal_type == F.lit("acquisition")
    squeeze = F.coalesce(short_percent > F.lit(squeeze_level), F.lit(False))
    full_ = F.coalesce(full, F.lit(False))
    prem = premium
    base = (F.when(full_ & ((structure == "all-cash") | F.coalesce(prem > 40, F.lit(False)) | (squeeze & acq)),
                  F.lit(9))
            .when(full_ & (structure.isin("mixed", "all-stock") | F.coalesce(prem.between(20, 40), F.lit(False))),
                  F.lit(7))
            .when((acq & ~full_) | (deal_type == F.lit("merger")), F.lit(5))
            .otherwise(F.lit(1)))
    bonus = F.when(acq & squeeze, F.lit(1)).otherwise(F.lit(0))
    return F.least(base + bonus, F.lit(10))


def apply_scorer(df: DataFrame, scorer: Scorer, schema: StructType | str,
                 partitions: int | None = None) -> DataFrame:
    """Run a batch scorer over gated rows.  Gate first: a filter written
    after ``mapInPandas`` is not pushed below it.  ``partitions`` sets the
    number of scorer tasks (a round-robin repartition, no key skew)."""
    d = df.repartition(partitions) if partitions else df
    return d.mapInPandas(scorer, schema)


def parse_model_output(text: Column, schema: StructType | str, required: str) -> Column:
    """T12 (v2) + R1: the JSON object inside free text as a struct; null when
    the text has no object or the required field is missing."""
    parsed = F.from_json(json_block_v2(text), schema)
    return F.when(parsed.getField(required).isNotNull(), parsed)
