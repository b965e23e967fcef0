"""Report aggregates over tracked outcomes: A9-A13 (and S12's payload).

Each is a small hash aggregate over the tracked frame; the percentages use
``bround`` (half to even, like the reference's integer ``round``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealflow.functions.numeric import rnd

# Fixed values (reference): minimum sample, score buckets, reported contexts.
MIN_SAMPLE = 2
SCORE_BUCKETS = (("9-10 MEGA/MAJOR", 9, 10), ("7-8 MAJOR", 7, 8), ("5-6 STANDARD", 5, 6))
REPORT_CONTEXTS = ("pre-market", "market-hours", "after-hours")


def tracked(outcomes: DataFrame) -> DataFrame:
    """only rows the tracker measured."""
    return outcomes.where(F.col("tracker_status") == F.lit("tracked"))


def _rate(flag: str, total):
    n = F.count_if(F.col(flag) == F.lit(True))
    return n, F.bround(n / total * F.lit(100.0), 0).cast("int")


def report_totals(outcomes: DataFrame, min_sample: int = MIN_SAMPLE) -> DataFrame:
    """A9 + A10: one row, or none when fewer than ``min_sample`` are tracked.

    Null metrics count in the total but not in n; means skip nulls; the
    touch-time mean skips zero and null, rounds half to even to an integer."""
    t = tracked(outcomes)
    total = F.count(F.lit(1))
    cols = [total.alias("total")]
    for flag, name in (("direction_at_1h", "dir_1h"), ("direction_at_4h", "dir_4h"),
                       ("target_touched", "touched"), ("target_sustained", "sustained")):
        n, p = _rate(flag, total)
        cols += [n.alias(f"n_{name}"), p.alias(f"pct_{name}")]
    ftm = F.col("first_touch_minutes")
    cols += [rnd(F.avg("range_high_pct"), 2).alias("avg_range_high"),
             rnd(F.avg("range_low_pct"), 2).alias("avg_range_low"),
             rnd(F.avg("alpha_4h"), 2).alias("avg_alpha"),
             F.bround(F.avg(F.when(ftm != 0, ftm)), 0).cast("int").alias("avg_touch_minutes")]
    return t.agg(*cols).where(F.col("total") >= F.lit(min_sample))


def structure_key(c) -> F.Column:
    """A11 key: blank and missing structures group as ``unknown``."""
    return F.coalesce(F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")), F.lit("unknown"))


def report_by_structure(outcomes: DataFrame) -> DataFrame:
    """Sustained / total per deal structure, sorted by structure."""
    return (tracked(outcomes)
            .groupBy(structure_key("deal_structure").alias("deal_structure"))
            .agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(F.col("target_sustained") == F.lit(True)).alias("sustained"))
            .orderBy("deal_structure"))


def report_by_score(outcomes: DataFrame, buckets=SCORE_BUCKETS) -> DataFrame:
    """Closed integer ranges; a null score counts as 0; empty buckets are
    left out; a score between ranges (8.5) falls in none.

    The bucket table is a literal of three rows, so the range condition is a
    ``CASE`` and the aggregate is a plain hash aggregate."""
    score = F.coalesce(F.col("groq_score").cast("double"), F.lit(0.0))
    bucket = F.lit(None).cast("string")
    order = F.lit(None).cast("int")
    for i, (name, lo, hi) in reversed(list(enumerate(buckets))):
        hit = (score >= F.lit(float(lo))) & (score <= F.lit(float(hi)))
        bucket = F.when(hit, F.lit(name)).otherwise(bucket)
        order = F.when(hit, F.lit(i)).otherwise(order)
    return (tracked(outcomes).select(bucket.alias("score_bucket"), order.alias("bucket_order"),
                                     "target_sustained")
            .where(F.col("score_bucket").isNotNull())
            .groupBy("score_bucket", "bucket_order")
            .agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(F.col("target_sustained") == F.lit(True)).alias("sustained"))
            .orderBy("bucket_order").drop("bucket_order"))


def report_by_context(outcomes: DataFrame, contexts=REPORT_CONTEXTS) -> DataFrame:
    """The three reported filing contexts (weekend and unknown are not)."""
    return (tracked(outcomes).where(F.col("filing_context").isin(*contexts))
            .groupBy("filing_context")
            .agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(F.col("target_sustained") == F.lit(True)).alias("sustained"))
            .orderBy("filing_context"))


def report_summary(outcomes: DataFrame, min_sample: int = MIN_SAMPLE) -> DataFrame:
    """The combined report as one row: the totals, and per structure,
    score and context the sustained share as ``name sustained/total`` entries.

    The outcomes are aggregated once, to one row per (structure, score range,
    context); the three breakdowns and the totals are taken from those rows."""
    score = F.coalesce(F.col("groq_score").cast("double"), F.lit(0.0))
    bucket = F.lit(None).cast("string")
    for name, lo, hi in reversed(SCORE_BUCKETS):
        bucket = F.when((score >= F.lit(float(lo))) & (score <= F.lit(float(hi))), F.lit(name)).otherwise(bucket)
    context = F.when(F.col("filing_context").isin(*REPORT_CONTEXTS), F.col("filing_context"))
    cells = tracked(outcomes).groupBy(structure_key("deal_structure").alias("structure"), bucket.alias("score"),
                                      context.alias("context")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("target_sustained") == F.lit(True)).alias("sustained"))
    kinds = F.array(F.struct(F.lit("all").alias("kind"), F.lit("").alias("name")),
                    *(F.struct(F.lit(k).alias("kind"), F.col(k).alias("name")) for k in ("structure", "score", "context")))
    parts = (cells.select("total", "sustained", F.explode(kinds).alias("p")).where("p.name IS NOT NULL")
             .groupBy("p.kind", "p.name").agg(F.sum("total").alias("total"), F.sum("sustained").alias("sustained")))
    entry = F.concat_ws(" ", "name", F.concat(F.col("sustained").cast("string"), F.lit("/"), F.col("total").cast("string")))
    lines = lambda k: F.array_join(F.sort_array(F.collect_list(F.when(F.col("kind") == k, entry))), "; ")
    everything = F.col("kind") == "all"
    return parts.groupBy().agg(
        F.max(F.when(everything, F.col("total"))).alias("total"),
        F.max(F.when(everything, F.col("sustained"))).alias("sustained"), lines("structure").alias("by_structure"),
        lines("score").alias("by_score"), lines("context").alias("by_context")).where(F.col("total") >= F.lit(min_sample))
