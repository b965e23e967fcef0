"""Feed merge, processed ledger, de-duplication, early stop, history upsert:
J1, J2, U1, U2, W2, W3, F6, F9, J15, ST4.

Keys such as an accession or an alert id can be hot (one value holding a
third of all rows).  De-duplication therefore uses ``groupBy`` with
``min_by``/``max_by`` (partial aggregation before the shuffle sends one row
per key per map task) instead of a window over the hot key's partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealflow.operators.lookup import lookup


def drop_without(df: DataFrame, col: str = "accession") -> DataFrame:
    """rows without the key are not processed."""
    return df.where(F.col(col).isNotNull())


def not_processed(df: DataFrame, ledger: DataFrame, key: str = "accession") -> DataFrame:
    """Rows whose key is not in the ledger (anti join; the ledger side is
    broadcast by AQE when small at run time, else shuffled)."""
    return df.join(ledger.select(key).distinct(), key, "left_anti")


def first_per_key(df: DataFrame, key: str = "accession", order: str = "feed_rank") -> DataFrame:
    """Keep the first row per key in feed order.

    ``min_by`` over a struct of all columns aggregates partially map-side,
    so a hot key never gathers all its rows in one task."""
    others = [c for c in df.columns if c != key]
    agg = df.groupBy(key).agg(F.min_by(F.struct(*others), F.col(order)).alias("_r"))
    return agg.select(key, *[F.col(f"_r.{c}").alias(c) for c in others])


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Upsert by key, the latest row wins (``max_by`` of a struct)."""
    others = [c for c in df.columns if c != key]
    agg = df.groupBy(key).agg(F.max_by(F.struct(*others), F.col(order)).alias("_r"))
    return agg.select(key, *[F.col(f"_r.{c}").alias(c) for c in others])


def merged_flags(feed: DataFrame, ledger: DataFrame | None = None, key: str = "accession", order: str = "feed_rank",
                 feed_col: str = "feed", primary: str = "primary", salts: int = 16) -> DataFrame:
    """J2 + U1 + U2 and J1 in one pass over a frame that holds both feeds' rows.

    Kept are all primary rows, and backup rows with a key that the primary
    feed does not have.  ``is_processed``: the key is in the ledger, or an
    earlier kept row of this run had it (null for rows without a key).

    One accession may hold a third of the rows: what the feeds and the ledger
    know of a key meets in one row (combined before the shuffle), and a key's
    rows join ``salts`` copies of it in as many partitions."""
    rank = feed.schema[order].dataType
    is_primary = F.col(feed_col) == F.lit(primary)
    state = feed.where(F.col(key).isNotNull()).select(
        key, F.when(is_primary, F.col(order)).alias("_p"), F.col(order).alias("_a"), F.lit(False).alias("_in"))
    if ledger is not None:
        state = state.unionByName(ledger.select(
            key, F.lit(None).cast(rank).alias("_p"), F.lit(None).cast(rank).alias("_a"), F.lit(True).alias("_in")))
    state = state.groupBy(F.col(key).alias("_key")).agg(
        F.min("_p").alias("_p"), F.min("_a").alias("_a"), F.max("_in").alias("_in"))
    f = lookup(feed, state, [(F.col(key), "_key")], order, salts)
    f = f.where(is_primary | (F.col(key).isNotNull() & F.col("_p").isNull()))
    seen = F.col("_in") | (F.col(order) > F.coalesce("_p", "_a"))
    return f.withColumn("is_processed", seen).drop("_p", "_a", "_in")


def early_stop(flagged: DataFrame, threshold: int = 15, order: str = "feed_rank", bucket_rows: int = 1 << 18,
               fan_in: int = 1 << 23, ranks: int = 1 << 63) -> DataFrame:
    """F9 + W3: run length of consecutive processed rows in feed order, and
    whether the scan still examines the row before it stops at the
    ``threshold``-th consecutive processed row.

    A global running count would pull the whole feed into one task.  Instead
    rows go to buckets of at most ``bucket_rows`` consecutive ranks (ranks are
    unique, so a bucket is bounded) and runs are counted inside each bucket.
    Buckets are summed up in one row each, those in groups of ``fan_in``, and
    so on over as many levels as ``ranks`` needs (two for all 64-bit ranks),
    until one window holds what is left; each level hands back the run that
    enters its members.  The result is the same whatever the ranks are:
    ``ranks`` only settles the number of levels.  All joins are equi-joins, and
    nothing runs before the result is asked for.  Rows without a key
    (``is_processed`` null) neither count nor reset the run and are left out
    of the result.
    """
    keyed = flagged.where(F.col("is_processed").isNotNull())
    b = keyed.withColumn("_bucket", _part(F.col(order).cast("bigint"), bucket_rows))
    w = Window.partitionBy("_bucket").orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    # one partitioning and order for every window: row number, and the row
    # number of the last new (unprocessed) row so far; the run is their gap
    b = b.withColumn("_rn", F.row_number().over(w))
    b = b.withColumn("_last_new", F.max(F.when(~F.col("is_processed"), F.col("_rn"))).over(upto))
    b = b.withColumn("_local_run", F.when(F.col("is_processed"), F.col("_rn") - F.coalesce(F.col("_last_new"), F.lit(0)))
                     .otherwise(F.lit(0)))
    # A bucket's first row at the threshold is either one after its first new row, which the bucket knows itself,
    # or one of its first rows, by the run that enters it: their ranks (at most ``threshold``) are kept.
    leading = F.col("_last_new").isNull() & (F.col("_rn") <= threshold)
    summary = b.groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_last_new").isNotNull().alias("_has_new"),
        F.max_by("_local_run", order).alias("_trail"),
        F.min(F.when((F.col("_local_run") >= threshold) & F.col("_last_new").isNotNull(), F.col(order))).alias("_own_stop"),
        F.sort_array(F.collect_list(F.when(leading, F.col(order)))).alias("_leading"))
    carried = _carried(summary, fan_in, -(-ranks // bucket_rows))
    need = F.greatest(F.lit(1), F.lit(threshold) - F.col("_carry")).cast("int")
    carried = carried.withColumn("_stop_b", F.least(F.col("_own_stop"), F.try_element_at("_leading", need)))
    stop = carried.agg(F.min("_stop_b")).scalar()
    b = lookup(b, carried.select(F.col("_bucket").alias("_key"), "_carry"), [(F.col("_bucket"), "_key")], order)
    b = b.withColumn("run_length", F.when(
        F.col("is_processed"),
        F.col("_local_run") + F.when(F.col("_last_new").isNull(), F.col("_carry")).otherwise(F.lit(0)))
        .otherwise(F.lit(0)))
    b = b.withColumn("examined", F.coalesce(F.col(order) <= stop, F.lit(True)))
    return b.drop("_bucket", "_rn", "_last_new", "_local_run", "_carry")


def _part(x: Column, size: int) -> Column:
    """The number of the part of ``size`` whole numbers that holds ``x`` (exact for all 64 bits, below zero too)."""
    return F.call_function("div", x - F.pmod(x, F.lit(size)), F.lit(size))


def _entering(d: DataFrame, group: str) -> DataFrame:
    """``_enters``: the run entering each row from earlier rows of its group; ``_open``: it reaches the group's begin."""
    earlier = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_s", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    last = F.last(F.when(F.col("_has_new"), F.col("_trail") - F.col("_s") - F.col("_n")), ignorenulls=True).over(earlier)
    d = d.withColumn("_last", last)
    return d.withColumn("_open", F.col("_last").isNull()).withColumn(
        "_enters", F.col("_s") + F.coalesce(F.col("_last"), F.lit(0)))


def _carried(summary: DataFrame, fan_in: int, buckets: int) -> DataFrame:
    """``summary`` with ``_carry``, the run that enters each bucket; ``buckets``: how far their numbers may go."""
    if buckets <= fan_in:
        return _entering(summary.withColumn("_all", F.lit(0)), "_all").withColumn("_carry", F.col("_enters"))
    d = _entering(summary.withColumn("_group", _part(F.col("_bucket"), fan_in)), "_group")
    # a group ends with its last bucket's run, longer if that bucket holds no new row
    end = F.col("_trail") + F.when(F.col("_has_new"), F.lit(0)).otherwise(F.col("_enters"))
    groups = d.groupBy(F.col("_group").alias("_next")).agg(
        F.sum("_n").alias("_n"), F.max("_has_new").alias("_has_new"), F.max_by(end, F.col("_bucket")).alias("_trail"))
    above = _carried(groups.withColumnRenamed("_next", "_bucket"), fan_in, -(-buckets // fan_in))
    above = above.select(F.col("_bucket").alias("_group"), F.col("_carry").alias("_above"))
    return d.join(above, "_group").withColumn(
        "_carry", F.col("_enters") + F.when(F.col("_open"), F.col("_above")).otherwise(F.lit(0)))
