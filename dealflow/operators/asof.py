"""J11, J12 at any time: as-of joins, backward and forward, without a range join.

Time is cut into buckets of a fixed length.  Both sides' times meet in one list per key and bucket, sorted once; a
running last (or first) value gives each asked time its neighbour inside the bucket.  Where a bucket has none, the
nearest earlier (later) bucket of the key that has one hands over its last (first) row: that carry runs over one row
per key and bucket.  The sorted lists hold distinct times only, so their size is bounded by the time resolution
within a bucket however many rows share a key and a time; answers return to the rows by an equi-join on key and
time, with hot times dealt over copies.  Nothing is compared pair by pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealflow.operators.lookup import lookup


def asof_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, values: list[str],
              direction: str = "backward", bucket_minutes: int = 1440, tolerance_minutes: int | None = None,
              prefix: str = "asof_", ties: Column | None = None, by: str | None = None, salts: int = 8) -> DataFrame:
    """``left`` with the columns ``prefix + right_ts`` and ``prefix + v`` of the last right row of its key at or
    before ``left_ts`` (``backward``), or the first at or after it (``forward``); null where there is none, or none
    within ``tolerance_minutes``.

    Times are TIMESTAMP_NTZ.  Right rows of equal key and time: the largest ``ties`` wins (default: the values
    themselves, in their order).  Left rows of null key or time stay, without an answer.  ``by`` names a left
    column that spreads rows of a hot key and time (default: ``left_ts``, which does not).
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"unknown direction {direction}")
    back = direction == "backward"
    bucket = lambda ts: F.call_function(  # noqa: E731  whole buckets since 1970, below zero too
        "div", _minutes(ts) - F.pmod(_minutes(ts), F.lit(bucket_minutes)), F.lit(bucket_minutes))
    row = F.struct(F.col(right_ts).alias("t"), *(F.col(v) for v in values))
    offered = (right.where(F.col(key).isNotNull() & F.col(right_ts).isNotNull())
               .groupBy(F.col(key).alias("_k"), F.col(right_ts).alias("_t"))
               .agg(F.max_by(row, F.struct(*values) if ties is None else ties).alias("_r"))
               .select("_k", "_t", "_r", F.lit(False).alias("_asked")))
    asked = (left.where(F.col(key).isNotNull() & F.col(left_ts).isNotNull())
             .select(F.col(key).alias("_k"), F.col(left_ts).alias("_t")).distinct()
             .select("_k", "_t", F.lit(None).cast(offered.schema["_r"].dataType).alias("_r"), F.lit(True).alias("_asked")))
    both = offered.unionByName(asked).withColumn("_b", bucket(F.col("_t")))

    # at equal times the offered row comes first, seen from the direction the list is read in
    at = F.col("_t").asc() if back else F.col("_t").desc()
    inside = Window.partitionBy("_k", "_b").orderBy(at, F.col("_asked").asc()).rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("_near", F.last("_r", ignorenulls=True).over(inside))
    edges = both.groupBy("_k", "_b").agg((F.max_by if back else F.min_by)("_r", F.when(~F.col("_asked"), F.col("_t"))).alias("_e"))
    order = F.col("_b").asc() if back else F.col("_b").desc()
    before = Window.partitionBy("_k").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(F.col("_k").alias("_ck"), F.col("_b").alias("_cb"),
                           F.last("_e", ignorenulls=True).over(before).alias("_carry"))
    found = both.where("_asked").join(
        carried, (F.col("_k") == F.col("_ck")) & (F.col("_b") == F.col("_cb")), "left").select(
        F.col("_k").alias("_ask_k"), F.col("_t").alias("_ask_t"), F.coalesce("_near", "_carry").alias("_found"))
    if tolerance_minutes is not None:
        span = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(tolerance_minutes), F.lit(0))
        near = (F.col("_found.t") + span >= F.col("_ask_t")) if back else (F.col("_found.t") - span <= F.col("_ask_t"))
        found = found.withColumn("_found", F.when(near, F.col("_found")))
    out = lookup(left, found, [(F.col(key), "_ask_k"), (F.col(left_ts), "_ask_t")], by or left_ts, salts)
    names = {prefix + right_ts: F.col("_found.t"), **{prefix + v: F.col(f"_found.{v}") for v in values}}
    return out.withColumns(names).drop("_found")


def _minutes(ts: Column) -> Column:
    """Whole minutes since 1970 of a wall-clock time, by its own fields (no session zone)."""
    return F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint") * 1440 + F.hour(ts) * 60 + F.minute(ts)
