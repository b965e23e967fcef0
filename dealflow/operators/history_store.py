"""J15 + S10 as a stored upsert: the alert history as nested records, appended to a log and compacted by id.

The log is append-only and dealt into buckets by a hash of the id, so all of an id's records lie in one bucket.
Compaction keeps the latest record of each id, reads and rewrites only the buckets that have records in the log
since the last one, and leaves all other folders as they are.  A reader sees the current table and the log since;
both runs of a compaction that was cut off give the same table, because the log's rows stay until they are no
longer newer than the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from dealflow.operators.ledger import latest_per_key
from dealflow.sources.store import replace_partitions, stored

BUCKETS = 64
#: Fixed values (reference): the horizons of the intraday block and the target move, in per cent.
INTRADAY = ("t_15m", "t_30m", "t_1h", "t_2h", "t_4h")
TARGET_PCT = 1.0


def nested_record(rows: DataFrame, outcomes: bool = False) -> DataFrame:
    """A flat history row as the reference's nested record.

    ``intraday``, ``trade_result`` and ``accuracy`` are structs of nulls until the tracker has measured the alert
    (``outcomes``: take them from the columns that ``track_outcomes`` adds)."""
    null = lambda kind: F.lit(None).cast(kind)
    measured = lambda name, kind: (F.col(name) if outcomes else null(kind))
    touched, drop = measured("target_touched", "boolean"), measured("range_low_pct", "double")
    intraday = F.struct(*(measured(f"close_pct_{x[2:]}", "double").alias(x) for x in INTRADAY))
    trade = F.struct(touched.alias("target_hit"), F.lit(TARGET_PCT).alias("target_pct"),
                     measured("first_touch_at", "string").alias("hit_at"),
                     measured("first_touch_minutes", "int").alias("hit_at_minutes"),
                     measured("range_high_pct", "double").alias("max_move_pct"), drop.alias("max_drawdown_pct"))
    accuracy = F.struct(measured("direction_at_4h", "boolean").alias("direction_correct"), touched.alias("target_reached"))
    flat = [c for c in rows.columns if c not in {"target_touched", "first_touch_at", "first_touch_minutes"}] if outcomes else ["*"]
    return rows.select(*flat, intraday.alias("intraday"), trade.alias("trade_result"), accuracy.alias("accuracy"))


class HistoryStore:
    """``log/`` (appended, by part and bucket) and ``current/`` (a record an id, by bucket) under ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str = "id", order: str = "feed_rank",
                 buckets: int = BUCKETS):
        self.spark, self.key, self.order, self.buckets = spark, key, order, buckets
        self.log, self.current = f"{path}/log", f"{path}/current"
        self.schema = schema
        self.table = StructType([*schema.fields]).add("bucket", IntegerType())
        self.entry = StructType([*schema.fields]).add("part", LongType()).add("bucket", IntegerType())

    def append(self, rows: DataFrame, part: int) -> None:
        """Add records as part ``part`` of the log; the same part again replaces itself."""
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        rows = rows.select(*self.schema.names).withColumns({"part": F.lit(part).cast("long"), "bucket": bucket})
        replace_partitions(rows.repartition("bucket", F.xxhash64(self.key, self.order) % 8), self.log, "part", "bucket")

    def compact(self, since: int) -> None:
        """Bring parts from ``since`` on into the current table, rewriting the buckets that they touch."""
        new = stored(self.spark, self.log, self.entry).where(F.col("part") >= since).drop("part")
        touched = new.select("bucket").distinct()
        old = stored(self.spark, self.current, self.table).join(F.broadcast(touched), "bucket", "left_semi")  # <= buckets rows
        merged = latest_per_key(old.select(*self.table.names).unionByName(new.select(*self.table.names)), self.key, self.order)
        replace_partitions(merged.select(*self.table.names), self.current, "bucket")

    def read(self, since: int | None = None) -> DataFrame:
        """The latest record of each id: the current table, with the log's parts from ``since`` on."""
        rows = stored(self.spark, self.current, self.table).select(*self.schema.names)
        if since is not None:
            new = stored(self.spark, self.log, self.entry).where(F.col("part") >= since).select(*self.schema.names)
            rows = latest_per_key(rows.unionByName(new), self.key, self.order)
        return rows.select(*self.schema.names)
