"""Landed-file sources and sinks: S1-S12.

The reference polls HTTP endpoints; here every input is a landed file or
table read by Spark's built-in readers (XML, JSON, text, parquet), with
fixed schemas so nothing is inferred at scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DateType, DoubleType, LongType, MapType, StringType,
                               StructField, StructType, TimestampNTZType)

from dealflow.functions.timefns import parse_published
from dealflow.operators.ledger import latest_per_key

# ---- S1 / S2: Atom feed ------------------------------------------------------

ATOM_ENTRY = StructType([
    StructField("title", StringType()),
    StructField("updated", StringType()),
    StructField("published", StringType()),
    StructField("id", StringType()),
    StructField("link", StructType([StructField("_href", StringType())])),
    StructField("_corrupt_record", StringType()),
])


def _ranked(rows: DataFrame) -> DataFrame:
    """``feed_rank``: files in the order of their names, entries in the order of their file.

    A file may be read in blocks by several tasks.  Rows are counted per block,
    and the two windows run over one row per block, not per entry."""
    block = rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_least"))
    block = (block.withColumn("_no", F.dense_rank().over(Window.orderBy("_file")))
             .withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("_file").orderBy("_block").rowsBetween(
                 Window.unboundedPreceding, -1)), F.lit(0))))
    rank = F.col("_no") * F.lit(1 << 32) + F.col("_before") + F.col("_mid") - F.col("_least")
    return rows.join(block, ["_file", "_block"]).withColumn("feed_rank", rank).drop(
        "_file", "_block", "_mid", "_n", "_least", "_no", "_before")


def read_feed(spark: SparkSession, path: str, feed: str = "primary") -> DataFrame:
    """Atom ``entry`` rows (the default namespace is dropped, the link's
    ``href`` attribute becomes ``link._href``).  Files are cut at the entries'
    ends and each entry is parsed on its own, so a malformed one is kept with
    ``_corrupt_record`` set and its neighbours are read, as the second scanner's
    tolerant parser keeps going; the built-in file reader would give up the
    rest of the file.  Name landed files so that their order is that of landing:
    ``feed_rank`` follows names, then places."""
    cut = spark.read.option("lineSep", "</entry>").text(path).select(
        F.regexp_extract("value", r"(?s)<entry[\s>].*", 0).alias("_raw"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_mid"))
    cut = cut.where(F.col("_raw") != "")
    entry = F.from_xml(F.concat("_raw", F.lit("</entry>")), ATOM_ENTRY,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    df = cut.select(entry.alias("e"), "_file", "_block", "_mid").select("e.*", "_file", "_block", "_mid")
    return _ranked(df.select("title", F.col("link._href").alias("link"), F.coalesce("id", F.lit("")).alias("entry_id"),
                     F.coalesce("published", F.col("updated")).alias("published_raw"), "updated",
                     "_corrupt_record", F.lit(feed).alias("feed"), "_file", "_block", "_mid"))


def render_entry(broken: Column) -> Column:
    """A feed row as an Atom ``entry`` element, for landing; where ``broken``, its title is left open."""
    escape = lambda c: F.replace(F.replace(F.replace(
        F.coalesce(F.col(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    return F.concat(F.lit("<entry><title>"), escape("title"), F.when(broken, "").otherwise("</title>"),
                    F.lit('<link rel="alternate" href="'), escape("link"), F.lit('"/><id>'), escape("entry_id"),
                    F.lit("</id><published>"), escape("published_raw"), F.lit("</published><updated>"), escape("updated"),
                    F.lit("</updated></entry>"))


# ---- S3: documents -----------------------------------------------------------

def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed document file (``wholetext``); the accession is the
    file name without ``.txt``, so it equi-joins the filings."""
    d = spark.read.text(path, wholetext=True)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(?:\.txt)?$", 1)
    return d.select(name.alias("accession"), F.col("value").alias("raw"))


# ---- S4: issuer map; S5: submissions -------------------------------------------

ISSUER = StructType([StructField("cik_str", LongType()), StructField("ticker", StringType()),
                     StructField("title", StringType())])


def read_issuer_map(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """The ``{"0": {cik_str, ticker, title}, ...}`` file to rows with the
    entry's ordinal (file order).  A file is one JSON document, bounded by
    the number of listed issuers; ``lines``: each line is one, as a large map
    lands in parts."""
    doc = spark.read.text(path, wholetext=not lines)
    m = F.from_json(F.col("value"), MapType(StringType(), ISSUER))
    e = doc.select(F.explode(m).alias("ordinal", "v"))
    return e.select(F.col("ordinal").cast("long").alias("ordinal"), "v.cik_str", "v.ticker", "v.title")


SUBMISSIONS = StructType([
    StructField("cik", StringType()),
    StructField("tickers", ArrayType(StringType())),
    StructField("filings", StructType([StructField("recent", StructType([
        StructField("accessionNumber", ArrayType(StringType())),
        StructField("items", ArrayType(StringType()))]))])),
])


def read_submissions(spark: SparkSession, path: str, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """Per-issuer submissions files (``lines``: a document a line) to (filings,
    tickers) rows: parallel arrays are zipped and exploded; the first ticker is
    upper-cased."""
    s = spark.read.option("multiLine", str(not lines).lower()).schema(SUBMISSIONS).json(path)
    z = s.select("cik", F.posexplode(F.arrays_zip("filings.recent.accessionNumber",
                                                  "filings.recent.items")).alias("pos", "z"))
    filings = z.select("cik", F.col("z.accessionNumber").alias("accession"),
                       F.coalesce(F.col("z.items"), F.lit("")).alias("items"), "pos")
    tickers = s.select("cik", F.upper(F.try_element_at("tickers", F.lit(1))).alias("first_ticker"))
    return filings, tickers


# ---- S6: market snapshots; S7/S8: bars ------------------------------------------

MARKET = StructType([StructField(n, t) for n, t in [
    ("ticker", StringType()), ("current_price", DoubleType()), ("regular_market_price", DoubleType()),
    ("previous_close", DoubleType()), ("regular_market_previous_close", DoubleType()),
    ("market_cap", DoubleType()), ("shares_outstanding", DoubleType()), ("volume", DoubleType()),
    ("avg_volume", DoubleType()), ("float_shares", DoubleType()), ("short_ratio", DoubleType()),
    ("short_percent", DoubleType()), ("pe_ratio", DoubleType()), ("beta", DoubleType()),
    ("fifty_two_week_high", DoubleType()), ("fifty_two_week_low", DoubleType()),
    ("institutional_pct", DoubleType()), ("analyst_target", DoubleType()),
    ("recommendation", StringType()), ("forward_pe", DoubleType()), ("price_to_book", DoubleType()),
    ("enterprise_value", DoubleType()), ("insider_pct", DoubleType()), ("analyst_count", DoubleType()), ("week_change_pct", DoubleType()), ("error", StringType())]])


def read_market(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(MARKET).format(fmt).load(path)


BARS = StructType([StructField("ticker", StringType()), StructField("ts", TimestampNTZType()),
                   StructField("open", DoubleType()), StructField("high", DoubleType()),
                   StructField("low", DoubleType()), StructField("close", DoubleType()),
                   StructField("volume", LongType())])


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """Minute bars, UTC wall clock.  Written partitioned by
    ``session_date`` (``write_bars``), a date filter prunes partitions and
    the alert keys prune them dynamically."""
    return spark.read.schema(StructType([*BARS.fields, StructField("session_date", DateType())])).parquet(path)


DAILY = StructType([StructField("ticker", StringType()), StructField("d", DateType()), *BARS.fields[2:]])


def read_daily_bars(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed daily bars, one row per ticker and day."""
    return spark.read.schema(DAILY).format(fmt).load(path)


def bars_to_utc(bars: DataFrame, zone: str, ts: str = "ts") -> DataFrame:
    """Landed bars whose times are wall clock of ``zone`` as UTC wall clock."""
    return bars.withColumn(ts, F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col(ts)))


def write_bars(bars: DataFrame, path: str, mode: str = "append") -> None:
    """Partition by date, cluster by ticker and time.  A day's bars go to as
    many tasks as their share of the rows, not to one."""
    (bars.withColumn("session_date", F.to_date("ts"))
         .repartitionByRange("session_date", "ticker", "ts").sortWithinPartitions("session_date", "ticker", "ts")
         .write.mode(mode).partitionBy("session_date").parquet(path))


# ---- S9 / S10: ledger and alert/outcome logs -------------------------------------

def append_ledger(rows: DataFrame, path: str) -> None:
    """Processed accessions with their outcome, append-only."""
    rows.select("accession", "outcome", F.current_timestamp().alias("processed_at")) \
        .write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, path: str, retry_outcomes=("empty_document", "score_failed")) -> DataFrame:
    """Processed keys; outcomes listed in ``retry_outcomes`` are not treated
    as processed, so a transient failure is retried."""
    return spark.read.parquet(path).where(~F.col("outcome").isin(*retry_outcomes)).select("accession")


def append_log(rows: DataFrame, path: str) -> None:
    """The alert history and the outcome history are append-only logs."""
    rows.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str, key: str = "id", order: str = "feed_rank") -> DataFrame:
    """The latest row of each id of an appended log."""
    return latest_per_key(spark.read.parquet(path), key, order)


# ---- S11 / S12: alert and report sinks ---------------------------------------------

def write_alerts(payloads: DataFrame, path: str) -> None:
    """One JSON document per alert, routed to a folder per priority."""
    payloads.select("priority", F.col("payload").alias("value")) \
        .write.mode("append").partitionBy("priority").text(path)


def write_report(report: DataFrame, path: str) -> None:
    """The report rows as JSON lines."""
    report.select(F.to_json(F.struct(*report.columns)).alias("value")).write.mode("append").text(path)


def feed_with_times(feed: DataFrame) -> DataFrame:
    return feed.withColumn("published_ts", parse_published(F.col("published_raw")))


__all__ = ["read_feed", "render_entry", "read_documents", "read_issuer_map", "read_submissions", "read_market", "read_bars",
           "read_daily_bars", "bars_to_utc", "read_log",
           "write_bars", "append_ledger", "read_ledger", "append_log", "write_alerts", "write_report",
           "feed_with_times"]
