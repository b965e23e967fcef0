"""As-of joins, exchange sessions, stored steps and streams into the ledger: brute force, repeats, borders and plans."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dealflow.functions.exchange import Exchange, easter, us_holidays
from dealflow.functions.numeric import shown
from dealflow.operators import history_store, ledger
from dealflow.operators.asof import asof_join
from dealflow.plans import q_landed
from dealflow.sources import readers as R
from dealflow.sources.store import replace_partitions, stored
from dealflow.streaming import ledger_stream as LS
from dealflow.streaming import streams as S
from tests.test_properties import brute_early_stop

T0 = dt.datetime(2024, 3, 1, 22, 50)


# ---- early stop over any ranks -------------------------------------------------------

@pytest.mark.parametrize("bucket,fan_in,ranks", [(4, 4, 1 << 6), (1 << 18, 1 << 23, 1 << 63)])
def test_runs_cross_every_level_border(spark, bucket, fan_in, ranks):
    r = random.Random(bucket)
    flags = [r.random() < 0.9 for _ in range(60)]
    flags[20:50] = [True] * 30
    small = sorted(r.sample(range(200), 60))
    spread = sorted([b + d for b in (0, 1 << 14, 1 << 16, 1 << 32, 1 << 38, 10**12, 1 << 48, 1 << 62) for d in range(-4, 4)][:60])
    for places in (small, spread):
        df = spark.createDataFrame(list(zip(places, flags)), "feed_rank bigint, is_processed boolean").repartition(5)
        got = sorted((x.feed_rank, x.is_processed, x.run_length, x.examined) for x in
                     ledger.early_stop(df, 9, bucket_rows=bucket, fan_in=fan_in, ranks=ranks).collect())
        assert got == [(places[i], f, n, e) for i, f, n, e in brute_early_stop(flags, 9)]


# ---- numbers in texts -------------------------------------------------------------------

def test_shown_like_python(spark):
    r = random.Random(4)
    values = [22.25, 22.35, 0.125, -0.125, 2.5, 3.5, -0.04, 0.0, 1e6 + 0.5, 1234567.875] + [r.uniform(-1e5, 1e5) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select("x", *(shown(F.col("x"), d, p, c).alias(f"{d}{p}{c}") for d in (0, 1, 2) for p in (False, True)
                           for c in (False, True))).collect()
    for row in got:
        for d in (0, 1, 2):
            for p in (False, True):
                for c in (False, True):
                    assert row[f"{d}{p}{c}"] == f"{row.x:{'+' if p else ''}{',' if c else ''}.{d}f}", (row.x, d, p, c)


# ---- as-of join -------------------------------------------------------------------------

def brute_asof(asked, bars, back, tolerance):
    out = []
    for i, k, t in asked:
        some = [b for b in bars if k is not None and t is not None and b[0] == k and b[1] is not None
                and (b[1] <= t if back else b[1] >= t)]
        if some:
            best = (max if back else min)(b[1] for b in some)
            price = max(b[2] for b in some if b[1] == best)
            if tolerance is None or abs(best - t) <= dt.timedelta(minutes=tolerance):
                out.append((i, best, price))
                continue
        out.append((i, None, None))
    return sorted(out)


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("bucket,tolerance", [(1, None), (60, 45), (1440, None), (10**6, 7)])
def test_asof_against_brute_force(spark, direction, bucket, tolerance):
    r = random.Random(bucket)
    when = lambda: T0 + dt.timedelta(minutes=r.choice([0, 1, 5, 69, 70, 71, 1500, 4000]) + r.randrange(4), seconds=r.choice([0, 30]))
    bars = [(r.choice("ABC"), when(), float(r.randrange(9))) for _ in range(60)] + [("A", None, 1.0), (None, T0, 2.0)]
    asked = [(i, r.choice(["A", "B", "C", "D", None]), when()) for i in range(80)] + [(80, "A", None), (81, "A", T0), (82, "A", T0)]
    left = spark.createDataFrame(asked, "i long, k string, at timestamp_ntz").withColumn("price", F.lit(-1.0))
    right = spark.createDataFrame(bars, "k string, ts timestamp_ntz, price double")
    got = asof_join(left, right, "k", "at", "ts", ["price"], direction, bucket, tolerance, by="i").collect()
    assert len(got) == len(asked) and all(x.price == -1.0 for x in got)
    assert sorted((x.i, x.asof_ts, x.asof_price) for x in got) == brute_asof(asked, bars, direction == "backward", tolerance)


def test_asof_of_nothing_and_no_pairs(spark):
    left = spark.createDataFrame([(1, "A", T0)], "i long, k string, at timestamp_ntz")
    right = spark.createDataFrame([], "k string, ts timestamp_ntz, price double")
    out = asof_join(left, right, "k", "at", "ts", ["price"])
    assert [tuple(x) for x in out.collect()] == [(1, "A", T0, None, None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError):
        asof_join(left, right, "k", "at", "ts", ["price"], "sideways")


def test_asof_hot_time_is_spread(spark):
    """A third of all questions at one key and time: their rows go to several partitions, the list holds one time."""
    left = spark.range(3000).select("id", F.lit("A").alias("k"), F.when(F.col("id") % 3 == 0, F.lit(T0)).otherwise(
        F.lit(T0) + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") % 500).cast("int"), F.lit(0))).alias("at"))
    right = spark.createDataFrame([("A", T0, 1.0)], "k string, ts timestamp_ntz, price double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = asof_join(left, right, "k", "at", "ts", ["price"], by="id")
        sizes = out.withColumn("p", F.spark_partition_id()).where(F.col("at") == F.lit(T0)).groupBy("p").count().collect()
        assert out.where("asof_price = 1").count() == 3000
        assert len(sizes) > 2 and max(x["count"] for x in sizes) < 800
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---- exchange calendar ---------------------------------------------------------------------

def test_holidays_by_rule():
    assert [easter(y) for y in (1997, 2000, 2024, 2038)] == [dt.date(1997, 3, 30), dt.date(2000, 4, 23), dt.date(2024, 3, 31),
                                                             dt.date(2038, 4, 25)]
    days = us_holidays(2021, 2022)
    assert dt.date(2021, 12, 24) in days and dt.date(2021, 12, 31) not in days      # Saturdays: Friday, or swallowed
    assert dt.date(2022, 6, 20) in days and dt.date(2021, 6, 18) not in days        # Juneteenth, since 2022, on a Sunday
    assert dt.date(2022, 12, 26) in days and len(days) == 9 + 9


def test_sessions_follow_daylight_saving_and_holidays(spark):
    at = lambda *a: dt.datetime(*a)
    cases = [(at(2024, 3, 8, 14, 29), "pre-market", "2024-03-08", "14:30"),       # winter: opens 14:30 UTC
             (at(2024, 3, 11, 13, 29), "pre-market", "2024-03-11", "13:30"),      # summer time from 10 March
             (at(2024, 3, 11, 13, 30), "market-hours", "2024-03-11", "13:30"),
             (at(2024, 3, 11, 20, 0), "after-hours", "2024-03-12", "13:30"),
             (at(2024, 11, 1, 20, 0), "after-hours", "2024-11-04", "14:30"),      # over the weekend clocks go back
             (at(2024, 3, 28, 20, 1), "after-hours", "2024-04-01", "13:30"),      # Good Friday and the weekend
             (at(2024, 3, 29, 15, 0), "holiday", "2024-04-01", "13:30"),
             (at(2024, 7, 4, 3, 0), "after-hours", "2024-07-05", "13:30"),        # still 3 July in New York
             (at(2024, 12, 28, 12, 0), "weekend", "2024-12-30", "14:30"), (None, "unknown", None, None)]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t timestamp_ntz")
    x = Exchange()
    df = df.withColumn("d", x.session_date(F.col("t"))).select(
        "i", x.context(F.col("t")).alias("c"), F.col("d").cast("string").alias("d"),
        F.date_format(x.utc(F.col("d"), x.open_minute), "HH:mm").alias("o"))
    assert [(r.c, r.d, r.o) for r in sorted(df.collect())] == [c[1:] for c in cases]


# ---- stored tables and streams ---------------------------------------------------------------

def test_replaced_partitions_leave_others(spark, tmp_path):
    path = str(tmp_path / "t")
    assert stored(spark, path, "v int, p int").count() == 0
    for p, values in ((1, [1, 2]), (2, [3]), (1, [9])):
        replace_partitions(spark.createDataFrame([(v, p) for v in values], "v int, p int"), path, "p")
    assert sorted(map(tuple, stored(spark, path, "v int, p int").collect())) == [(3, 2), (9, 1)]


def test_history_compaction_rewrites_touched_buckets_only(spark, tmp_path):
    import os
    schema = spark.createDataFrame([], "id string, feed_rank int, v string").schema
    store = history_store.HistoryStore(spark, str(tmp_path), schema, buckets=8)
    rows = lambda data: spark.createDataFrame(data, schema)
    store.append(rows([(f"a{i}", 1, "old") for i in range(40)]), 0)
    store.compact(0)

    def files():
        return {d: sorted(f for f in os.listdir(f"{store.current}/{d}") if f.endswith("parquet"))
                for d in os.listdir(store.current) if d.startswith("bucket")}

    before = files()
    store.append(rows([("a3", 2, "new"), ("a3", 0, "stale"), ("zz", 5, "first")]), 1)
    assert {r.id: r.v for r in store.read(since=1).collect()}["a3"] == "new"        # before compaction, too
    store.compact(1)
    store.compact(1)
    after = files()
    assert sum(before.get(d) != after[d] for d in after) <= 2
    got = {r.id: (r.feed_rank, r.v) for r in store.read().collect()}
    assert got == {**{f"a{i}": (1, "old") for i in range(40)}, "a3": (2, "new"), "zz": (5, "first")}


def test_nested_record(spark):
    flat = spark.createDataFrame([("X-2024-01-02", 7)], "id string, feed_rank int")
    r = history_store.nested_record(flat).first()
    assert r.id == "X-2024-01-02" and r.trade_result.target_pct == 1.0 and r.trade_result.hit_at is None
    assert set(r.intraday.asDict()) == set(history_store.INTRADAY) and r.accuracy.target_reached is None


def test_ledger_takes_each_accession_once_whatever_is_repeated(spark, tmp_path):
    book, landed, checkpoint = (str(tmp_path / x) for x in ("book", "landed", "checkpoint"))
    schema = "accession string, feed_rank long"
    parts = [[("A", 1), ("B", 2), ("A", 3), (None, 4)], [("B", 5), ("C", 6), ("C", 7)], [("A", 8), ("D", 9)]]
    LS.seed_ledger(spark.createDataFrame([("D", None)], schema), book)
    for i, part in enumerate(parts):
        some = spark.createDataFrame(part, schema)
        some.write.mode("append").parquet(landed)
        LS.run_ledger_stream(S.file_stream(spark, landed, some.schema), book, checkpoint)
        for _ in range(2):
            LS.ledger_sink(book)(some, i)
    LS.ledger_sink(book)(spark.createDataFrame(parts[0], schema), 0)                # an old batch again
    got = LS.read_stream_ledger(spark, book, some.schema).collect()
    assert sorted((r.accession, r.feed_rank, r.batch_id) for r in got) == [("A", 1, 0), ("B", 2, 0), ("C", 6, 1), ("D", None, -1)]


def test_a_malformed_entry_spares_its_neighbours(spark, tmp_path):
    entry = "<entry><title>8-K {0} &amp; co</title><link href='l{0}'/><id>{0}</id><updated>u</updated></entry>"
    bad = "<entry><title>open<link href='x'/><id>9</id></entry>"
    (tmp_path / "a.xml").write_text("<?xml version='1.0'?><feed>" + entry.format(1) + bad + entry.format(2) + "</feed>")
    (tmp_path / "b.xml").write_text(entry.format(3) + "\n" + entry.format(4) + "<entry><title>cut off")
    got = sorted(R.read_feed(spark, str(tmp_path)).collect(), key=lambda r: r.feed_rank)
    assert [r.entry_id if r._corrupt_record is None else "bad" for r in got] == ["1", "bad", "2", "3", "4", "bad"]
    assert got[0].title == "8-K 1 & co" and got[0].link == "l1" and got[0].published_raw == "u"


def test_alert_dates_prune_the_bar_store(spark, sf_small):
    bars, daily = q_landed.land_bars(spark, sf_small)
    days = len(set(r.session_date for r in R.read_bars(spark, bars).select("session_date").distinct().collect()))
    out = q_landed.stored_outcomes(spark, sf_small, bars, daily)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    read = R.read_bars(spark, bars).where(F.col("session_date").between("2024-01-09", "2024-01-12"))
    assert out.count() > 0 and days > 20
    assert len(read.inputFiles()) <= len(R.read_bars(spark, bars).inputFiles())
