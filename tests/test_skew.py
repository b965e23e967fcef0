"""A null or hot key that holds a third of the rows spreads over partitions, without adaptive execution."""

import pytest
from pyspark.sql import functions as F

from dealflow.operators import ledger
from dealflow.operators.lookup import lookup

N = 6000


@pytest.fixture
def plain(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold",
                                             "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def sizes(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


def keyed(spark, hot):
    return spark.range(N).select("id", F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("key"))


@pytest.mark.parametrize("hot,salts", [(None, 1), ("k5", 16)])
def test_lookup_spreads_rows(plain, hot, salts):
    dim = plain.range(997).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("_d"), F.col("id").alias("v"))
    out = lookup(keyed(plain, hot), dim, [(F.col("key"), "_d")], "id", salts)
    n = sizes(out)
    assert sum(n) == N and max(n) < 3 * N / 8
    got = out.where("key IS NOT NULL AND substring(key, 2) <> CAST(v AS STRING)").count()
    assert got == 0 and out.where("key IS NULL AND v IS NOT NULL").count() == 0
    assert out.where("key IS NOT NULL AND v IS NULL").count() == 0


@pytest.mark.parametrize("hot", [None, "k5"])
def test_merged_flags_spread_rows(plain, hot):
    feed = keyed(plain, hot).select(F.col("key").alias("accession"), F.col("id").alias("feed_rank"),
                                    F.when(F.col("id") < N // 2, "primary").otherwise("backup").alias("feed"))
    out = ledger.merged_flags(feed, plain.createDataFrame([("k1",), ("k1",)], "accession string"))
    n = sizes(out)
    assert max(n) < 3 * sum(n) / 8
    rows = {r.feed_rank: r for r in out.collect()}
    first = {}
    for i, r in enumerate(feed.orderBy("feed_rank").collect()):
        keep = r.feed == "primary" or (r.accession is not None and r.accession not in {
            x for x in first if first[x] < N // 2})
        assert (r.feed_rank in rows) == keep
        if r.accession is not None:
            if keep:
                assert rows[r.feed_rank].is_processed == (r.accession == "k1" or r.accession in first)
            first.setdefault(r.accession, r.feed_rank)
        elif keep:
            assert rows[r.feed_rank].is_processed is None
