"""Property tests (hypothesis) against brute-force Python references."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dealflow.functions import identifiers as ids
from dealflow.functions import text as T
from dealflow.operators import ledger


def brute_early_stop(flags, threshold):
    """Reference loop: rows with key None neither count nor reset."""
    run, stop, out = 0, None, []
    for i, f in enumerate(flags):
        if f is None:
            continue
        run = run + 1 if f else 0
        out.append((i, f, run))
        if stop is None and f and run >= threshold:
            stop = i
    return [(i, f, r, stop is None or i <= stop) for i, f, r in out]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.sampled_from([True, True, True, False, None]), min_size=1, max_size=60),
       st.integers(min_value=1, max_value=6), st.integers(min_value=2, max_value=5))
def test_early_stop_matches_loop(spark, flags, bucket, threshold):
    rows = [(i * 3 + 1, f) for i, f in enumerate(flags)]          # sparse, unique ranks
    df = spark.createDataFrame(rows, "feed_rank bigint, is_processed boolean")
    got = sorted((r.feed_rank, r.is_processed, r.run_length, r.examined) for r in
                 ledger.early_stop(df, threshold, bucket_rows=bucket).collect())
    want = [(i * 3 + 1, f, r, e) for i, f, r, e in brute_early_stop(flags, threshold)]
    assert got == want


def test_accession_round_trip(spark):
    rnd = random.Random(7)
    accs = [f"{rnd.randrange(10**10):010d}-{rnd.randrange(100):02d}-{rnd.randrange(10**6):06d}" for _ in range(300)]
    df = spark.createDataFrame([(a,) for a in accs], "a string")
    out = df.select("a", ids.dashed(ids.undashed(F.col("a"))).alias("b")).collect()
    assert all(r.a == r.b for r in out)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab .!?\n")), min_size=0, max_size=2500),
                min_size=1, max_size=20), st.integers(min_value=10, max_value=1200))
def test_truncate_length_bound(spark, texts, max_len):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", T.truncate_sentence(F.col("t"), max_len).alias("u")).collect()
    for r in out:
        assert len(r.u) <= max_len + 1
        assert r.u == r.t if len(r.t) <= max_len else r.u != r.t


def test_upsert_idempotent(spark):
    df = spark.createDataFrame([("A", 1, "x"), ("A", 3, "y"), ("B", 2, "z"), ("A", 2, "w")],
                               "id string, feed_rank int, v string")
    once = ledger.latest_per_key(df, "id", "feed_rank")
    twice = ledger.latest_per_key(once.unionByName(df), "id", "feed_rank")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == \
        [("A", 3, "y"), ("B", 2, "z")]


def test_first_per_key_hot_key(spark):
    rows = [("HOT", i, f"r{i}") for i in range(500, 0, -1)] + [("COLD", 7, "c")]
    df = spark.createDataFrame(rows, "accession string, feed_rank int, v string").repartition(8)
    got = sorted(map(tuple, ledger.first_per_key(df).collect()))
    assert got == [("COLD", 7, "c"), ("HOT", 1, "r1")]
