"""Helpers shared by the operators: tables, scratch tables in the shared folder, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealflow.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one, removed when the driver's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: cuts the lineage, survives executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(u, v)`` as ``(node, root)``, root being the smallest node.

    Alternates large-star and small-star rounds (O(log n) of them in practice).  Every round is a grouped
    minimum, combined before its shuffle, and a join on the node.  Minima and edges go to the shared
    checkpoint folder: a join of a written table has an exchange of its own, so AQE may split a node of many
    edges, which it can't where the join shares the exchange of the grouping.  Nodes without an edge are not
    returned.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).checkpoint()
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        large = large.checkpoint()
        low = large.groupBy("u").agg(F.min("v").alias("m")).checkpoint()
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
        e = small.where("u <> v").distinct().checkpoint()
        now = e.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def hex64(col) -> F.Column:
    return F.lower(F.lpad(F.hex(col), 16, "0"))
