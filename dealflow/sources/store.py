"""Stored tables that jobs extend step by step: folders of Parquet, partitioned by what a step rewrites.

A step writes whole partitions (``partitionOverwriteMode=dynamic``), so a step that runs again, after a lost driver
say, puts the same rows in the same place instead of appending them twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``, in whatever store it lies."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def stored(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The table at ``path``, empty where none has been written yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def replace_partitions(rows: DataFrame, path: str, *by: str) -> None:
    """Write ``rows``; partitions that they hold replace those of the table, all others stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
