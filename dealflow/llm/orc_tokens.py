"""Token ids as ORC files.

Documents are dealt out by ranges of their id, so that files follow one another in ascending order, and each
task writes one file: integer columns are run-length encoded stripe by stripe, every ``row_index_stride`` rows
have an index entry, and document ids have a Bloom filter.  Readers take stripes in parallel; a look-up by id
skips files, stripes and row groups by their statistics and filters before any ids are read.

Each row carries its shard (its file's place in the order) and the ids before it within the shard.  The global
``start`` of a document adds the sizes of the earlier shards, a table of one row per shard.

Defined cases: a null text is an empty one, whose only id is the end id; rows of equal id keep an order by
their text's hash; rows without an id come first; an empty table writes no documents; further columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealflow.llm.token_cache import token_cache

GROUP_CHARS = 1 << 23                          # characters encoded at once


def tokenised(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, shard, before, n_tokens, ids)`` in ascending order of id within and across partitions."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("shard", T.LongType()),
        T.StructField("before", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType()))])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, shard, before = token_cache(path), TaskContext.get().partitionId(), 0
        for whole in batches:
            for a in range(0, whole.num_rows, 2048):
                b = whole.slice(a, 2048)
                ids = [x + end for x in cache.encode_all(b.column(1).to_pylist(), GROUP_CHARS)]
                n = np.array([len(x) // 4 for x in ids], np.int64)
                ends = np.cumsum(n)
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(np.full(len(n), shard, np.int64)), pa.array(before + ends - n), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), flat)], names=schema.names)
                before += int(ends[-1])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    order = [F.col("_id"), F.xxhash64("_text")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def write(docs: DataFrame, out: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
          stripe_bytes: int = 64 << 20, row_index_stride: int = 1000, bloom_fpp: float = 0.01) -> None:
    """Tokenise ``docs`` and write the ORC files under ``out``."""
    (tokenised(docs, path, end_id, id_col, text_col).write.format("orc")
     .option("orc.stripe.size", stripe_bytes).option("orc.row.index.stride", row_index_stride)
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", bloom_fpp)
     .option("compression", "zstd").save(out))


def read(spark: SparkSession, out: str) -> DataFrame:
    """``(doc_id, shard, before, n_tokens, ids)`` as written."""
    return spark.read.orc(out)


def lookup(spark: SparkSession, out: str, ids: list[int]) -> DataFrame:
    """The rows of some documents; stripes that can't hold them are skipped."""
    return read(spark, out).where(F.col("doc_id").isin(ids))


def shard_starts(stored: DataFrame) -> DataFrame:
    """``(shard, offset)``: the ids in earlier shards.  One row per written file; no ids are read for it."""
    sizes = stored.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))


def checksums(stored: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` from the files."""
    schema = T.StructType([stored.schema["doc_id"]] + [
        T.StructField(x, T.LongType()) for x in ("shard", "before", "n_tokens", "ids_crc32")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(2)
            ends = ids.offsets.to_numpy()
            flat = memoryview(ids.values.to_numpy().astype("<u4", copy=False)).cast("B")
            crc = [zlib.crc32(flat[4 * a:4 * z]) for a, z in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(3), pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
                names=schema.names)

    each = stored.select("doc_id", "shard", "ids", "before").mapInArrow(run, schema)
    return each.join(shard_starts(stored), "shard").select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
