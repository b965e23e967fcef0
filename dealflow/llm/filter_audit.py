"""How filters interact: what each filter removes at each place of every order of the filters.

Each document gets a bit mask of the filters that it fails.  Documents are counted by part and mask into *cells*
(at most 2^f a part), which is all that the orders need.  A recursive common table expression enumerates the orders:
it starts with every mask and the empty prefix, and each level extends the prefixes by one unused letter, carrying
the bits applied so far; the mask cells met at a level tell whether their documents are kept, removed or redundant
at that step.  The enumeration depends on the number of filters only (five: 2^5 * 325 rows; at most ``MAX_FILTERS``
are taken), so it is broadcast to the cells, whose sums by part and prefix are the metrics.

The fifth filter, copies, fails a document whose text (by a 128-bit digest) a smaller id has anywhere in the table.
Rows are counted by digest, part, mask and label before the smallest id of a digest meets them, so a text that a
third of all documents share is a row a task, and then at most four rows a part.  Labels are looked up with null
ids spread and the rows of a hot id dealt over copies of its label.

Defined cases: a null text is an empty one, a null part an empty string; a row of null id has no label, is no
other's earlier copy and never fails as a copy; equal rows (id and text) are counted each and are no copies of one
another; an id with several labels counts as good, or toxic, if any says so; an empty table has no parts and no
rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealflow.operators.lookup import lookup

MAX_FILTERS = 6
NAMES = "ABCDE"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TAILS = bytes(range(0x80, 0xC0))          # bytes that begin no code point


@dataclass(frozen=True)
class Limits:
    words: int = 200                       # A: fewer words than this
    distinct_percent: int = 50             # B: a smaller share of distinct words
    capital_percent: int = 3               # C: a larger share of A-Z in the code points
    symbols: str = "#$%&*|"                # D: any of these


def mask_of(raw: bytes, limits: Limits = Limits()) -> int:
    """The bits of A to D that a text fails, A being bit 0; words are parted by space and U+0009 to U+000D."""
    words = raw.split()
    size = len(raw.translate(None, _TAILS))
    capitals = len(raw) - len(raw.translate(None, _UPPER))
    return ((len(words) < limits.words)
            | (100 * len(set(words)) < limits.distinct_percent * len(words)) << 1
            | (100 * capitals > limits.capital_percent * size) << 2
            | (re.search(b"[" + re.escape(limits.symbols.encode()) + b"]", raw) is not None) << 3)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
             limits: Limits = Limits()) -> DataFrame:
    """``(id, part, mask, digest)`` of each row; no text leaves its task."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("part", T.StringType()),
                           T.StructField("mask", T.IntegerType()), T.StructField("digest", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 512):
                b = whole.slice(a, 512)
                masks, digests = [], []
                for raw in b.column(2).cast(pa.binary()):
                    raw = raw.as_py() or b""
                    masks.append(mask_of(raw, limits))
                    digests.append(hashlib.blake2b(raw, digest_size=16).digest())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())], names=schema.names)

    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), part.alias("part"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
          limits: Limits = Limits(), salts: int = 8) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by the filters they fail; ``labels(doc_id, quality, toxic)``."""
    rows = measured(docs, id_col, text_col, part_col, limits).groupBy("id", "part", "mask", "digest").agg(
        F.count(F.lit(1)).alias("n"))
    flags = labels.groupBy(F.col("doc_id").alias("_key")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")).where("good OR toxic")
    rows = lookup(rows, flags, [(F.col("id"), "_key")], "digest", salts).fillna(False, ["good", "toxic"])
    kinds = rows.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first"))
    least = F.min("first.id").over(Window.partitionBy("digest"))
    own = F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0) + F.col("nameless")
    split = kinds.withColumn("least", least).withColumn("own", own).select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("own").alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(16)).alias("mask"), (F.col("n") - F.col("own")).alias("n")))).alias("c"))
    return split.where("c.n > 0").groupBy("part", F.col("c.mask").alias("mask")).agg(
        F.sum("c.n").alias("n"), F.sum(F.when(F.col("good"), F.col("c.n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("c.n")).otherwise(0)).alias("toxic"))


def enumerated(spark: SparkSession, names: str = NAMES) -> DataFrame:
    """``(prefix, step, letter, mask, kept, removed, redundant, alone)``: each mask at each step of each prefix."""
    if not 0 < len(set(names)) == len(names) <= MAX_FILTERS:
        raise ValueError(f"from one to {MAX_FILTERS} filters, each named by one letter")
    letters = ", ".join(f"named_struct('letter', '{x}', 'bit', {1 << i})" for i, x in enumerate(names))
    return spark.sql(f"""
WITH RECURSIVE steps(prefix, step, letter, mask, bit, before) AS (
  SELECT '', 0, '', cast(id AS int), 0, 0 FROM range({1 << len(names)})
  UNION ALL
  SELECT concat(prefix, x.letter), step + 1, x.letter, mask, x.bit, before | bit
  FROM (SELECT prefix, step, mask, bit, before,
               explode(filter(array({letters}), l -> (before | bit) & l.bit = 0)) AS x
        FROM steps WHERE step < {len(names)})
)
SELECT prefix, step, letter, mask, mask & (before | bit) = 0 AS kept, mask & bit <> 0 AND mask & before = 0 AS removed,
       mask & bit <> 0 AND mask & before <> 0 AS redundant, mask = bit AS alone
FROM steps WHERE step > 0""")


def audit(cell: DataFrame, names: str = NAMES) -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``, a row
    for each part, order and step, from ``cells``; ``shapley`` is what the step's filter removes over all orders."""
    steps = enumerated(cell.sparkSession, names)

    def total(of: str, where: str):
        return F.sum(F.when(F.col(where), F.col(of)).otherwise(0))

    by_prefix = cell.join(F.broadcast(steps), "mask").groupBy("part", "prefix", "step", "letter").agg(
        total("n", "kept").alias("kept"), total("n", "removed").alias("removed"),
        total("n", "redundant").alias("redundant"), total("n", "alone").alias("unique_fails"),
        total("good", "removed").alias("good_lost"), total("toxic", "removed").alias("toxic_lost"))
    # a prefix of k letters begins (f - k)! orders
    orders = F.element_at(F.array(*(F.lit(factorial(len(names) - k)) for k in range(1, len(names) + 1))), F.col("step"))
    shapley = F.sum(F.col("removed") * orders).over(Window.partitionBy("part", "letter"))
    by_prefix = by_prefix.withColumn("shapley", shapley)
    whole = steps.where((F.col("step") == len(names)) & (F.col("mask") == 0)).select(
        F.col("prefix").alias("filter_order"),
        F.explode(F.expr(f"transform(sequence(1, {len(names)}), k -> substr(prefix, 1, k))")).alias("prefix"))
    return by_prefix.join(F.broadcast(whole), "prefix").select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def oracle_sql(limits: Limits = Limits(), names: str = NAMES) -> str:
    """DuckDB SQL for :func:`audit` over ``documents`` and ``labels``."""
    letters = ", ".join(f"('{x}', {1 << i})" for i, x in enumerate(names))
    return rf"""
WITH RECURSIVE letters(letter, bit) AS (VALUES {letters}),
  text AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
  words AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM text),
  failed AS (SELECT doc_id, part,
               (len(w) < {limits.words})::INT + 2 * (100 * len(list_distinct(w)) < {limits.distinct_percent} * len(w))::INT
               + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {limits.capital_percent} * length(text))::INT
               + 8 * regexp_matches(text, '[{re.escape(limits.symbols)}]')::INT
               + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS mask
             FROM words),
  flags AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
  cell AS (SELECT f.part, f.mask, count(*) AS n, sum(coalesce(l.good, 0)) AS good, sum(coalesce(l.toxic, 0)) AS toxic
           FROM failed f LEFT JOIN flags l ON l.doc_id = f.doc_id GROUP BY f.part, f.mask),
  steps(prefix, step, letter, part, mask, n, good, toxic, bit, before) AS (
    SELECT '', 0, '', part, mask, n, good, toxic, 0, 0 FROM cell
    UNION ALL
    SELECT s.prefix || l.letter, s.step + 1, l.letter, s.part, s.mask, s.n, s.good, s.toxic, l.bit, s.before | s.bit
    FROM steps s JOIN letters l ON (s.before | s.bit) & l.bit = 0),
  by_prefix AS (SELECT part, prefix, any_value(step) AS step, any_value(letter) AS letter,
      sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
      sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
      sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
      sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
      sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
      sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM steps WHERE step > 0 GROUP BY part, prefix),
  orders AS (SELECT DISTINCT prefix AS filter_order FROM steps WHERE step = {len(names)}),
  every AS (SELECT b.*, o.filter_order FROM orders o JOIN by_prefix b ON b.prefix = substr(o.filter_order, 1, b.step))
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM every
"""
