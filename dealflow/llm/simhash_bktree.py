"""SimHash near-duplicates by Burkhard-Keller trees.

Each text gets a 64-bit fingerprint of its word shingles; two fingerprints link when at most ``radius`` bits
differ; a component is everything reachable over links.  Copies collapse to one distinct fingerprint before
any comparing.

Links between distinct fingerprints are found in BK-trees.  The 64 bits are cut into ``radius + 2`` blocks:
fingerprints within the radius agree on at least two of them, so each fingerprint is entered in one shard per
pair of blocks, keyed by the bits of that pair, and no link is lost.  A shard of up to ``tree_size``
fingerprints is one tree; a larger one is sliced, and every slice's tree (of at most ``tree_size`` nodes, so
bounded whatever the data) is sent to each slice that queries it.  A child hangs off its parent by their
integer Hamming distance d, and a search at distance q from the parent follows only the edges with
|d - q| <= radius.  Within a task links are folded into a forest at once, so a group of m near copies gives
at most m rows, not its pairs.

Defined cases: a null text is an empty one; a text of fewer words than the shingle length is one shingle; no
words give fingerprint zero, which links like any other.  Repeated rows each get a row.  A null id never
names a component unless the component has no other id.  Empty tables give empty results; further columns
are ignored by :func:`label` and kept by :func:`one_per_component`.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealflow.llm.common import components, hex64, stage

SEED = 42
SLAB = 1 << 16


def fingerprint(raw: bytes, shingle: int = 3) -> int:
    """The SimHash of a text's word shingles (XXH64, a bit for each set in over half of them)."""
    words = raw.lower().split()
    if not words:
        return 0
    norm = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    k = min(shingle, len(words))
    n = len(words) - k + 1
    begin, end = (ends - sizes)[:n], ends[k - 1:]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, SLAB):
        h = np.array([digest(norm[a:z], SEED) for a, z in zip(begin[i:i + SLAB].tolist(), end[i:i + SLAB].tolist())],
                     np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, fp)`` with the 64-bit fingerprint as a signed long.  No shuffle."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(x or b"", shingle) for x in b.column(1).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


class BKTree:
    """Distinct 64-bit values; each child is keyed by its Hamming distance to its parent."""

    def __init__(self, values: list[int]):
        self.values = values
        self.children: list[dict[int, int]] = [{} for _ in values]
        for i in range(1, len(values)):
            at = 0
            while True:
                d = (values[i] ^ values[at]).bit_count()
                if (nxt := self.children[at].get(d)) is None:
                    self.children[at][d] = i
                    break
                at = nxt

    def within(self, value: int, radius: int) -> list[int]:
        """Indices of the values at most ``radius`` away."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            q = (value ^ self.values[at]).bit_count()
            if q <= radius:
                found.append(at)
            todo += [c for d, c in self.children[at].items() if -radius <= d - q <= radius]
        return found


def _block_pairs(radius: int) -> list[int]:
    """A bit mask for each pair of the radius + 2 blocks."""
    n = radius + 2
    cuts = [64 * i // n for i in range(n + 1)]
    masks = [((1 << z) - 1) ^ ((1 << a) - 1) for a, z in zip(cuts, cuts[1:])]
    return [x | y for x, y in itertools.combinations(masks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _group_links(values: list[int], in_tree: list[bool], radius: int, out: list[tuple[int, int]]) -> None:
    """Star edges that connect one meeting's fingerprints as its links do: a tree searched for each query (its own
    values, where no others came)."""
    own = [v for v, x in zip(values, in_tree) if x]
    tree = BKTree(own)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for q in own if len(own) == len(values) else [v for v, x in zip(values, in_tree) if not x]:
        for i in tree.within(q, radius):
            a, b = root(q), root(own[i])
            if a != b:
                parent[max(a, b)] = min(a, b)
    out += [(x, r) for x in list(parent) if (r := root(x)) != x]


def _links(radius: int):
    """Edges from rows sorted by meeting: runs of equal keys, one at a time, the last one of a batch carried over."""
    schema = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for b in itertools.chain(batches, [None]):
            out: list[tuple[int, int]] = []
            if b is None:
                rows = kept
            else:
                rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns])
                rows = rows if kept is None else np.concatenate([kept, rows], axis=1)
            if rows is None or not rows.shape[1]:
                continue
            begin = np.r_[0, np.nonzero((rows[:4, 1:] != rows[:4, :-1]).any(axis=0))[0] + 1]
            end = np.r_[begin[1:], rows.shape[1]]
            if b is not None:
                kept = rows[:, begin[-1]:]
                begin, end = begin[:-1], end[:-1]
            values = rows[5].view(np.uint64).tolist()
            in_tree = (rows[2] == rows[4]).tolist()
            for x, y in zip(begin.tolist(), end.tolist()):
                if y - x > 1:
                    _group_links(values[x:y], in_tree[x:y], radius, out)
            ends = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["u", "v"])

    return run, schema


def linked(distinct: DataFrame, radius: int = 3, tree_size: int = 1024) -> DataFrame:
    """Edges ``(u, v)`` that connect the fingerprints ``distinct(fp)`` exactly as links within the radius do."""
    shards = F.array(*(F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits"))
                       for i, m in enumerate(_block_pairs(radius))))
    rows = distinct.select("fp", F.explode(shards).alias("s")).select("fp", "s.t", "s.bits")
    sizes = rows.groupBy("t", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = rows.join(sizes, ["t", "bits"]).withColumn("slices", F.ceil(F.col("n") / F.lit(tree_size)).cast("int"))
    shared = shared.withColumn("slice", F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int"))
    # a tree meets its own slice once, and each later slice: (tree, with) names one such meeting
    low, high = F.least("slice", "other"), F.greatest("slice", "other")
    met = (shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
           .select("t", "bits", "fp", "slice", low.alias("tree"), high.alias("with")))
    run, schema = _links(radius)
    meeting = ["t", "bits", "tree", "with"]
    return met.repartition(*meeting).sortWithinPartitions(*meeting).select(*meeting, "slice", "fp").mapInArrow(run, schema)


def label(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3,
          tree_size: int = 1024) -> DataFrame:
    """``(id, fp, component_id)``: the smallest id reachable over links, for every row of ``docs``."""
    marked = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min(id_col).alias("least"))
    tree = components(linked(distinct.select("fp"), radius, tree_size))
    joined = distinct.join(tree.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    names = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = joined.select("fp", "root").join(names, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select(id_col, "fp", "component_id")


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                      radius: int = 3) -> DataFrame:
    """``docs`` with one row for each component: the one with its smallest id (one of them, if that id repeats).

    Rows without an id can't be told apart by it, so they stay.  The join and the choice among repeats share
    one shuffle on the id.
    """
    keep = label(docs, id_col, text_col, shingle, radius).where(F.col(id_col) == F.col("component_id"))
    keep = keep.select(id_col).distinct()
    place = "_row"
    while place.lower() in map(str.lower, docs.columns):      # a name that the input lacks
        place += "_"
    first = (docs.where(F.col(id_col).isNotNull()).join(keep, id_col, "left_semi")
             .withColumn(place, F.row_number().over(Window.partitionBy(id_col).orderBy(F.xxhash64(text_col))))
             .where(F.col(place) == 1))
    return first.select(*docs.columns).unionByName(docs.where(F.col(id_col).isNull()))


def digest_columns(labelled: DataFrame) -> DataFrame:
    return labelled.select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")
