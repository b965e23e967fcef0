"""Removal of long repeated byte strings by a logarithmic family of suffix arrays.

Every byte covered by a ``length``-byte string that also starts anywhere else (in any text, the same one
included) is removed; strings are judged on the input.

Sampled suffixes.  The window of ``window`` positions that starts at p elects the position with the smallest
rolling hash of 8 bytes as its anchor.  The vote depends only on bytes inside the string at p, so two equal
strings elect the same anchor, and positions that share an anchor form one run (a *segment*).  The strings of
a segment all hold the ``length - window + 1`` bytes that follow its anchor: its *suffix head*.  A segment
whose suffix head occurs once holds no repeated string.  So the suffix arrays keep anchors only, about two
per ``window`` bytes, each by its first eight bytes and a fingerprint of the head (ties in the eight bytes are
broken by it: equal heads are neighbours).

Index family.  Texts come in batches.  A batch's suffix array is scanned against itself and against each
level for equal heads (a merge join of two sorted tables), which gives the matched heads; then it becomes a
level of its own, and levels of equal size merge two by two, like a binary counter, so an entry is rewritten
O(log batches) times.  Equal heads collapse to one entry, so a passage that a third of all texts share is one
entry of the array.

Exact check.  Only segments of matched heads go on.  Segments whose whole context (from the first string's
first byte to the last string's last) occurs twice are repeated throughout.  One owner of each other context
is then cut into blocks of 16 positions and judged again in the same way, by the bytes common to all strings
of the block and by the block's whole context; what is still open is judged string by string, by two
independent 64-bit hashes.  Work follows the number of edges between repeated and other text, not pairs.

No step gathers the members of a group: groups are counted (combined before the shuffle) and joined back,
and AQE may split the joined side.

Defined cases: a null or empty text has no bytes and keeps none; repeated rows are separate places, so both
copies of a text of ``length`` bytes or more lose all; a text shorter than ``length`` never loses any; a null
id is an id like others; further columns are ignored by :func:`repeats` and kept by :func:`remove`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealflow.llm.common import stage

GRAM = 8
BLOCK = 16
CELL = 32               # single starts to a row
SLAB = 1 << 19          # positions handled at once: bounds a task's memory whatever a text's length
_U = np.uint64


@dataclass(frozen=True)
class Spec:
    length: int = 400
    window: int = 256

    def __post_init__(self):
        if not 2 * GRAM <= self.window + GRAM <= self.length:
            raise ValueError("window + 8 may not exceed length")


# Rolling hashes: sum of table[byte] * base**i, modulo 2**64, shifted back by the inverse base so that equal
# strings hash alike wherever they lie.  Two tables and bases give independent hashes.
@lru_cache(maxsize=4)
def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    base = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)[which]
    grow, shrink = np.full(size, base, _U), np.full(size, pow(base, -1, 1 << 64), _U)
    grow[0] = shrink[0] = 1
    table = np.random.default_rng(20_240 + which).integers(0, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)
    return table, np.cumprod(grow, dtype=_U), np.cumprod(shrink, dtype=_U)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


class Rolling:
    """Hashes of any substring of a buffer, unsigned."""

    def __init__(self, data: np.ndarray, which: int = 0):
        table, grow, self.shrink = _powers(which, max(1 << (len(data) + 1).bit_length(), 2 * SLAB))
        self.sums = np.zeros(len(data) + 1, _U)
        np.cumsum(table[data] * grow[:len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.shrink[start] + (end - start).astype(_U))


def segments(data: np.ndarray, ok: np.ndarray, spec: Spec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last position of each segment of the positions marked ``ok`` (whole strings start there)."""
    gram = np.lib.stride_tricks.sliding_window_view(data, GRAM).copy().view("<u8").ravel()
    gram *= _U(0x9E3779B97F4A7C15)
    gram ^= gram >> _U(32)
    gram *= _U(0xD6E8FEB86659FD93)
    low = (gram & _U(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=_U)          # leftmost of the smallest
    span = 1
    while span * 2 <= spec.window:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < spec.window:
        low = np.minimum(low[:len(low) - (spec.window - span)], low[spec.window - span:])
    p = np.nonzero(ok[:len(low)])[0]
    anchor = (low[p] & _U(0xFFFFFFFF)).astype(np.int64)
    cut = np.nonzero((anchor[1:] != anchor[:-1]) | (p[1:] != p[:-1] + 1))[0]
    return anchor[np.r_[0, cut + 1]], p[np.r_[0, cut + 1]], p[np.r_[cut, len(p) - 1]]


def _slabs(texts: list[bytes], spec: Spec) -> Iterator[list[tuple[int, bytes, int]]]:
    """Lists of ``(owner, bytes, offset)``: whole texts, or a piece of a long one.  A piece overlaps the next by
    ``length - 1`` bytes, so each string lies whole in exactly one of them."""
    batch, size = [], 0
    for i, raw in enumerate(texts):
        if len(raw) < spec.length:
            continue
        if len(raw) > SLAB:
            for a in range(0, len(raw) - spec.length + 1, SLAB):
                yield [(i, raw[a:a + SLAB + spec.length - 1], a)]
            continue
        batch.append((i, raw, 0))
        size += len(raw)
        if size >= SLAB:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def _joined(parts: list[tuple], spec: Spec):
    """The parts' bytes in one buffer, where whole strings start, and each part's begin, owner and offset."""
    data = np.frombuffer(b"".join(x[1] for x in parts), np.uint8)
    sizes = np.array([len(x[1]) for x in parts], np.int64)
    begin = np.cumsum(sizes) - sizes
    edge = np.zeros(len(data) + 1, np.int8)
    edge[begin] += 1
    edge[begin + sizes - spec.length + 1] -= 1
    ok = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
    return data, ok, begin, np.array([x[0] for x in parts], np.int64), np.array([x[2] for x in parts], np.int64)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Small pieces of Arrow batches: what Python makes of a piece is gone before the next."""
    for b in batches:
        for a in range(0, b.num_rows, rows):
            yield b.slice(a, rows)


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(x, T.LongType()) for x in names]


def _signed(*arrays: np.ndarray) -> list[pa.Array]:
    return [pa.array(x.view(np.int64) if x.dtype == _U else x.astype(np.int64)) for x in arrays]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, key, text)``: the key tells apart the texts of a repeated id."""
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))


def sampled_suffixes(texts: DataFrame, spec: Spec) -> DataFrame:
    """One row per segment of ``texts(id, key, text)``: its owner, first position, number of positions, the
    anchor's distance from the first (``back``), the suffix's ``lead`` and ``head`` and the context ``ctx``."""
    schema = T.StructType([texts.schema["id"], *_longs("key", "first", "n", "back", "lead", "head", "ctx")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            for parts in _slabs(b.column(2).cast(pa.large_binary()).to_pylist(), spec):
                data, ok, begin, owner, offset = _joined(parts, spec)
                anchor, first, last = segments(data, ok, spec)
                roll = Rolling(data)
                which = np.searchsorted(begin, first, "right") - 1
                lead = np.lib.stride_tricks.sliding_window_view(data, 8)[anchor].copy().view(">u8").ravel().astype(_U)
                # the anchor's place in the context and the context's size count too
                ctx = roll.of(first, last + spec.length) ^ _mix(
                    ((anchor - first).astype(_U) << _U(32)) | (last - first).astype(_U))
                rows = pa.array(owner[which])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(rows), b.column(1).take(rows), *_signed(
                        first - begin[which] + offset[which], last - first + 1, anchor - first, lead ^ _U(1 << 63),
                        roll.of(anchor, anchor + (spec.length - spec.window + 1)), ctx)], names=schema.names)

    long_enough = texts.where(F.octet_length("text") >= spec.length)
    return long_enough.mapInArrow(run, schema)


class SuffixIndex:
    """A family of levels, each a sorted table ``(lead, head, n)`` in the shared folder.

    ``add`` scans a batch's suffix array against every level and returns the matched heads; the batch then
    becomes a level, and levels of equal size (in batches) are merged before the next one comes.
    """

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []

    def _merge_equal(self) -> None:
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, b), (_, a) = self.levels.pop(), self.levels.pop()
            merged = a.unionByName(b).groupBy("lead", "head").agg(F.sum("n").alias("n"))
            self.levels.append((2 * size, stage(merged.sortWithinPartitions("lead", "head"), "suffix-level")))

    def add(self, suffixes: DataFrame) -> DataFrame:
        """Heads ``(lead, head, n)`` of the batch that occur twice in it or also in a level; n: how often in the batch."""
        self._merge_equal()
        array = suffixes.groupBy("lead", "head").agg(F.count(F.lit(1)).alias("n"))
        array = stage(array.sortWithinPartitions("lead", "head"), "suffix-array")
        found = array.where("n > 1").select("lead", "head", "n")
        for _, level in self.levels:
            met = array.join(level.select("lead", "head"), ["lead", "head"], "left_semi")
            found = found.unionByName(met.select("lead", "head", "n"))
        self.levels.append((1, array))
        return found


def _several(kinds: DataFrame, core: str) -> DataFrame:
    """Rows of ``kinds`` whose core has several distinct contexts.

    The counted cores are written first: the join then has an exchange of its own, which AQE can split."""
    counts = kinds.groupBy(core).agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    return kinds.join(stage(counts, f"several-{core}"), core, "left_semi")


def _with_owner(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on ``(id, key)``, null ids included; ``right`` has one row for each."""
    r = right.withColumnsRenamed({"id": "_id", "key": "_key"})
    on = left["id"].eqNullSafe(r["_id"]) & (left["key"] == r["_key"])
    return left.join(r, on, how).drop("_id", "_key")


def _packed(texts: DataFrame) -> DataFrame:
    """``texts`` with its text as compressed bytes, for the shuffle (null: empty)."""
    at = texts.columns.index("text")
    schema = T.StructType([T.StructField("text", T.BinaryType()) if f.name == "text" else f for f in texts.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for b in _slices(batches):
            cols = list(b.columns)
            raw = cols[at].cast(pa.large_binary()).to_pylist()
            cols[at] = pa.array([pack.compress(x or b"") for x in raw], pa.binary())
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return texts.mapInArrow(run, schema)


def _cut_contexts(joined: DataFrame, spec: Spec) -> DataFrame:
    """The bytes of each wanted context, from ``(id, key, text, parts)``."""
    schema = T.StructType([joined.schema["id"], *_longs("key", "first", "n", "back", "weight"),
                           T.StructField("bytes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in _slices(batches, 64):
            for i, (packed, parts) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                raw = unpack.decompress(packed)
                for a in range(0, len(parts), 4096):
                    some = parts[a:a + 4096]
                    cols = [pa.array([x[c] for x in some], pa.int64()) for c in ("first", "n", "back", "weight")]
                    rows = pa.array(np.full(len(some), i))
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(rows), b.column(1).take(rows), *cols,
                         pa.array([raw[x["first"]:x["first"] + x["n"] - 1 + spec.length] for x in some], pa.binary())],
                        names=schema.names)

    return joined.select("id", "key", "text", "parts").mapInArrow(run, schema)


def _column(b: pa.RecordBatch, name: str) -> np.ndarray:
    return b.column(b.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(np.int64)


def _blocks(contexts: DataFrame, spec: Spec) -> DataFrame:
    """Blocks of positions at anchor distances 16 k to 16 k + 15, with the bytes common to all strings of such a
    block (``core``) and its own whole context (``whole``)."""
    schema = T.StructType([contexts.schema["id"], *_longs("key", "of", "first", "n", "weight", "core", "whole")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 1024):
                b = whole.slice(a, 1024)
                raw = b.column(b.schema.get_field_index("bytes")).to_pylist()
                data = np.frombuffer(b"".join(raw), np.uint8)
                begin = np.cumsum([0] + [len(x) for x in raw[:-1]])
                first, n, back = (_column(b, x) for x in ("first", "n", "back"))
                top, low = back // BLOCK, (back - n + 1) // BLOCK             # block numbers, first position's first
                count = top - low + 1
                row = np.repeat(np.arange(len(raw)), count)
                number = top[row] - (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count))
                anchor = back[row]                                            # all relative to the context's begin
                p0 = np.maximum(anchor - BLOCK * number - (BLOCK - 1), 0)
                p1 = np.minimum(anchor - BLOCK * number, n[row] - 1)
                at, c0 = begin[row], anchor - BLOCK * number
                roll = Rolling(data)
                core = roll.of(at + c0, at + c0 + (spec.length - BLOCK + 1))
                own = roll.of(at + p0, at + p1 + spec.length) ^ _mix(
                    ((anchor - p0).astype(_U) << _U(32)) | (p1 - p0).astype(_U))
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(rows), b.column(1).take(rows), *_signed(
                        first[row], first[row] + p0, p1 - p0 + 1, _column(b, "weight")[row], core, own)],
                    names=schema.names)

    return contexts.mapInArrow(run, schema)


def _strings(joined: DataFrame, spec: Spec) -> DataFrame:
    """Every string of the wanted blocks, by two hashes, from ``(id, key, first, bytes, parts)``."""
    schema = T.StructType([joined.schema["id"], *_longs("key", "first", "weight", "a", "b")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, 64):
            first = _column(b, "first").tolist()
            raws, parts = (b.column(b.schema.get_field_index(x)).to_pylist() for x in ("bytes", "parts"))
            for i, (raw, some) in enumerate(zip(raws, parts)):
                data = np.frombuffer(raw, np.uint8)
                p = np.concatenate([np.arange(x["first"], x["first"] + x["n"]) for x in some]) - first[i]
                weight = np.repeat([x["weight"] for x in some], [x["n"] for x in some])
                rows = pa.array(np.full(len(p), i))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(rows), b.column(1).take(rows), *_signed(
                        p + first[i], weight, *(Rolling(data, k).of(p, p + spec.length) for k in (0, 1)))],
                    names=schema.names)

    return joined.select("id", "key", "first", "bytes", "parts").mapInArrow(run, schema)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spec: Spec = Spec(),
            batches: int = 4) -> DataFrame:
    """``(id, key, spans)``: for each text that has any, the runs ``[first, last]`` of starts of repeated strings, and
    single starts, where first and last are one: those at first + i for each bit i of ``mask``."""
    texts = _keyed(docs, id_col, text_col)
    index, every, heads = SuffixIndex(), None, None
    for i in range(batches):
        rows = stage(sampled_suffixes(texts.where(F.pmod(F.xxhash64("id", "key"), F.lit(batches)) == i), spec), "suffixes")
        found = index.add(rows)
        every, heads = (rows, found) if every is None else (every.unionByName(rows), heads.unionByName(found))
    heads = stage(heads.groupBy("lead", "head").agg(F.sum("n").alias("n")), "heads")
    # A head that stands at a thousandth of all anchors: there are a few thousand at most (a batch names a head once
    # for itself and once a level), so they are broadcast, and no key of the shuffled join is hot.
    hot = F.broadcast(heads.where(F.col("n") * 1000 >= every.agg(F.count(F.lit(1))).scalar()))
    on = ["lead", "head"]
    matched = every.join(hot, on, "left_semi").unionByName(every.join(hot, on, "left_anti").join(heads, on, "left_semi"))
    matched = stage(matched.drop("lead"), "matched")

    contexts = stage(matched.groupBy("head", "ctx").agg(
        F.count(F.lit(1)).alias("weight"), F.min(F.struct("id", "key", "first", "n", "back")).alias("owner")), "contexts")
    span = ["id", "key", "first", (F.col("first") + F.col("n") - 1).alias("last")]
    sure = matched.join(contexts.where("weight > 1"), ["head", "ctx"], "left_semi").select(*span)

    # Texts meet their open contexts once; the rest works on the contexts' own bytes.
    open_ = _several(contexts, "head").select("owner.*", "weight")
    wanted = open_.groupBy("id", "key").agg(F.collect_list(F.struct("first", "n", "back", "weight")).alias("parts"))
    bytes_ = stage(_cut_contexts(_with_owner(_packed(texts.where(F.octet_length("text") >= spec.length)), wanted), spec),
                   "open-contexts")

    blocks = stage(_blocks(bytes_, spec), "blocks")
    kinds = stage(blocks.groupBy("core", "whole").agg(
        F.sum("weight").alias("weight"), F.min(F.struct("id", "key", "of", "first", "n")).alias("owner")), "block-kinds")
    settled = blocks.where("weight = 1").join(kinds.where("weight > 1"), ["core", "whole"], "left_semi").select(*span)

    open_ = _several(kinds, "core").select("owner.*", "weight")
    wanted = open_.groupBy("id", "key", "of").agg(F.collect_list(F.struct("first", "n", "weight")).alias("parts"))
    r = wanted.withColumnsRenamed({"id": "_id", "key": "_key"})
    joined = bytes_.drop("n", "weight").join(
        r, bytes_["id"].eqNullSafe(r["_id"]) & (bytes_["key"] == r["_key"]) & (bytes_["first"] == r["of"]))
    strings = stage(_strings(joined, spec), "strings")
    twice = stage(strings.groupBy("a", "b").agg(F.sum("weight").alias("w")).where("w > 1"), "repeated-strings")
    single = strings.where("weight = 1").join(twice, ["a", "b"], "left_semi")
    # single starts, 32 to a row, so that a text's list is as long as its runs rather than its bytes
    cell = F.col("first") - F.pmod(F.col("first"), F.lit(CELL))
    masks = single.groupBy("id", "key", cell.alias("cell")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(first, {CELL}) as int))")).alias("mask"))
    masks = masks.select("id", "key", F.col("cell").alias("first"), F.col("cell").alias("last"), "mask")

    spans = sure.unionByName(settled).withColumn("mask", F.lit(1).cast("long")).unionByName(masks)
    return spans.groupBy("id", "key").agg(F.collect_list(F.struct("first", "last", "mask")).alias("spans"))


def _starts(spans: list[dict] | None) -> Iterator[tuple[int, int]]:
    """First and last start of each run."""
    for x in spans or ():
        first, mask = x["first"], x["mask"]
        if mask == 1:
            yield first, x["last"]
            continue
        while mask:
            skip = (mask & -mask).bit_length() - 1
            mask >>= skip
            size = (~mask & (mask + 1)).bit_length() - 1
            yield first + skip, first + skip + size - 1
            first, mask = first + skip + size, mask >> size


def _runs(spans: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Maximal removed runs ``[begin, end)``."""
    out: list[tuple[int, int]] = []
    for a, z in sorted((first, last + length) for first, last in _starts(spans)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def _kept(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for a, z in runs:
        out.append(raw[at:a])
        at = z
    return b"".join([*out, raw[at:]])


def _joined_spans(rows: DataFrame, spec: Spec, batches: int) -> DataFrame:
    """``rows(id, text, ..)`` with compressed texts and their ``spans``; names are this module's own."""
    spans = repeats(rows, "id", "text", spec, batches)
    return _with_owner(_packed(rows.withColumn("key", F.xxhash64("text"))), spans, "left")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spec: Spec = Spec(),
            batches: int = 4) -> DataFrame:
    """For each row: the id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    joined = _joined_spans(rows, spec, batches).select("id", "text", "spans")
    schema = T.StructType([docs.schema[id_col], *_longs("n_bytes", "n_removed", "n_spans"),
                           T.StructField("kept_sha256", T.StringType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in _slices(it):
            rows = []
            for packed, spans in zip(b.column(1), b.column(2)):
                raw, runs = unpack.decompress(packed.as_py()), _runs(spans.as_py(), spec.length)
                rows.append((len(raw), sum(z - a for a, z in runs), len(runs),
                             hashlib.sha256(_kept(raw, runs)).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64()] * 3 + [pa.string()]))],
                names=schema.names)

    return joined.mapInArrow(run, schema)


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spec: Spec = Spec(),
           batches: int = 4) -> DataFrame:
    """``docs`` with the repeated bytes gone from its texts; a character that loses a byte goes whole.

    Null texts stay null; every row stays, also one left without text; other columns stay, whatever their names.
    """
    names = docs.columns
    at, others = names.index(text_col), [c for c in names if c != text_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(text_col).isNull().alias("none"),
                       F.struct(*others).alias("row"))
    joined = _joined_spans(rows, spec, batches).select("text", "none", "spans", "row")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in _slices(it):
            texts = [None if none.as_py() else
                     _kept(unpack.decompress(x.as_py()), _runs(spans.as_py(), spec.length)).decode("utf-8", "ignore")
                     for x, none, spans in zip(*b.columns[:3])]
            cols = b.column(3).flatten()
            cols.insert(at, pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return joined.mapInArrow(run, docs.schema)
