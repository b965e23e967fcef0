"""Sum-of-squares online packing of tokenised documents into windows.

A document longer than a window first fills whole windows; its rest goes, as it comes, to the fill level that
leaves the smallest sum over levels of (number of windows partly filled to that level) squared; a level array
holds those numbers.  That rule avoids piling up windows of one awkward fill.  When a task ends, or its open
windows reach ``max_open``, the open windows' pieces are laid end to end and cut again: whole windows, then
sequences whose lengths are powers of two, which need no padding.

Each task packs the rows of its own input partition, so nothing is shuffled and memory is bounded by
``max_open`` windows; sequence numbers hold the partition's number above bit 33.

Defined cases: a null text is an empty one; an empty text is its end id alone; a repeated row is packed again;
an empty table gives no pieces; further columns are ignored.  Each id lies in exactly one piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from dealflow.llm.token_cache import CACHE_ENTRIES, token_cache

WINDOW = 4096
MAX_OPEN = 4096
_ID_BYTES = 4

#: A piece: document's row, first id's place in it, its ids as little-endian 32-bit bytes.
Piece = tuple[int, int, bytes]


class LevelPacker:
    """Sum-of-squares packing of pieces; ``ready`` holds the finished sequences, lists of pieces."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.levels = np.zeros(window + 1, np.int64)          # windows filled to each level
        self.open: dict[int, list[list[Piece]]] = {}
        self.n_open = 0
        self.ready: list[list[Piece]] = []

    def best_level(self, size: int) -> int:
        """The fill level (0: a new window) to put ``size`` ids at; ties to the fullest."""
        levels, top = self.levels, self.window - size
        change = 2 * levels[size:] + 1
        change[-1] = 0                                         # a full window leaves the array
        change[1:] += 1 - 2 * levels[1:top + 1]
        change[1:][levels[1:top + 1] == 0] = np.iinfo(np.int64).max
        return top - int(np.argmin(change[::-1]))

    def add(self, row: int, ids: bytes) -> None:
        step = self.window * _ID_BYTES
        whole = len(ids) // step * step
        for a in range(0, whole, step):
            self.ready.append([(row, a // _ID_BYTES, ids[a:a + step])])
        if whole == len(ids):
            return
        size = (len(ids) - whole) // _ID_BYTES
        level = self.best_level(size)
        if level:
            pieces = self.open[level].pop()
            self.levels[level] -= 1
            self.n_open -= 1
        else:
            pieces = []
        pieces.append((row, whole // _ID_BYTES, ids[whole:]))
        if level + size == self.window:
            self.ready.append(pieces)
            return
        self.open.setdefault(level + size, []).append(pieces)
        self.levels[level + size] += 1
        self.n_open += 1
        if self.n_open >= self.max_open:
            self.drain()

    def drain(self) -> None:
        """Cut the open windows' pieces again into sequences without padding."""
        pieces = [p for level in sorted(self.open, reverse=True) for w in self.open[level] for p in w]
        left = sum(len(p[2]) for p in pieces) // _ID_BYTES
        self.levels[:] = 0
        self.open.clear()
        self.n_open = 0
        at = skip = 0
        while left:
            room = min(self.window, left if left >= self.window else 1 << (left.bit_length() - 1))
            left -= room
            sequence: list[Piece] = []
            while room:
                row, start, ids = pieces[at]
                take = min(room, len(ids) // _ID_BYTES - skip)
                sequence.append((row, start + skip, ids[skip * _ID_BYTES:(skip + take) * _ID_BYTES]))
                room -= take
                skip += take
                if skip * _ID_BYTES == len(ids):
                    at, skip = at + 1, 0
            self.ready.append(sequence)


def pack(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, max_open: int = MAX_OPEN, with_ids: bool = True,
         cache_entries: int = CACHE_ENTRIES) -> DataFrame:
    """One row per piece: the document's id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset`` and, if asked for, ``ids``.  ``cache_entries`` trades a worker's memory for time, results are the same."""
    kind = docs.schema[id_col]
    schema = T.StructType([kind] + [T.StructField(x, T.LongType()) for x in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")] + [
        T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, packer = token_cache(path, cache_entries), LevelPacker(window, max_open)
        number = TaskContext.get().partitionId() << 33
        waiting: dict[int, tuple] = {}                        # row -> its id, its ids and how many still have no piece
        row = 0

        def emit() -> pa.RecordBatch:
            nonlocal number
            out: list[list] = [[] for _ in schema.names]
            for sequence in packer.ready:
                offset = 0
                for r, start, ids in sequence:
                    n = len(ids) // _ID_BYTES
                    doc, total, left = waiting[r]
                    values = [doc, start, n, zlib.crc32(ids), total, number, offset]
                    if with_ids:
                        values.append(np.frombuffer(ids, "<i4"))
                    for column, value in zip(out, values):
                        column.append(value)
                    offset += n
                    if left == n:
                        del waiting[r]
                    else:
                        waiting[r] = (doc, total, left - n)
                number += 1
            packer.ready = []
            kinds = [id_kind] + [pa.int64()] * 6 + [pa.list_(pa.int32())] * with_ids
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=schema.names)

        id_kind = pa.null()
        for b in batches:
            id_kind = b.column(0).type
            for doc, ids in zip(b.column(0).to_pylist(), cache.encode_all(b.column(1).to_pylist())):
                ids += end
                waiting[row] = (doc, len(ids) // _ID_BYTES, len(ids) // _ID_BYTES)
                packer.add(row, ids)
                row += 1
                if len(packer.ready) >= 1024:
                    yield emit()
        packer.drain()
        if packer.ready:
            yield emit()

    return docs.select(id_col, text_col).mapInArrow(run, schema)
