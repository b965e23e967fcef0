"""Byte-level BPE by monoid tree reduction.

A piece (one match of the split pattern) is encoded as a tree: both halves recursively, then joined.  A join
re-encodes a window around the border, which grows until the tokens outside it are proven stable.  The proof:
a token sequence is the BPE encoding of its bytes exactly if each pair of neighbours is, that is, if encoding
the two tokens' bytes together gives the same two tokens back.  Pairs inside either half held before, the
window's pairs hold as it was just encoded, so only the pairs across the window's two edges are looked up.
Pieces of a text never interact, so a text's ids are the concatenation of its pieces' (the same monoid, with
nothing to repair), and decoding concatenates bytes up the tree.

Defined cases: a null or empty text has no ids, and decodes to no bytes; special tokens don't exist, their
strings are ordinary text; repeated rows are encoded one by one; other columns are ignored.  Texts of any
length, also a single piece of many megabytes, take time in proportion (n log n copying).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from dealflow.llm.token_cache import regular

LEAF = 8


class _Irregular(Exception):
    """A text with white space beside a space: its chunks do not hold whole pieces."""
CACHE_ENTRIES = 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class MonoidBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF, limit: int = CACHE_ENTRIES):
        self.ranks, self.leaf, self.limit = ranks, leaf, limit
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.stable: dict[tuple[int, int], bool] = {}
        self.short: dict[bytes, list[int]] = {}
        self.chunks: dict[str, tuple[bytes, bytes]] = {}

    def merged(self, raw: bytes) -> list[int]:
        """:meth:`merge`, remembered for short strings: halves and windows recur far more than whole words."""
        if (ids := self.short.get(raw)) is None:
            ids = self.merge(raw)
            if len(raw) <= 4 * self.leaf:
                if len(self.short) >= self.limit:
                    self.short.clear()
                self.short[raw] = ids
        return ids

    def merge(self, raw: bytes) -> list[int]:
        """The definition: merge the neighbours of lowest rank, leftmost first, until none are in the table."""
        ranks = self.ranks
        parts = [raw[i:i + 1] for i in range(len(raw))]
        pairs = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
        while pairs:
            low, at = None, -1
            for i, r in enumerate(pairs):
                if r is not None and (low is None or r < low):
                    low, at = r, i
            if low is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1])
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at])
        return [ranks[p] for p in parts]

    def neighbours(self, a: int, b: int) -> bool:
        """Whether tokens a, b are the encoding of their bytes."""
        if (known := self.stable.get((a, b))) is None:
            known = self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            if len(self.stable) >= self.limit:
                self.stable.clear()
            self.stable[a, b] = known
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        if self.neighbours(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = self.merged(b"".join(map(self.bytes_of.__getitem__, left[len(left) - i:] + right[:j])))
            grow_left = i < len(left) and not self.neighbours(left[-i - 1], window[0])
            grow_right = j < len(right) and not self.neighbours(window[-1], right[j])
            if not grow_left and not grow_right:
                return left[:len(left) - i] + window + right[j:]
            if grow_left:
                i = min(2 * i, len(left))
            if grow_right:
                j = min(2 * j, len(right))

    def encode_piece(self, raw: bytes) -> list[int]:
        if len(raw) <= self.leaf:
            return [self.ranks[raw]] if raw in self.ranks else self.merged(raw)
        half = len(raw) // 2
        return self.join(self.encode_piece(raw[:half]), self.encode_piece(raw[half:]))

    def encode(self, text: str) -> list[int]:
        """The ids of a text, as the library of the rank file gives them."""
        out: list[int] = []
        for piece in self.split(text):
            raw = piece.encode()
            if (whole := self.ranks.get(raw)) is not None:
                out.append(whole)
            else:
                out += self.encode_piece(raw)
        return out

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids, concatenated up a tree of halves."""
        if len(ids) <= 64:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])

    # A text's reduction: chunks between single spaces hold whole pieces, and the commoner ones are remembered.
    def _chunk(self, text: str) -> tuple[bytes, bytes]:
        ids = self.encode(text)
        return b" ".join(b"%d" % i for i in ids), self.decode(ids)

    def _known(self, chunk: str) -> tuple[bytes, bytes]:
        if (pair := self.chunks.get(chunk)) is None:
            if not regular(chunk):
                raise _Irregular
            pair = self._chunk(chunk if chunk[0] == "\n" else " " + chunk)
            if len(self.chunks) < self.limit:
                self.chunks[chunk] = pair
        return pair

    def round_trip(self, text: str) -> tuple[bytes, bytes]:
        """Decimal ids joined by one space, and the bytes decoded from them."""
        first, *rest = text.replace("\n", " \n").split(" ")
        try:
            if not rest or not regular(first) or first[0] == "\n":
                raise _Irregular
            parts = [self._chunk(first), *map(self._known, rest)]
        except _Irregular:
            return self._chunk(text)
        return b" ".join([p[0] for p in parts]), b"".join([p[1] for p in parts])


@lru_cache(maxsize=2)
def monoid(path: str, pattern: str) -> MonoidBpe:
    return MonoidBpe(read_ranks(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids, decoded)``: the ids of each whole text and the bytes they decode to.  No shuffle."""
    schema = T.StructType([docs.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = monoid(path, pattern)
        for b in batches:
            ids = [bpe.encode(x or "") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(map(bpe.decode, ids), pa.binary())],
                names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)`` of each whole text.  No shuffle."""
    schema = T.StructType([docs.schema[id_col], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = monoid(path, pattern)
        for b in batches:
            n, one, two = [], [], []
            for x in b.column(1).to_pylist():
                ids, raw = bpe.round_trip(x or "")
                n.append(ids.count(b" ") + 1 if ids else 0)
                one.append(hashlib.sha256(ids).hexdigest())
                two.append(hashlib.sha256(raw).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(one, pa.string()), pa.array(two, pa.string())],
                names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
