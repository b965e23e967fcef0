"""Quality rules by compression bands.

A text's zstandard ratio (bytes before / bytes after) is held against a band chosen by the text's length:
above it the text repeats itself, below it the text is noise.  The same bands judge each fixed chunk, and a
document falls when the chunks outside their band hold more than ``max_bad_share`` of its bytes, which finds
a long document that is repetitive or incompressible in a part only.  A base of word counts comes first.

Words are runs of bytes other than ASCII white space, as the base measures define them.

Defined cases: a null text counts as empty; an empty table gives an empty result; a text of no words has all
measures zero and fails the base; repeated rows are judged one by one; other columns are ignored by
:func:`measure` and kept untouched by :func:`keep`.  Whole texts are read, of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\f"
WINDOW = 5

#: (texts shorter than so many bytes, lowest ratio, highest ratio).  A short text has little to share and the frame's
#: own bytes weigh on it, so its ratio is low; a long one refers back further.  A lowest ratio lies between that of
#: random base64 or printable words of the band's length and the lowest hundredth of ordinary text (licences, manuals
#: and documents cut to that length), from 2,048 bytes above random lower-case words, from 16,384 above random hex
#: words too: below those lengths these overlap with ordinary text, and below 100 bytes all noise does.  The highest
#: ratios lie about a third beyond ordinary prose.
BANDS = (
    (64, 0.0, 1.6),
    (100, 0.0, 2.2),
    (112, 0.96, 2.2),
    (128, 1.01, 2.2),
    (144, 1.04, 2.3),
    (160, 1.05, 2.3),
    (192, 1.07, 2.3),
    (224, 1.11, 2.3),
    (256, 1.14, 2.3),
    (384, 1.19, 2.5),
    (512, 1.25, 2.5),
    (768, 1.32, 2.7),
    (1024, 1.42, 2.7),
    (2048, 1.49, 2.9),
    (4096, 1.7, 3.0),
    (8192, 1.715, 3.1),
    (16384, 1.9, 3.2),
    (65536, 2.0, 3.4),
    (1 << 62, 2.0, 4.0),
)


@dataclass(frozen=True)
class Rules:
    level: int = 3
    chunk_bytes: int = 4096
    max_bad_share: float = 0.25
    min_words: int = 10
    max_repeat_percent: int = 20
    bands: tuple = BANDS


MEASURES = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()), T.StructField("base_failed", T.BooleanType()),
    T.StructField("ratio", T.DoubleType()), T.StructField("bad_chunk_share", T.DoubleType()),
    T.StructField("kept", T.BooleanType()),
])


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 5-word window occurring at least twice in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    code: dict[bytes, int] = {}
    a = np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, len(words))
    if len(code) == len(words):
        return 0
    _, pair = np.unique(a[:-1] * len(code) + a[1:], return_inverse=True)          # exact: ids, not hashes
    _, four = np.unique(pair[:-2] * (int(pair.max()) + 1) + pair[2:], return_inverse=True)
    _, five, count = np.unique(four[:-1] * len(code) + a[WINDOW - 1:], return_inverse=True, return_counts=True)
    starts = np.nonzero(count[five] > 1)[0]
    if not len(starts):
        return 0
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def outside(n_bytes: int, ratio: float, bands: tuple) -> bool:
    low, high = next((lo, hi) for below, lo, hi in bands if n_bytes < below)
    return not low <= ratio <= high


def judge(raw: bytes, packer: zstandard.ZstdCompressor, rules: Rules) -> tuple:
    words = raw.split()
    n_words = len(words)
    n_space = len(raw) - len(raw.translate(None, SPACES))
    chars = np.frombuffer(raw, np.uint8)
    points = int(np.count_nonzero((chars & 0xC0) != 0x80))
    seen: set[bytes] = set()
    dup_lines = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup_lines += 1
        elif line.translate(None, SPACES):
            seen.add(line)
    repeated = repeat_words(words)
    failed = n_words < rules.min_words or 100 * repeated > rules.max_repeat_percent * n_words
    ratio = len(raw) / len(packer.compress(raw)) if raw else 0.0
    bad = 0
    if len(raw) > rules.chunk_bytes:
        view = memoryview(raw)
        for i in range(0, len(raw), rules.chunk_bytes):
            part = view[i:i + rules.chunk_bytes]
            if outside(len(part), len(part) / len(packer.compress(part)), rules.bands):
                bad += len(part)
    share = bad / len(raw) if raw else 0.0
    kept = not failed and not outside(len(raw), ratio, rules.bands) and share <= rules.max_bad_share
    return (n_words, points - n_space, len(raw) - len(raw.translate(None, SYMBOLS)), dup_lines, repeated, failed,
            ratio, share, kept)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """One row per row of ``docs``: the id and :data:`MEASURES`.  No shuffle."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *MEASURES.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=rules.level)
        for b in batches:
            rows = [judge(x or b"", packer, rules) for x in b.column(1).cast(pa.large_binary()).to_pylist()]
            cols = list(zip(*rows)) if rows else [()] * len(MEASURES)
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def keep(docs: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` whose text the rules keep, all columns unchanged.  No shuffle."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=rules.level)
        for b in batches:
            texts = b.column(at).cast(pa.large_binary()).to_pylist()
            yield b.filter(pa.array([judge(x or b"", packer, rules)[-1] for x in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
