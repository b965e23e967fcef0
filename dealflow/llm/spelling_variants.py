"""Spelling variants: words one edit apart, found by sorting rotations (a permuterm index), grouped under a root.

Words are runs of Latin letters, counted over all texts.  Each word, closed by a terminator, is rotated at every
letter.  A rotation names the place just before its first character: two words that differ only in the character at
one place have rotations that are alike but for their last character, and a word with that character deleted has a
rotation equal to the rest.  So every rotation enters the sorted list twice, as it stands and without its last
character, and after sorting each run of equal entries holds the words that agree everywhere but at one place: any
two with a last character of their own are a replacement apart, and the one that stands without is a deletion away
from each.  Where a letter is repeated, deleting either gives the same word; only the last of the repeat counts.

A run holds at most one entry for each letter of the alphabet and one more, whatever the data, so it is scanned in
one go; its counts and its best member go to each of its members, and no pair is written.  Words are numbered in
code-point order when they are written, so entries carry numbers, and ties go to the smaller one.  Entries of words
longer than ``LONG`` carry two 61-bit hashes of the rotation instead, computed for all rotations in linear time.

Following forms to the root takes ceil(log2(depth)) doubling rounds over the words that have a form; each form is
``ratio`` times as frequent, so the depth is at most log(largest count) / log(ratio).

Defined cases: a null or empty text has no words; a null id is written as the empty string before the colon; equal
rows are counted each; equal counts go to the smaller word in code-point order; an empty table has no words;
further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealflow.llm.common import stage
from dealflow.operators.lookup import lookup

LONG = 64
FLUSH = 200_000                                # distinct words that a task holds before it passes them on
END = "$"
RUN = re.compile("[a-zÀ-ÿ]+")
_PRIME = (1 << 61) - 1
_BASES = (1_000_003, 998_244_353_999)


@dataclass(frozen=True)
class Spec:
    least_length: int = 6
    least_count: int = 5
    ratio: int = 5                             # a form is at least so many times as frequent
    slip: int = 199                            # a run whose crc32 this divides loses a code point (0: none does)


def occurrences(docs: DataFrame, spec: Spec = Spec(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)``, several rows a word: what each task has met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            some = [(w, n) for w, n in met.items() if len(w) >= spec.least_length]
            met.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in some], pa.string()),
                                               pa.array([x[1] for x in some], pa.int64())], names=["word", "n"])

        for b in batches:
            for doc, text in zip(b.column(0), b.column(1)):
                raw = text.as_py()
                if not raw:
                    continue
                # bytes.lower touches A-Z alone
                own = Counter(RUN.findall(raw.encode().lower().decode()))
                if spec.slip:
                    prefix = zlib.crc32(f"{'' if not doc.is_valid else doc.as_py()}:".encode())
                    for w, n in list(own.items()):
                        h = zlib.crc32(w.encode(), prefix)
                        if h % spec.slip == 0:
                            at = h % len(w)
                            met[w[:at] + w[at + 1:]] += n
                            del own[w]
                met.update(own)
                if len(met) >= FLUSH:
                    yield out()
        yield out()

    return docs.select(id_col, text_col).mapInArrow(run, "word string, n long")


def vocabulary(docs: DataFrame, spec: Spec = Spec(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, word, n)``, written once: ids ascend with the words, by code points."""
    words = occurrences(docs, spec, id_col, text_col).groupBy("word").agg(F.sum("n").alias("n"))
    words = stage(words.where(F.col("n") >= spec.least_count), "words")
    ranked = words.repartitionByRange("word").sortWithinPartitions("word")
    return stage(ranked.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "vocabulary")


def _hashes(word: str) -> Iterator[tuple[str, str]]:
    """For each rotation of a long word: hashes of it and of it without its last character, each rolled from the last."""
    text = [ord(c) for c in word + END]
    size = len(text)
    top = [pow(base, size - 1, _PRIME) for base in _BASES]
    sums = [0, 0]
    for k, base in enumerate(_BASES):
        for c in text:
            sums[k] = (sums[k] * base + c) % _PRIME
    back = [pow(base, -1, _PRIME) for base in _BASES]
    for i in range(size):
        rest = [(h - text[i - 1]) * inverse % _PRIME for h, inverse in zip(sums, back)]
        yield f"#{size} {sums[0]} {sums[1]}", f"#{size - 1} {rest[0]} {rest[1]}"
        sums = [((h - text[i] * p) * base + text[i]) % _PRIME for h, p, base in zip(sums, top, _BASES)]


def entries_of(word: str) -> Iterator[tuple[str, int, bool]]:
    """``(key, last, single)`` of a word: each rotation as it stands (last 0) and without its last character, a letter
    by its code point; single: no equal letter follows it in the word."""
    closed = word + END
    size = len(closed)
    twice = closed + closed
    both = (_hashes(word) if len(word) > LONG else
            ((twice[i:i + size], twice[i:i + size - 1]) for i in range(size)))
    for i, (whole, rest) in enumerate(both):
        yield whole, 0, True
        if i:                                  # rotation 0 ends with the terminator
            yield rest, ord(word[i - 1]), closed[i - 1] != closed[i]


def rotations(words: DataFrame) -> DataFrame:
    """``(key, last, single, id, n)`` from ``words(id, word, n)``."""
    schema = "key string, last int, single boolean, id long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "last", "single", "id", "n"]
        kinds = [pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()]
        out: list[tuple] = []
        for b in batches:
            for i, word, n in zip(*(c.to_pylist() for c in b.columns)):
                for key, last, single in entries_of(word):
                    out.append((key, last, single, i, n))
                    if len(out) >= 16_384:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                        out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return words.select("id", "word", "n").mapInArrow(run, schema)


def scan_groups(group: np.ndarray, last: np.ndarray, single: np.ndarray, ids: np.ndarray, n: np.ndarray):
    """``(id, near, best_n, best_id)`` of every entry that has a neighbour; rows are sorted by group."""
    letter = last > 0
    n_groups = int(group[-1]) + 1

    def best_two(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of largest n (ties: smallest id) of each group, and the next; -1 where there is none."""
        rows = rows[np.lexsort((ids[rows], -n[rows], group[rows]))]
        g = group[rows]
        head = np.r_[True, g[1:] != g[:-1]] if len(g) else np.zeros(0, bool)
        first, second = np.full(n_groups, -1), np.full(n_groups, -1)
        first[g[head]] = rows[head]
        after = np.nonzero(head)[0] + 1
        after = after[after < len(rows)]
        after = after[~head[after]]
        second[g[after]] = rows[after]
        return first, second

    first, second = best_two(np.nonzero(letter)[0])
    lone, _ = best_two(np.nonzero(letter & single)[0])
    bare = np.full(n_groups, -1)
    bare[group[~letter]] = np.nonzero(~letter)[0]
    n_letters = np.bincount(group[letter], minlength=n_groups)
    n_single = np.bincount(group[letter & single], minlength=n_groups)

    rows = np.arange(len(group))
    near = np.where(letter, n_letters[group] - 1 + (single & (bare[group] >= 0)), n_single[group])
    # a letter's best: the first of the others, or the bare word; the bare word's: the best single letter
    other = np.where(first[group] == rows, second[group], first[group])
    one = np.where(letter, other, lone[group])
    two = np.where(letter & single, bare[group], -1)
    better = (one < 0) | ((two >= 0) & ((n[two] > n[one]) | ((n[two] == n[one]) & (ids[two] < ids[one]))))
    best = np.where(better, two, one)
    found = near > 0
    return ids[found], near[found], n[best[found]], ids[best[found]]


def neighbours(entries: DataFrame) -> DataFrame:
    """``(id, near, best_n, best_id)`` per entry with a neighbour, from the sorted list of :func:`rotations`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "near", "best_n", "best_id"]
        held: pa.Table | None = None           # the last run of equal keys may go on in the next batch

        def scan(t: pa.Table) -> pa.RecordBatch:
            key = t.column("key").combine_chunks()
            new = pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False)
            group = np.r_[0, np.cumsum(new)]
            cols = [t.column(c).to_numpy() for c in ("last", "single", "id", "n")]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in scan_groups(group, *cols)], names=names)

        for b in batches:
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            if not t.num_rows:
                continue
            key = t.column("key").combine_chunks()
            same = pc.equal(key, key[len(key) - 1])
            cut = pc.index(same, True).as_py()
            if cut:
                yield scan(t.slice(0, cut))
            held = t.slice(cut)
        if held is not None and held.num_rows:
            yield scan(held)

    ordered = entries.repartitionByRange("key").sortWithinPartitions("key")
    return ordered.mapInArrow(run, "id long, near long, best_n long, best_id long")


def roots(forms: DataFrame, depth: int) -> DataFrame:
    """``(id, root)`` from ``forms(id, form)``: the end of the chain of forms, of at most ``depth`` links."""
    chain = forms.select("id", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(depth, 1))))):
        nxt = chain.select(F.col("id").alias("_key"), F.col("root").alias("_next"))
        chain = lookup(chain, nxt, [(F.col("root"), "_key")], "id", salts=8).select(
            "id", F.coalesce("_next", "root").alias("root"))
        chain = stage(chain, "roots")
    return chain


def group_variants(docs: DataFrame, spec: Spec = Spec(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of the vocabulary."""
    words = vocabulary(docs, spec, id_col, text_col)
    best = F.max_by(F.struct("best_n", "best_id"), F.struct(F.col("best_n"), -F.col("best_id")))
    met = neighbours(rotations(words)).groupBy("id").agg(F.sum("near").alias("n_near"), best.alias("best"))
    near = words.join(met, "id", "left")
    fits = F.col("best.best_n") >= spec.ratio * F.col("n")
    near = stage(near.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                             F.when(fits, F.col("best.best_id")).alias("form"),
                             F.when(fits, F.col("best.best_n")).alias("form_n")), "neighbours")
    top = words.agg(F.max("n")).first()[0] or 0
    depth = int(math.log(max(top / spec.least_count, 1), spec.ratio) + 1e-9) + 1
    ends = roots(near.where("form IS NOT NULL"), depth)
    named = words.select(F.col("id").alias("_id"), F.col("word").alias("_word"))
    out = near.join(ends, "id", "left")
    out = lookup(out, named.withColumnsRenamed({"_id": "_key", "_word": "form_word"}), [(F.col("form"), "_key")], "id", 8)
    out = lookup(out, named.withColumnsRenamed({"_id": "_key", "_word": "root_word"}), [(F.col("root"), "_key")], "id", 8)
    return out.select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"),
                      "n", "n_near", "form_n")
