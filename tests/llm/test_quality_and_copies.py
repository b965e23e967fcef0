"""Compression bands, SimHash BK-trees and suffix levels against brute force, and their defined cases."""

import hashlib
import os
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dealflow.llm import compression_bands as bands
from dealflow.llm import simhash_bktree as sim
from dealflow.llm import suffix_levels as suf

rng = random.Random(5)
WORDS = ["".join(rng.choices("abcdefghijklmnoprstuvwyz", k=rng.randint(2, 9))) for _ in range(3000)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (".\n" if r.random() < 0.05 else "") for _ in range(n))


# ---- quality rules

def brute_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    twice = {g for g in grams if grams.count(g) > 1}
    covered = {j for i, g in enumerate(grams) if g in twice for j in range(i, i + 5)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "né", "#", "x|y", "\n", " ", "\t", "\x0b", "\x85", " ", "a b c d e", "z\nz"]),
                max_size=60).map(" ".join))
def test_base_measures(text):
    import zstandard

    got = bands.judge(text.encode(), zstandard.ZstdCompressor(), bands.Rules())
    assert got[:6] == brute_measures(text)


def test_bands_keep_prose_and_reject_repetition_and_noise(rows):
    r = random.Random(1)
    noise = "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=6000))
    noise = " ".join(noise[i:i + 37] for i in range(0, 6000, 37))
    long_words = " ".join("ha" * (20 + i) for i in range(60))           # no 5-word window twice, yet all alike
    half = prose(900, 2) + " " + " ".join("ho" * (30 + i) for i in range(90))
    data = [(1, prose(40, 1)), (2, prose(400, 2)), (3, prose(20_000, 3)), (4, noise), (5, long_words), (6, half),
            (7, prose(12, 9)), (8, None), (9, ""), (9, "")]
    got = {(x.doc_id, x.n_words): x for x in bands.measure(rows("doc_id long, text string", data)).collect()}
    kept = {k[0]: x.kept for k, x in got.items()}
    assert kept == {1: True, 2: True, 3: True, 4: False, 5: False, 6: False, 7: True, 8: False, 9: False}
    assert not got[4, len(noise.split())].base_failed and not got[5, 60].base_failed
    assert got[8, 0].word_chars == 0 and got[8, 0].base_failed


def judged(text, packer):
    return bands.judge(text.encode(), packer, bands.Rules())


@pytest.mark.parametrize("letters,least", [("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 100),
                                           ("".join(map(chr, range(33, 127))), 100), ("abcdefghijklmnopqrstuvwxyz", 2048),
                                           ("0123456789abcdef", 16384)])
def test_noise_falls_in_every_band(letters, least):
    import zstandard

    r, packer = random.Random(9), zstandard.ZstdCompressor(level=3)
    lengths = {n for below, _, _ in bands.BANDS[:-1] for n in (below, (below * 5) // 4)} | {100, 400, 800, 200_000}
    for n in sorted(x for x in lengths if x >= least):
        for _ in range(3):
            text = ""
            while len(text) < n:
                text += "".join(r.choices(letters, k=r.randint(3, 9))) + " "
            got = judged(text[:n], packer)
            assert not got[5] and not got[-1], (n, got)


def test_clean_documents_stay(spark, sf_small):
    """At most one in 200 documents of ordinary text, or of their beginnings, is taken for noise."""
    import zstandard

    packer, seen, lost = zstandard.ZstdCompressor(level=3), 0, 0
    for x in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").collect():
        raw = (x.text or "").encode()
        for n in (100, 150, 250, 500, 1000, 3000, len(raw)):
            if n <= len(raw) and len(raw[:n].split()) >= 10:
                ratio, low = len(raw[:n]) / len(packer.compress(raw[:n])), next(lo for b, lo, _ in bands.BANDS if n < b)
                seen, lost = seen + 1, lost + (ratio < low)
    assert seen > 100 and lost <= seen // 200


def test_keep_leaves_columns_alone(rows):
    d = rows("kept long, text string, doc_id long, ratio string", [(1, prose(50, 1), None, "x"), (2, "a b", 2, None)])
    out = bands.keep(d)
    assert out.columns == d.columns and [x.kept for x in out.collect()] == [1]
    assert bands.keep(d.limit(0)).count() == 0 and bands.measure(d.limit(0)).count() == 0


# ---- SimHash

def brute_components(fps, ids):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    known = {}
    for i, d in enumerate(ids):
        if d is not None:
            known[find(i)] = min(known.get(find(i), d), d)
    return [known.get(find(i)) for i in range(len(ids))]


def test_fingerprint_by_definition():
    import xxhash

    text = "The  quick\tBrown fox  Jumps over Äpfel"
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert sim.fingerprint(text.encode()) & (2 ** 64 - 1) == want
    assert sim.fingerprint(b" \n") == 0
    assert sim.fingerprint(b"two words") & (2 ** 64 - 1) == xxhash.xxh64_intdigest(b"two words", 42)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1), min_size=1, max_size=40, unique=True), st.integers(0, 6), st.data())
def test_bk_tree_finds_all_within(values, radius, data):
    near = values + [values[0] ^ (1 << i) ^ (1 << (i * 7 % 64)) for i in range(5)]
    near = list(dict.fromkeys(near))
    q = data.draw(st.sampled_from(near))
    assert sorted(sim.BKTree(near).within(q, radius)) == [i for i, v in enumerate(near) if (v ^ q).bit_count() <= radius]


@pytest.mark.parametrize("tree_size", [3, 1024])
def test_links_between_fingerprints_lose_nothing(rows, tree_size):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(12)]
    fps = {b ^ sum(1 << i for i in r.sample(range(64), r.randint(0, 4))) for b in base for _ in range(12)} | {0, 7, 2 ** 63}
    signed = sorted(f - 2 ** 64 if f >> 63 else f for f in fps)
    edges = sim.linked(rows("fp long", [(f,) for f in signed]), 3, tree_size)
    comp = {x.node: x.root for x in sim.components(edges).collect()}
    want = brute_components(sorted(fps), sorted(fps))
    got = [comp.get(f - 2 ** 64 if f >> 63 else f, f - 2 ** 64 if f >> 63 else f) for f in sorted(fps)]
    pairs = {(a, b) for a in range(len(want)) for b in range(a) if want[a] == want[b]}
    assert pairs == {(a, b) for a in range(len(got)) for b in range(a) if got[a] == got[b]}


def test_label_defined_cases(rows):
    text = prose(300, 4)
    words = text.split(" ")
    near = " ".join(words[:200] + ["changed"] + words[201:])
    data = [(5, text, "x"), (3, text, "y"), (9, near, "z"), (None, text, "n"), (7, None, ""), (8, "", ""), (8, "", ""),
            (1, "one word", ""), (2, prose(50, 6), "")]
    d = rows("doc_id long, text string, component_id string", data)
    got = sorted(((x.doc_id, x.component_id, x.fp) for x in sim.label(d).collect()), key=str)
    fps = [sim.fingerprint((t or "").encode()) & (2 ** 64 - 1) for _, t, _ in data]
    want = brute_components(fps, [i for i, _, _ in data])
    assert [(a, b) for a, b, _ in got] == sorted(((i, c) for (i, _, _), c in zip(data, want)), key=str)
    assert sim.label(d.limit(0)).count() == 0
    left = sim.one_per_component(d)
    assert left.columns == d.columns
    assert sorted(x.doc_id for x in left.collect() if x.doc_id is not None) == sorted(
        {c for c in want if c is not None})
    assert left.where("doc_id IS NULL").count() == 1


# ---- suffix levels

def brute_removed(texts, length):
    seen = {}
    for t in texts:
        for p in range(len(t) - length + 1):
            seen[t[p:p + length]] = seen.get(t[p:p + length], 0) + 1
    out = []
    for t in texts:
        runs = []
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                if runs and p <= runs[-1][1]:
                    runs[-1][1] = p + length
                else:
                    runs.append([p, p + length])
        kept, at = b"", 0
        for a, z in runs:
            kept, at = kept + t[at:a], z
        kept += t[at:]
        out.append((len(t), sum(z - a for a, z in runs), len(runs), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length,window,batches", [(40, 30, 3), (40, 12, 1), (400, 256, 4)])
def test_removed_bytes_by_definition(rows, length, window, batches):
    r = random.Random(length + window)
    passages = [prose(length // 4, 70 + i) for i in range(4)]
    texts = []
    for i in range(40):
        t = [prose(r.randint(1, length // 2), 500 + i) for _ in range(3)]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, len(p) // 2)
            t.insert(r.randint(0, 3), p[a:a + r.randint(length // 2, len(p))])
        texts.append(" ".join(t))
    texts += [texts[0], texts[1][:-3] + "é!!", "x" * (3 * length), "ab" * length, "", "é" * length, texts[2] + texts[2]]
    data = [(i if i != 7 else None, t) for i, t in enumerate(texts)] + [(999, None), (0, texts[0])]
    d = rows("doc_id long, text string", data)
    got = suf.digests(d, spec=suf.Spec(length, window), batches=batches).collect()
    want = brute_removed([(t or "").encode() for _, t in data], length)
    key = lambda x: tuple(map(str, x))
    assert sorted((tuple(x) for x in got), key=key) == sorted(((i, *w) for (i, _), w in zip(data, want)), key=key)


def test_remove_keeps_rows_and_columns(rows):
    shared = prose(200, 1)
    d = rows("key long, doc_id long, text string, n long, spans string, id long",
             [(1, 1, prose(30, 2) + " é" + shared, 1, "a", None), (2, 2, "ü" + shared + prose(9, 3), 2, None, 5),
              (3, 3, None, None, None, None), (4, None, "short", 1, "", 1), (4, None, "short", 1, "", 1)])
    out = suf.remove(d)
    got = {x.key: x for x in out.collect()}
    assert out.columns == d.columns and out.count() == 5
    assert shared not in got[1].text and got[1].text.startswith(prose(30, 2)[:20]) and got[3].text is None
    assert got[4].text == "short" and suf.remove(d.limit(0)).count() == 0 and suf.digests(d.limit(0)).count() == 0


def test_piece_borders_of_long_texts(rows, monkeypatch):
    """A text longer than a slab is cut into overlapping pieces; the result does not depend on the cut."""
    texts = [prose(900, 1) + prose(300, 2), prose(300, 2) + prose(500, 3), prose(40, 5)]
    d = rows("doc_id long, text string", list(enumerate(texts)))
    whole = sorted(tuple(x) for x in suf.digests(d, spec=suf.Spec(60, 40), batches=2).collect())
    parts = {tuple(p[1:]) for p in [(0,)]}
    monkeypatch.setattr(suf, "SLAB", 512)
    raw = [t.encode() for t in texts]
    spec = suf.Spec(60, 40)
    starts = []
    for some in suf._slabs(raw, spec):
        data, ok, begin, owner, offset = suf._joined(some, spec)
        _, first, last = suf.segments(data, ok, spec)
        for a, z in zip(first.tolist(), last.tolist()):
            w = int(np.searchsorted(begin, a, "right")) - 1
            starts += [(int(owner[w]), p - int(begin[w]) + int(offset[w])) for p in range(a, z + 1)]
    assert sorted(starts) == [(i, p) for i, t in enumerate(raw) for p in range(len(t) - 59)] and parts
    assert sorted((i, *w) for i, w in enumerate(brute_removed(raw, 60))) == whole


def test_index_levels_merge_geometrically(rows):
    index = suf.SuffixIndex()
    sizes = []
    for i in range(5):
        d = suf._keyed(rows("doc_id long, text string", [(i, prose(300, i)), (i + 10, prose(100, 99))]), "doc_id", "text")
        found = index.add(suf.sampled_suffixes(d, suf.Spec(60, 40)))
        sizes.append([n for n, _ in index.levels])
        assert (found.count() > 0) == (i > 0)
    assert sizes == [[1], [1, 1], [2, 1], [2, 1, 1], [4, 1]] or sizes == [[1], [1, 1], [2, 1], [2, 1, 1], [2, 2, 1]]
    assert os.environ is not None
