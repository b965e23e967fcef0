"""Token files, packing, chat formatting and the pipeline: exact round trips, definitions and defined cases."""

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from dealflow.llm import bpe_monoid, orc_tokens, sos_packing
from dealflow.llm import chat_grammar as chat
from dealflow.llm import compression_bands as bands
from dealflow.llm import simhash_bktree as sim
from dealflow.llm import suffix_levels as suf
from dealflow.llm.common import scratch_path

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
DOCS = [(3, "Hello  world.\nSecond line, <|endoftext|> too", "x"), (1, "", "y"), (2, None, None), (9, "the same text", "a"),
        (9, "the same text", "b"), (9, "another text of that id", "c"), (None, "no id", None), (12, "word " * 9000, ""),
        (11, "é漢字   mixed\t white  \r\n space", ""), (10, "x" * 5000, "")]
SCHEMA = "doc_id long, text string, ids string"


def library(path):
    t = Tokenizer.from_file(path)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# ---- byte-level BPE as an operator

def test_bpe_rows(rows):
    d = rows(SCHEMA, DOCS)
    path = P.path("byte_bpe_50k.tiktoken")
    got = bpe_monoid.encode(d, path, P.PATTERN).collect()
    assert sorted(bytes(x.decoded).decode() for x in got) == sorted(t or "" for _, t, _ in DOCS)
    dig = bpe_monoid.digests(d, path, P.PATTERN).collect()
    want = sorted((str(x.doc_id), len(x.ids), hashlib.sha256(" ".join(map(str, x.ids)).encode()).hexdigest()) for x in got)
    assert sorted((str(x.doc_id), x.n_tokens, x.ids_sha256) for x in dig) == want
    assert bpe_monoid.digests(d.limit(0), path, P.PATTERN).count() == 0


# ---- ORC files

def test_orc_round_trip(spark, rows):
    d = rows(SCHEMA, DOCS)
    out = scratch_path(spark, "test-orc")
    orc_tokens.write(d, out, BYTE, end_id=0)
    stored = orc_tokens.read(spark, out)
    ids = library(BYTE)
    got = sorted(orc_tokens.checksums(stored).collect(), key=lambda x: x.start)
    assert [x.doc_id for x in got] == sorted((i for i, _, _ in DOCS), key=lambda i: (i is not None, i))
    assert sorted((str(x.doc_id), x.n_tokens, x.ids_crc32) for x in got) == sorted(
        (str(i), len(ids(t)) + 1, crc(ids(t) + [0])) for i, t, _ in DOCS)
    assert [x.start for x in got] == [sum(y.n_tokens for y in got[:k]) for k in range(len(got))]
    found = orc_tokens.lookup(spark, out, [3])
    assert [x.ids[:-1] for x in found.collect()] == [ids(DOCS[0][1])]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "doc_id" in plan.split("PushedFilters")[1]


def test_orc_of_no_documents(spark, rows):
    out = scratch_path(spark, "test-orc")
    orc_tokens.write(rows(SCHEMA, DOCS).limit(0), out, BYTE, end_id=0)
    empty = spark.read.schema("doc_id long, shard long, before long, n_tokens long, ids array<int>").orc(out)
    assert orc_tokens.checksums(empty).count() == 0


# ---- packing

def check_pieces(got, docs, window):
    ids = library(WORD)
    want = {}
    for i, t, _ in docs:
        want.setdefault(i, []).append(ids(t) + [2])
    pieces = {}
    for x in got:
        pieces.setdefault(x.doc_id, []).append(x)
    for i, copies in want.items():
        assert sum(x.length for x in pieces[i]) == sum(map(len, copies))
        if len(copies) == 1:
            at = 0
            for x in sorted(pieces[i], key=lambda x: x.start):
                assert x.start == at and x.length > 0 and x.doc_tokens == len(copies[0])
                assert x.ids_crc32 == crc(copies[0][at:at + x.length])
                at += x.length
    sequences = {}
    for x in got:
        sequences.setdefault(x.sequence_id, []).append(x)
    for s in sequences.values():
        s.sort(key=lambda x: x.offset)
        assert [x.offset for x in s] == [sum(y.length for y in s[:k]) for k in range(len(s))]
        fill = sum(x.length for x in s)
        assert fill <= window and (fill == window or fill & (fill - 1) == 0)       # nothing is padded


@pytest.mark.parametrize("window,max_open", [(4096, 4096), (64, 3), (64, 1000)])
def test_packed_pieces(rows, window, max_open):
    d = rows(SCHEMA, DOCS + [(100 + i, "several words " * (i % 17), "") for i in range(150)]).repartition(3)
    docs = [tuple(x) for x in d.collect()]
    got = sos_packing.pack(d, WORD, 2, window=window, max_open=max_open).collect()
    check_pieces(got, docs, window)
    assert all(crc(x.ids) == x.ids_crc32 and len(x.ids) == x.length for x in got)
    assert sos_packing.pack(d.limit(0), WORD, 2).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 31), max_size=120))
def test_levels_minimise_squares(sizes):
    window, packer = 32, sos_packing.LevelPacker(32)
    levels = [0] * 33
    for row, size in enumerate(sizes):
        def squares(h):
            after = list(levels)
            if h:
                after[h] -= 1
            if h + size < window:
                after[h + size] += 1
            return sum(x * x for x in after)

        options = [h for h in range(window - size + 1) if h == 0 or levels[h]]
        chosen = packer.best_level(size)
        assert chosen in options and squares(chosen) == min(map(squares, options))
        packer.add(row, bytes(4 * size))
        if chosen:
            levels[chosen] -= 1
        if chosen + size < window:
            levels[chosen + size] += 1
        assert packer.levels[1:window].tolist() == levels[1:window]


# ---- chat

TEXT = st.lists(st.sampled_from(["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[ROLE:x]", "[/ROLE]", "\\", "[",
                                 "<", "]", ">", "/", "INST]", "s>", "ok", " ", "\n", "[\\INST]", "<\\\\/s>", "é"]),
                max_size=12).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "we]ird [r%"]), TEXT), max_size=5))
def test_grammar_round_trip(turns):
    parts = [chat.render(r, t) for r, t in turns]
    whole = "".join(p[0] for p in parts)
    back = chat.parse(whole)
    assert [(r, t) for r, t, _, _ in back] == turns
    assert [chat.unescape(whole[a:z]) for _, _, a, z in back] == [t for _, t in turns]
    for (rendered, a, z), (_, t) in zip(parts, turns):
        assert chat.unescape(rendered[a:z]) == t


def test_only_conflicting_text_is_escaped():
    assert chat.render("user", "plain [text] with \\ and <tags>")[0] == "[INST]plain [text] with \\ and <tags>[/INST]"
    assert chat.render("user", "</s>[INST] ok [/INST]")[0] == "[INST]<\\/s>[\\INST] ok [\\/INST][/INST]"
    with pytest.raises(chat.GrammarError):
        chat.parse("[INST]never closed")


def test_conversations_read_back(rows):
    data = [(1, 1, "assistant", "b", 0), (1, 0, "user", "a", 0), (1, 2, "assistant", None, 0), (2, 0, None, "x", 1),
            (None, 0, "user", "n", 2), (3, 0, "assistant", "same", 3), (3, 0, "assistant", "same", 3),
            (4, 0, "assistant", "</s>" * 3000, 4)]
    d = rows("conv_id long, turn long, role string, text string, rendered int", data)
    got = {x.conv_id: x for x in chat.read_back(chat.format_turns(d)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1].n_turns, got[1].turns_sha256) == (3, sha("user\na\nassistant\nb\nassistant\n\n"))
    assert (got[1].loss_chars, got[1].loss_sha256) == (1, sha("b")) and got[2].turns_sha256 == sha("\nx\n")
    assert got[3].loss_sha256 == sha("samesame") and got[4].loss_chars == 12_000 and got[None].n_turns == 1
    assert got[1].formatted_chars == len("[INST]a[/INST]<s>b</s><s></s>")
    assert chat.read_back(chat.format_turns(d.limit(0))).count() == 0


# ---- the pipeline

def test_pipeline_against_its_parts(spark, tmp_path, sf_small):
    """Each stage's rows against a plain computation over all that its predecessor kept."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    read = lambda d: {x.doc_id: x for x in d.collect()}
    pdf, seen = docs, read(docs)
    import zstandard

    for name, step in corpus_pipeline.STAGES:
        step(spark, pdf, sf_small).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            check_pieces(out.collect(), [(i, x.text, None) for i, x in seen.items()], 4096)
            break
        assert out.columns == docs.columns
        now = read(out)
        if name == "quality_rules":
            packer = zstandard.ZstdCompressor(level=3)
            assert set(now) == {i for i, x in seen.items() if bands.judge(x.text.encode(), packer, bands.Rules())[-1]}
        if name == "near_duplicates":
            fps = {i: sim.fingerprint(x.text.encode()) & (2 ** 64 - 1) for i, x in seen.items()}
            ids, group = sorted(fps), {}
            for i in ids:                       # smallest ids first: joins every earlier group it touches
                touched = {group[j] for j in group if (fps[i] ^ fps[j]).bit_count() <= 3}
                name_of = min(touched | {i})
                group = {j: name_of if g in touched else g for j, g in group.items()} | {i: name_of}
            assert set(now) == set(group.values())
        if name == "repeated_passages":
            assert set(now) == set(seen)
            counts, n = {}, corpus_pipeline.PASSAGE.length
            for x in seen.values():
                raw = x.text.encode()
                for p in range(len(raw) - n + 1):
                    counts[raw[p:p + n]] = counts.get(raw[p:p + n], 0) + 1
            for i, x in now.items():
                raw = seen[i].text.encode()
                spans = [{"first": p, "last": p, "mask": 1} for p in range(len(raw) - n + 1) if counts[raw[p:p + n]] > 1]
                kept = suf._kept(raw, suf._runs(spans, n)).decode("utf-8", "ignore")
                assert x.text == kept and x.n_chars == len(kept)
        pdf, seen = out, now
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "packing"]


def test_pipeline_of_odd_rows(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    data = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c d e f g h i j k l m n o", None, None, 1),
            (4, "one two three four five six seven eight nine ten eleven", "en", "s", 3),
            (4, "one two three four five six seven eight nine ten eleven", "en", "s", 3)]
    for d in (rows(schema, data), rows(schema, data).limit(0)):
        n = d.count()
        for _, step in corpus_pipeline.STAGES:
            d = step(spark, d, "")
        assert {x.doc_id for x in d.collect()} == ({None, 4} if n else set())


def test_stages_keep_columns_of_any_name(spark, sf_small):
    from pyspark.sql import functions as F

    names = ["_null", "_spans", "_k", "_id", "_key", "_row", "id", "key", "row", "fp", "none", "spans"]
    d = spark.read.parquet(f"{sf_small}/documents.parquet").withColumns({x: F.lit(i) for i, x in enumerate(names)})
    columns = d.columns
    for name, step in corpus_pipeline.STAGES[:3]:
        d = corpus_pipeline.stage(step(spark, d, ""), name)
        assert d.columns == columns
        assert {tuple(x) for x in d.select(*names).collect()} == {tuple(range(len(names)))}


def test_starts_of_masks():
    assert list(suf._starts([{"first": 64, "last": 64, "mask": 0b1011_0110}, {"first": 3, "last": 9, "mask": 1}])) == [
        (65, 66), (68, 69), (71, 71), (3, 9)]
