import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dealflow.llm.bpe_monoid import monoid
from dealflow.llm.token_cache import TokenCache, letters, token_cache

RANKS = P.path("byte_bpe_50k.tiktoken")
BPE = monoid(RANKS, P.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=BPE.ranks, special_tokens={})
TEXTS = st.one_of(
    st.text(max_size=200),
    st.text(alphabet="ab \n\t  \x1c\x85'́sé9漢", max_size=80),
    st.lists(st.sampled_from(["the", " the", "ing", "tion", "'s", "  ", "\n", " \n", "aaaa", "é", "<|endoftext|>", " TARİHİ", " कड़", ",", "."]),
             max_size=60).map("".join))


OWN = {name: Tokenizer.from_file(P.path(name)) for name in ("byte_bpe_50k.json", "word_bpe_49k.json")}


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_same_ids_as_the_library(text):
    ids = LIBRARY.encode_ordinary(text)
    assert BPE.encode(text) == ids
    joined, raw = BPE.round_trip(text)
    assert joined == " ".join(map(str, ids)).encode() and raw == text.encode()


@pytest.mark.parametrize("piece", ["a" * 5000, "ab" * 3000, "antidisestablishmentarianism" * 300, "é" * 4000,
                                   "=" * 7777, "the" * 2500, "xyzzy" * 2000])
def test_long_pieces_join_to_the_same_ids(piece):
    assert BPE.encode(piece) == LIBRARY.encode_ordinary(piece)
    assert BPE.decode(BPE.encode(piece)) == piece.encode()


@settings(max_examples=300, deadline=None)
@given(TEXTS)
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_chunks_give_the_tokenizers_ids(name, text):
    ids = np.frombuffer(next(token_cache(P.path(name)).encode_all([text])), "<u4").tolist()
    assert ids == OWN[name].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_that_normalise_to_marks_before_a_stop(name):
    odd = [c for c in map(chr, [*range(0xD800), *range(0xE000, 0x20000)]) if c.isalpha() and not letters(c)]
    texts = ["x TARİHİ, कड़, ड़. İ,", "x ab*** ab##.\nab?! ab-s ab's ab.'s. ab_ ab1, ab| ab<| ab|> ab(\u0301) ab.\u0301", *(f"x a{c}, {c}. \n{c},a b{c}." for c in odd)]
    assert len(odd) > 20 and [np.frombuffer(x, "<u4").tolist() for x in token_cache(P.path(name)).encode_all(texts)] == [
        OWN[name].encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("limit", [0, 3, 50])
def test_a_full_cache_changes_nothing(limit):
    cache = TokenCache(P.path("byte_bpe_50k.json"), limit)
    texts = ["one two, three. four\nfive six.", "one two, seven. two. two", None, "", "odd  spaces \n here", "five six. eight"]
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in cache.encode_all(texts)]
        assert got == [OWN["byte_bpe_50k.json"].encode(t or "", add_special_tokens=False).ids for t in texts]
        assert len(cache.known) <= max(limit, 0)
