"""Whole texts to token ids with the tokenizers library, each distinct word-like chunk encoded once per worker.

A boundary between a non-space character and a single space or line feed before another non-space one always
separates pre-tokens (a leading space belongs to what follows it), so a text whose white space is all of that kind
is the concatenation of its chunks, each encoded on its own; a text with any other run of white space is encoded
as a whole.  A group of texts is split and its chunks numbered by Arrow, so that Python handles each distinct chunk of
a group once and ids are gathered by number.  Letters and the run of signs after them are different pre-tokens too,
so ``word,`` is composed of ``word`` and ``,`` where the word is still all letters after composition and lower case, as
a vocabulary's normaliser may apply them before it splits (a dotted capital I, say, becomes a letter and a mark, which
joins the comma).  New chunks go to the library many in a call, parted by the token that opens each, or by the end-of-text token.  The library
keeps its plain setting, so a special token's string in a text is that token; a text with one, in any case of its
letters, is encoded as a whole.  The cache only saves time: ids never depend on it, and its size is bounded.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_ENTRIES = 900_000
GROUP_CHARS = 1 << 21
LEARNED = 128                                  # chunks of a call: the library slows down on longer texts
END = "<|endoftext|>"
OPENS = "\u0120\u010a"                          # a space and a line feed as byte-level vocabularies write them
SIGNS = "!\"#$%&()*+,-./:;=?@[]^_{|}~"          # all but the apostrophe, which starts contractions, and < >
MARKS = 10_000                                 # remembered runs of signs


def regular(chunk: str) -> bool:
    """No white space at either end, but for one line feed before other characters."""
    bare = chunk.strip()
    return bool(bare) and (len(bare) == len(chunk) or (len(bare) == len(chunk) - 1 and chunk[0] == "\n"))


def letters(base: str) -> bool:
    """Whether a word is all letters, as it stands and normalised."""
    return base.isalpha() and (base.isascii() or unicodedata.normalize("NFC", base).lower().isalpha())


class TokenCache:
    """Encodes texts to their ids as little-endian 32-bit bytes."""

    def __init__(self, path: str, limit: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = self.tokenizer.token_to_id(END)             # parts the chunks that are learned
        self.special = [x.content.lower() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}                      # chunks that begin a text
        self.marks: dict[str, bytes] = {}                      # signs after a word
        self.opens = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.opens[[i for t, i in self.tokenizer.get_vocab().items() if t[0] in OPENS]] = True
        # a vocabulary that keeps white space begins each chunk, and nothing else, with a space or line feed
        self.keeps_space = self.opens[self._flat(" a\nb")].sum() == 2
        self.limit = limit

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, chunks: list[str]) -> None:
        for a in range(0, len(chunks), LEARNED):
            some = chunks[a:a + LEARNED]
            parts = [c if c[0] == "\n" else " " + c for c in some]
            begin = None
            if self.keeps_space:
                ids = self._flat("".join(parts))
                begin = np.nonzero(self.opens[ids])[0]
                end = np.append(begin[1:], len(ids))
            if begin is None or len(begin) != len(some) or begin[0] != 0:
                ids = self._flat(END.join(parts))
                end = np.append(np.nonzero(ids == self.end)[0], len(ids))
                begin = np.append(0, end[:-1] + 1)
            raw = ids.tobytes()
            for chunk, p, q in zip(some, (4 * begin).tolist(), (4 * end).tolist()):
                self.known[chunk] = raw[p:q]

    def _flat(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _compose(self, new: list[str]) -> None:
        """Learn new regular chunks, signs after a word apart."""
        whole, composed = set(), []
        for c in new:
            base = c.rstrip(SIGNS)
            if len(base) < len(c) and letters(base[1:] if base[:1] == "\n" else base):
                composed.append((c, base, c[len(base):]))
                if base not in self.known:
                    whole.add(base)
            else:
                whole.add(c)
        self._learn(list(whole))
        for c, base, signs in composed:
            marks = self.marks.get(signs)
            if marks is None:
                marks = self._ids(signs)
                if len(self.marks) < MARKS:
                    self.marks[signs] = marks
            self.known[c] = self.known[base] + marks

    def _begin(self, chunk: str) -> bytes:
        ids = self.first.get(chunk)
        if ids is None:
            ids = self._ids(chunk)
            if len(self.first) < self.limit // 16:
                self.first[chunk] = ids
        return ids

    def _group(self, texts: list[str]) -> list[bytes]:
        known, before = self.known, len(self.known)
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n"), " ")
        bounds = split.offsets.to_numpy()
        coded = split.values.dictionary_encode()
        chunks, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().copy()
        firsts = codes[bounds[:-1]].tolist()
        found = list(map(known.get, chunks))
        lacking = [i for i, x in enumerate(found) if x is None]
        new = {chunks[i] for i in lacking}
        odd = {c for c in new if not regular(c)}
        marked = {c for c in new if "<|" in c or "|>" in c}
        odd |= {c for c in marked if any(s in c.lower() for s in self.special)}
        for c in marked - odd:                                 # near the mark that parts the others: each on its own
            known[c] = self._ids(c if c[0] == "\n" else " " + c)
        self._compose(list(new.difference(odd, marked)))
        for i in lacking:
            found[i] = known.get(chunks[i], b"")
        # chunks by code, and one more without ids in the place of each first chunk
        codes[bounds[:-1]] = len(chunks)
        strange = np.array([c in odd for c in chunks] + [False]) if odd else np.zeros(len(chunks) + 1, bool)
        whole = np.add.reduceat(strange[codes], bounds[:-1]) > 0
        ids = pa.array(found + [b""], pa.large_binary()).take(pa.array(codes))
        raw = memoryview(ids.buffers()[2])
        cuts = np.frombuffer(ids.buffers()[1], np.int64)[bounds].tolist()
        out = []
        for i, text in enumerate(texts):
            first = chunks[firsts[i]]
            if whole[i] or bounds[i + 1] - bounds[i] == 1 or first in odd or not regular(first) or first[0] == "\n":
                out.append(self._ids(text))
            else:
                out.append(self._begin(first) + raw[cuts[i]:cuts[i + 1]])
        if len(known) > self.limit:                            # keep those met first: the common ones
            for c in list(islice(known, max(before, self.limit), None)):
                del known[c]
        return out

    def encode_all(self, texts: list[str | None], group_chars: int = GROUP_CHARS) -> Iterator[bytes]:
        """The ids of each text, in order (null: of the empty text); texts are handled in groups of bounded size:
        larger ones take more memory and less time."""
        group, size = [], 0
        for x in texts:
            group.append(x or "")
            size += len(group[-1])
            if size >= group_chars:
                yield from self._group(group)
                group, size = [], 0
        if group:
            yield from self._group(group)


@lru_cache(maxsize=2)
def token_cache(path: str, limit: int = CACHE_ENTRIES) -> TokenCache:
    """The worker's own cache for a tokenizer file, kept between tasks (some 300 bytes an entry)."""
    return TokenCache(path, limit)
