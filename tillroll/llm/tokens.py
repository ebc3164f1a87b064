"""Token ids of whole texts with a public tokenizer file, fast.

The tokenizer treats stretches between ASCII white space on their own (its
pre-tokenizer splits there), so a worker encodes each distinct stretch once and
a text is the concatenation. ASCII letters are lower-cased beforehand, as the
tokenizer does, so that fewer stretches differ.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

KEPT = 450_000  # stretches that a worker remembers, and as many that it used before those
# without apostrophes, which may begin a contraction, and signs of special tokens
_MARKS = frozenset(b"!\"#$%&()*+,-./:;=?@[]^_`{}~")


class WordTokenizer:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text. New stretches of all of them are learnt together."""
        split = [_lower((t or "").encode()).split() for t in texts]  # of bytes: at ASCII white space
        if len(self.known) > KEPT:
            self.known, self.older = {}, self.known
        new = []
        for s in set().union(*split).difference(self.known):
            if (ids := self.older.get(s)) is None:
                new.append(s)
            else:
                self.known[s] = ids
        self._learn(new)
        ids = self.known.__getitem__
        return [b"".join(map(ids, s)) for s in split]

    def _learn(self, stretches: list[bytes]) -> None:
        tokens = list(map(_pre_tokens, stretches))
        simple = [s for s, n in zip(stretches, tokens, strict=True) if n]
        if simple:
            # each pre-token has one token that ends it, so the ids of all can be cut apart
            whole, = self.tokenizer.encode_batch_fast([b" ".join(simple).decode()], add_special_tokens=False)
            ids = np.array(whole.ids, "<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            last = np.cumsum([n for n in tokens if n]) - 1
            if len(ends) == last[-1] + 1:
                raw, at = ids.tobytes(), 0
                for s, end in zip(simple, (4 * ends[last]).tolist(), strict=True):
                    self.known[s] = raw[at:end]
                    at = end
        rest = [s for s in stretches if s not in self.known]
        slow = self.tokenizer.encode_batch_fast([s.decode() for s in rest], add_special_tokens=False)
        for s, e in zip(rest, slow, strict=True):
            self.known[s] = np.array(e.ids, "<u4").tobytes()


def _pre_tokens(s: bytes) -> int:
    """1 for letters alone, 2 for letters and a mark behind them, 0 for anything else."""
    if s.isalpha():
        return 1
    mark = s[-1] in _MARKS
    word = s[:-1] if mark else s
    return 1 + mark if word.isalpha() or word.decode().isalpha() else 0


def _lower(data: bytes) -> bytes:
    """ASCII letters in lower case, unless a combining mark (U+0300 to U+036F) may
    join one of them or a special token's string may come about."""
    return data if b"\xcc" in data or b"\xcd" in data or b"<|" in data else data.lower()


@cache
def tokenizer(name: str = "word_bpe_49k.json") -> WordTokenizer:
    return WordTokenizer(public_tokenizers.path(name))
