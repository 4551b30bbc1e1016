"""Token ids of whole texts by a public vocabulary, with each distinct word tokenized once per worker.

The byte-level vocabulary splits a text before a blank that something solid follows, so a text's ids are its
words' ids in order. Words come from a cache of bounded size; a missing word goes to the BPE itself. The ids are
those of the ``tokenizers`` file (tests compare them); the rank file of the same vocabulary is what encodes, as
it takes a quarter of the time.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

import numpy as np

CACHE = 400_000
#: The vocabulary's one added token.
MARK, MARK_ID = "<|endoftext|>", 50256
_SPLIT = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?=\s)| \Z")


@dataclass(frozen=True)
class Vocabulary:
    """ranks: path of the rank file on every machine, or None for the installed one. special: whether the end mark's
    text is the one id of that mark, as in the ``tokenizers`` file by default, or letters like any others."""

    ranks: str | None = None
    cache: int = CACHE
    special: bool = False

    def encoder(self) -> Encoder:
        key = (self.ranks, self.cache, self.special)
        if key not in _encoders:
            _encoders[key] = Encoder(self)
        return _encoders[key]


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        import base64

        import tiktoken
        from public_tokenizers import PATTERN, path

        with open(vocabulary.ranks or path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bpe = tiktoken.Encoding(os.path.basename(vocabulary.ranks or "byte_bpe_50k"), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.top = max(ranks.values())
        self.most, self.first, self.later, self.special = vocabulary.cache, {}, {}, vocabulary.special

    def _pack(self, text: str) -> bytes:
        return np.array(self.bpe.encode_ordinary(text), "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if self.special and MARK in text:
            return np.array([MARK_ID], "<u4").tobytes().join(self.ids(x) for x in text.split(MARK))
        words = text.split(" ") if _ODD.search(text) is None else _SPLIT.split(text)
        known = self.later
        if len(known) > self.most:
            known.clear()
        out = []
        head = words[0]
        got = self.first.get(head)
        if got is None:
            if len(self.first) > self.most // 8:
                self.first.clear()
            got = self._pack(head)
            if len(head) < 64:
                self.first[head] = got
        out.append(got)
        add, find = out.append, known.get
        for w in words[1:]:
            got = find(w)
            if got is None:
                got = self._pack(" " + w)
                if len(w) < 64:
                    known[w] = got
            add(got)
        return b"".join(out)


_encoders: dict = {}
