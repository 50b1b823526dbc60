"""Token ids by the tokenizers library, with a word cache around it.

Ids of a whole text equal those of ``Tokenizer.encode(text, add_special_tokens=False)``. The tokenizer drops white space and
never merges across it, so a text is cut at white space and each distinct word is encoded once per Python worker. A word
of letters alone is one unit of the tokenizer, so many new ones go through a single call and are told apart by the
word-end mark of their last token; anything else is encoded on its own. Texts with rarer separators go through whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

#: Separators on which Python and the tokenizer might disagree.
_RARE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    ⁠　﻿]")
_TAIL = re.compile(r"^(.*?)([.,!?:;]+)$", re.DOTALL)
#: The cache is emptied beyond this many words, so its memory is bounded.
CACHE_WORDS = 1_600_000


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache_words = cache_words
        self.cache: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _letters(self, words: list[str]) -> None:
        ids = np.asarray(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words) or (len(stops) and stops[-1] != len(ids)):
            self.cache.update((word, self.whole(word)) for word in words)
            return
        raw, start = ids.tobytes(), 0
        for word, stop in zip(words, (stops * 4).tolist(), strict=True):
            self.cache[word] = raw[start:stop]
            start = stop

    def _learn(self, words: list[str]) -> None:
        letters, split = set(), []
        for word in words:
            if word.isalpha():
                letters.add(word)
            elif (match := _TAIL.match(word)) and match[1].isalpha():
                split.append((word, match[1], match[2]))
                if match[1] not in self.cache:
                    letters.add(match[1])
                if match[2] not in self.cache:
                    self.cache[match[2]] = self.whole(match[2])
            else:
                self.cache[word] = self.whole(word)
        if letters:
            self._letters(list(letters))
        cache = self.cache
        for word, core, tail in split:
            cache[word] = cache[core] + cache[tail]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _RARE.search(text):
            return self.whole(text)
        words = text.split()
        cache = self.cache
        new = set(words).difference(cache) if len(words) > 64 else {word for word in words if word not in cache}
        if new:
            if len(cache) + len(new) > self.cache_words:
                cache.clear()
                new = set(words)
            self._learn(list(new))
        return b"".join(map(cache.__getitem__, words))


@lru_cache(maxsize=2)
def encoder(path: str, cache_words: int = CACHE_WORDS) -> WordEncoder:
    """One encoder per Python worker; Spark reuses workers, so the cache outlives a task, and a job: an idle worker keeps its memory."""
    return WordEncoder(path, cache_words)
