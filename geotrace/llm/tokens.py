"""Token ids of whole texts by a public tokenizer file, with a word cache in each Python worker."""

from __future__ import annotations

import json
import os
import re

import numpy as np

CACHED = 400_000  # entries of each cache of a worker (some 100 MB); a full cache starts anew
_LOADED: dict[str, Encoder] = {}
_PARTS = re.compile(r"([a-zA-ZÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


class Encoder:
    """Ids of texts as little-endian unsigned integers of ``width`` bytes.

    A tokenizer that marks word ends and drops white space gives each word the same ids wherever it
    stands, so words (cut at single spaces and line feeds only) are looked up. Of a word made of Latin
    letters and trailing marks, the two parts are looked up apart. Other tokenizers get whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.width, self.type = (2, np.dtype("<u2")) if size <= 1 << 16 else (4, np.dtype("<u4"))
        mark = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        ids = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        self.by_word = bool(mark) and ids("Ab!? cé;") == ids("ab") + ids("!?") + ids("cé") + ids(";")
        if self.by_word:
            self.ends = np.zeros(size, bool)
            self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(mark)]] = True
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}

    def _bytes(self, ids) -> bytes:
        return np.asarray(ids, self.type).tobytes()

    def _each(self, texts: list[str]) -> list[bytes]:
        return [self._bytes(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_parts(self, new: list[str]) -> None:
        """Ids of many one-word parts at once: joined by spaces, cut again at the word ends."""
        for at in range(0, len(new), 256):
            some = new[at : at + 256]
            joined = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids
            cuts = (np.flatnonzero(self.ends[joined]) + 1).tolist()
            if len(cuts) == len(some):
                raw, begin = self._bytes(joined), 0
                for part, end in zip(some, cuts, strict=True):
                    self.parts[part] = raw[begin * self.width : end * self.width]
                    begin = end
            else:
                self.parts.update(zip(some, self._each(some), strict=True))

    def _learn(self, new: set[str]) -> None:
        if len(self.parts) > CACHED:
            self.parts = {"": b""}
        split, odd = {}, []
        for word in new:
            found = _PARTS.fullmatch(word)
            if found:
                split[word] = (found[1].lower(), found[2])
            else:
                odd.append(word)
        self._learn_parts([p for p in {p for pair in split.values() for p in pair} if p not in self.parts])
        for word, (letters, marks) in split.items():
            self.words[word] = self.parts[letters] + self.parts[marks]
        self.words.update(zip(odd, self._each(odd), strict=True))

    def encode(self, text: str) -> bytes:
        if not self.by_word:
            return self._each([text])[0]
        out = []
        for at in range(0, len(words := text.replace("\n", " ").split(" ")), 1 << 16):
            some = words[at : at + (1 << 16)]
            if len(self.words) > CACHED:
                self.words = {}
            new = set(some).difference(self.words)
            if new:
                self._learn(new)
            known = self.words
            out.append(b"".join([known[w] for w in some]))
        return b"".join(out)


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file, loaded once."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]
