"""Token ids of whole texts by the tokenizers library."""

from __future__ import annotations

import json
import os
import unicodedata
from array import array

import numpy as np

WORDS_KEPT = 600_000  # of a worker, about 130 MB; when full, it starts anew
BLANKS = "\t\n\x0b\x0c\r"
STOPS = (".", ",")
LINE_WORDS = 300


def of_letters(word: str) -> bool:
    """Whether a word stays letters alone when it is normalised and lowered; some letters turn into letter and mark."""
    return word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())


class WordEncoder:
    """Encodes a text as the library does, but each blank-separated word once.

    Valid for tokenizers that split at white space and drop it, whose normalisation doesn't cross it and lowers ASCII letters, and which
    split off punctuation and mark the last token of every word by a suffix.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        suffix = json.loads(self.tokenizer.to_str())["model"]["end_of_word_suffix"]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.is_last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.is_last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.known: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        """Words of ASCII letters, in lower case, are what the model itself merges. Other words of letters are encoded as
        texts of many, cut again after each last token; the rest one by one.
        """
        known, encode = self.known, getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        plain, merge = [], self.tokenizer.model.tokenize
        for word in words:
            if word.isalpha():
                if word.isascii() and word.islower():
                    known[word] = array("I", [t.id for t in merge(word)]).tobytes()
                else:
                    plain.append(word)
        lines = [plain[i:i + LINE_WORDS] for i in range(0, len(plain), LINE_WORDS)]
        for line, found in zip(lines, encode([" ".join(line) for line in lines], add_special_tokens=False), strict=True):
            ids = np.array(found.ids, dtype="<u4")
            ends = (4 * np.flatnonzero(self.is_last[ids]) + 4).tolist()
            if len(ends) == len(line):
                raw = ids.tobytes()
                known.update(zip(line, [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], strict=True))
        rest = [w for w in words if w not in known]
        for word, found in zip(rest, encode(rest, add_special_tokens=False), strict=True):
            known[word] = np.array(found.ids, dtype="<u4").tobytes()

    def _meet(self, missing: set[str]) -> None:
        """Learn words from those they are made of: a full stop or comma after letters is a token of its own."""
        known, fresh, made = self.known, set(), []
        for word in missing:
            stop = word.endswith(STOPS)
            stem = word[:-1] if stop else word
            if stop and not of_letters(stem):
                stem, stop = word, False
            if stem.isascii() and stem.isalpha():
                stem = stem.lower()
            if stem not in known:
                fresh.add(stem)
            if stop or stem != word:
                made.append((word, stem, word[-1] if stop else ""))
        fresh.update(s for s in STOPS if s not in known)
        self._learn(list(fresh))
        for word, stem, stop in made:
            known[word] = known[stem] + known[stop] if stop else known[stem]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Unsigned 32-bit ids of each text."""
        known = self.known
        if len(known) > WORDS_KEPT:
            known.clear()
        split = []
        for text in texts:
            for blank in BLANKS:
                if blank in text:
                    text = text.replace(blank, " ")
            split.append(text.split(" "))
        missing = set().union(*split).difference(known)
        if missing:
            self._meet(missing)
        get = known.__getitem__
        return [np.frombuffer(b"".join(map(get, words)), dtype="<u4") for words in split]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
