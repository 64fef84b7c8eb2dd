"""Token ids of many texts with a given tokenizer file; words seen before are looked up."""

from __future__ import annotations

import os
import string
import sys
import types
import unicodedata

import numpy as np

#: About 200 MB of a worker.
CACHED_WORDS = 1_200_000
CHUNK_WORDS = 500
#: White space for Python but not for the tokenizers; texts with it are encoded as a whole.
_ODD_SPACE = "\x1c\x1d\x1e\x1f"
_SIGNS = frozenset(",.;:!?")


class WordTable(dict):
    """Words and their ids. A word that is not there gets an empty place, to be filled when all of its kind are encoded."""

    new: dict[str, bytearray]

    def __missing__(self, word: str) -> bytearray:
        place = self[word] = self.new[word] = bytearray()
        return place


class Letters(dict):
    """How a tokenizer writes each letter for its model; of words of letters this is the piece that the model gets."""

    def __init__(self, tokenizer):
        super().__init__()
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        trial = string.ascii_lowercase + "éßжн漢"
        #: whether the tokenizer leaves words of letters whole and writes letters one by one
        self.usable = self.splitter is not None and [self.spelt(trial, True)] == [p for p, _ in self._pieces(trial)]

    def _pieces(self, text: str) -> list:
        return self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text) if self.normalizer else text)

    def __missing__(self, letter: str) -> str | None:
        pieces = self._pieces(letter) if letter.isalpha() else []
        self[letter] = found = pieces[0][0] if len(pieces) == 1 else None
        return found

    def spelt(self, word: str, trial: bool = False) -> str | None:
        """The model's piece for a word of letters; None if it has to go through the whole tokenizer."""
        if not (word.isalpha() and (trial or self.usable)):
            return None
        try:
            return "".join(map(self.__getitem__, word))
        except TypeError:
            return None


class WordEncoder:
    """Encodes texts to little-endian 32-bit ids, for tokenizers that drop white space and ignore case.

    It must also be one that never joins letters and a sign in one token. Words of letters go to its model
    directly, letter by letter as the tokenizer writes them, if it would not cut them. For such a tokenizer the ids of a text are those of its words in a row, so words are
    encoded once and kept in a table, which loses its older half when it holds more than
    ``cached``; one call adds at most the words of its texts. Texts for which that could fail are encoded whole: texts not in NFC, with a
    capital sigma (its lower case depends on its place), with odd white space, or with the
    beginning of a special token (which only counts as written).
    """

    def __init__(self, path: str, special: bool = True, cached: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.cached = cached
        self.known = WordTable()
        self.cells = [n.to_bytes(4, "little") for n in range(self.tokenizer.get_vocab_size())]
        self.model = self.tokenizer.model
        self.letters = Letters(self.tokenizer)
        self.signs = {sign: self._whole(sign) for sign in _SIGNS}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, new: dict[str, bytearray]) -> None:
        """Fills the places of new words; letters and one sign at their end are put together from two entries."""
        known, plain, ended, rest = self.known, set(), [], []
        for word in new:
            if word[-1] in _SIGNS and (stem := word[:-1]).isalpha():
                ended.append((word, stem, word[-1]))
                if stem not in known:
                    plain.add(stem)
            else:
                plain.add(word)
        cells, tokenize, spelt = self.cells, self.model.tokenize, self.letters.spelt
        for word in plain:
            if (piece := spelt(word)) is None:
                rest.append(word)
            else:
                known[word] = b"".join([cells[token.id] for token in tokenize(piece)])
        for first in range(0, len(rest), CHUNK_WORDS):
            part = rest[first:first + CHUNK_WORDS]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            begins = np.cumsum([0, *(len(w) + 1 for w in part)])
            cuts = np.searchsorted([a for a, _ in found.offsets], begins).tolist()
            ids = np.array(found.ids, "<u4").tobytes()
            known.update((w, ids[4 * a:4 * b]) for w, a, b in zip(part, cuts, cuts[1:]))
        for word, stem, sign in ended:
            known[word] = known[stem] + self.signs[sign]
        for word, place in new.items():
            place[:] = known[word]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.cached:
            for word in list(self.known)[:len(self.known) // 2]:
                del self.known[word]
        new = self.known.new = {}
        look_up = self.known.__getitem__
        rows: list[list[bytes | bytearray] | None] = []
        for text in texts:
            plain = text.isascii() or ("Σ" not in text and unicodedata.is_normalized("NFC", text))
            plain = plain and "<|" not in text and not any(c in text for c in _ODD_SPACE)
            rows.append(list(map(look_up, text.lower().split())) if plain else None)
        if new:
            self._learn(new)
        return [self._whole(text) if row is None else b"".join(row) for text, row in zip(texts, rows)]


def shared_encoder(path: str, special: bool = True) -> WordEncoder:
    """The encoder of this worker process, so that its tasks go on with the words of those before."""
    store = sys.modules.setdefault("_rosterline_encoders", types.ModuleType("_rosterline_encoders"))
    key = f"{path}|{special}"
    if not hasattr(store, key):
        setattr(store, key, WordEncoder(path, special))
    return getattr(store, key)
