"""Token ids of whole texts, inside tasks.

Both vocabularies cut a text into words before any merge, and never across a single blank or line end between two words. So a
text is cut there, each distinct piece is encoded once by the tokenizers library, and a text's ids are its pieces' ids in a
row. Pieces of Latin letters, with or without one full stop or comma behind, are a word of the vocabulary's own word rule, so
they go to the library's merges directly. The memory of pieces is bounded: it is emptied when it holds `MEMO` of them.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

MEMO = 1_200_000
IDS = np.dtype("<u4")
LATIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")
#: White space other than a single blank or line end between two words.
ODD = re.compile(r"[^\S \n]")
UNEVEN = ("  ", " \n", "\n ", "\n\n")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 for itself, then 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Pieces(dict):
    """Ids of pieces as little-endian unsigned 32-bit integers, encoded when first asked for."""

    def __init__(self, tokenizer, before: str, lower: bool):
        super().__init__({"": b""})
        self.tokenizer, self.model, self.before, self.lower = tokenizer, tokenizer.model, before, lower
        self.letters = _byte_letters()

    def __missing__(self, piece: str) -> bytes:
        if len(self) > MEMO:
            self.clear()
            self[""] = b""
        latin = LATIN.fullmatch(piece)
        if latin:
            word, stop = latin.groups()
            found = self._merged(self.before + (word.lower() if self.lower else word))
            found += self.whole(stop) if stop else b""
        else:
            found = self.whole(self.before + piece)
        self[piece] = found
        return found

    def _merged(self, word: str) -> bytes:
        shown = "".join([self.letters[b] for b in word.encode()])
        return np.array([t.id for t in self.model.tokenize(shown)], dtype=IDS).tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=IDS).tobytes()


class Encoder:
    """Encodes whole texts; `kind` is "word" (white space dropped, lower case) or "byte" (all bytes kept)."""

    def __init__(self, path: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.kind = kind
        self.first = Pieces(tokenizer, "", kind == "word")
        self.rest = self.first if kind == "word" else Pieces(tokenizer, " ", False)
        self.line_end = self.first.whole("\n")

    def encode(self, text: str | None) -> bytes:
        """Ids of one text; null is the empty text."""
        if not text:
            return b""
        if self.kind == "word":
            return b"".join(map(self.rest.__getitem__, text.replace("\n", " ").split(" ")))
        if ODD.search(text) or text[0] in " \n" or text[-1] in " \n" or any(x in text for x in UNEVEN):
            return self.first.whole(text)
        lines = []
        for line in text.split("\n"):
            head, *words = line.split(" ")
            lines.append(self.first[head] + b"".join(map(self.rest.__getitem__, words)))
        return self.line_end.join(lines)


@lru_cache(maxsize=4)
def encoder(path: str, kind: str) -> Encoder:
    return Encoder(path, kind)


def public_path(name: str) -> str:
    """Where a public vocabulary file is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)
