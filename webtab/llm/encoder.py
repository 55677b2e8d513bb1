"""Whole texts to token ids with the tokenizers library, through a cache of words.

Both public vocabularies split a text into words before they merge, so a word
always gets the same ids. A worker cuts texts at places where the library's own
splitting always cuts, encodes each word once with the library and joins the
stored ids. Texts in which a cut might be wrong go to the library as a whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np

CACHED_WORDS = 500_000
LONGEST_CACHED = 64
LETTERS = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
WORD_AND_MARKS = re.compile(LETTERS.pattern.join("()") + r"([!-&(-/:-@\[-`{-~]+)")
TWO_SPACES = re.compile(r"\s\s")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies use for each byte: itself if it prints, else the next one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(others)}


class _Words(dict):
    """Ids of words, each as it stands after ``before``, a space or nothing.

    A word with marks after its letters is put together from both: they are never merged. ``marks`` has those.
    """

    def __init__(self, encode, lower: bool, kind: str, before: str = "", marks: _Words | None = None) -> None:
        super().__init__()
        self._encode, self._lower, self._kind, self._before = encode, lower, kind, before
        self._marks = self if marks is None else marks

    def __missing__(self, word: str) -> bytes:
        if len(word) > LONGEST_CACHED:
            return self._look_up(word)
        parts = WORD_AND_MARKS.fullmatch(word)
        if parts:
            ids = self[parts[1]] + self._marks[parts[2]]
        elif self._lower and word.isascii() and word != word.lower():
            ids = self[word.lower()]
        else:
            ids = self._look_up(word)
        if len(self) >= CACHED_WORDS:
            for old in list(islice(self, CACHED_WORDS // 2)):
                del self[old]
        self[word] = ids
        return ids

    def _look_up(self, word: str) -> bytes:
        return np.asarray(self._encode(self._before + word), self._kind).tobytes()


class Encoder:
    """``ids(text)`` gives the token ids of a whole text, little-endian, ``width`` bytes each (4, or 2 for vocabularies that fit)."""

    def __init__(self, path: str, width: int = 4) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self._encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        with open(path, encoding="utf-8") as f:
            setup = json.load(f)
        kind = (setup.get("pre_tokenizer") or {}).get("type")
        plain = setup.get("normalizer") is None
        lower = any(n.get("type") == "Lowercase" for n in (setup.get("normalizer") or {}).get("normalizers", []))
        model, letter = tokenizer.model, byte_letters()

        def of_word(word: str) -> list[int]:
            """A run of Latin letters is one word for the library's splitting, so it goes to its model directly."""
            if not LETTERS.fullmatch(word):
                return self._encode(word)
            mapped = "".join(map(letter.__getitem__, (word.strip().lower() if lower else word).encode()))
            return [t.id for t in model.tokenize(mapped)]

        self._kind = f"<u{width}"
        self._words = _Words(of_word, lower, self._kind)
        # a space belongs to the word after it; such words are looked up by the bare word
        self._spaced = _Words(of_word, lower, self._kind, " ", self._words)
        self._pieces = self._byte_words if kind == "ByteLevel" and plain else self._plain_words if _drops_space(setup) else None

    def ids(self, text: str) -> bytes:
        found = self._pieces(text) if self._pieces else None
        return np.asarray(self._encode(text), self._kind).tobytes() if found is None else found

    def _byte_words(self, text: str) -> bytes | None:
        """Cuts before single spaces and around single line ends.

        None if white space follows white space: such runs are split by rules of their own.
        """
        if TWO_SPACES.search(text):
            return None
        out: list[bytes] = []
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append(self._words["\n"])
            words = line.split(" ")
            if words[0]:
                out.append(self._words[words[0]])
            del words[0]
            out.extend(map(self._spaced.__getitem__, words))
        return b"".join(out)

    def _plain_words(self, text: str) -> bytes:
        """Cuts at spaces and line ends, for vocabularies that drop white space."""
        return b"".join(map(self._words.__getitem__, text.replace("\n", " ").split(" ")))


def _drops_space(setup: dict) -> bool:
    first = ((setup.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    return first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True


def encoder(path: str, width: int = 4) -> Encoder:
    """The worker's encoder for a vocabulary file, which every worker must be able to read at ``path``.

    It is kept beside the library's module, which outlives a task (this module's code comes with each task).
    """
    import tokenizers
    kept = tokenizers.__dict__.setdefault("_kept_encoders", {})
    if (path, width) not in kept:
        kept[path, width] = Encoder(path, width)
    return kept[path, width]


def texts_of(column) -> Iterator[str]:
    """The texts of an Arrow column, null as empty."""
    for value in column:
        yield value.as_py() or ""
