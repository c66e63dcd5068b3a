"""Token ids of whole texts, with repeated words encoded once per worker."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

CHUNK = 512

# Characters for which the plain rules below say the same as the tokenizer's normaliser
# and splitter: ASCII and Latin-1 without control characters.
_OTHER = re.compile(r"[^\t\n\r\x0b\x0c\x20-\x7e\xa0-\xff]")
_LETTERS, _DIGITS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
_PIECE = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^\\s{_LETTERS}{_DIGITS}]+"
)


class Encoder:
    """Ids as ``tokenizers`` gives them, as little-endian unsigned 16-bit numbers.

    For a vocabulary with word ends, a text's ids are the ids of its words one after the
    other. Words between white space are looked up; the library encodes those that are
    new, many at a time, and word-end ids tell where each one's ids end. Texts with
    characters outside Latin-1 or with a special token's string go to the library whole;
    with ``plain`` that string is ordinary text and gives other ids. The table of words is emptied when it has ``limit`` entries.
    """

    def __init__(self, path: str, plain: bool = False, limit: int = 1 << 19) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain
        self.limit = limit
        self.words: dict[str, bytes] = {}
        vocabulary = self.library.get_vocab()
        if max(vocabulary.values()) >= 1 << 16:
            raise ValueError("this vocabulary needs wider ids")
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.word_end = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.word_end[number] = token.endswith("</w>")

    def _whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u2").tobytes()

    def _pieces(self, pieces: list[str]) -> dict[str, bytes]:
        found = {}
        for i in range(0, len(pieces), CHUNK):
            part = pieces[i : i + CHUNK]
            ids = np.array(
                self.library.encode(" ".join(part), add_special_tokens=False).ids, "<u2"
            )
            ends = (2 * (np.flatnonzero(self.word_end[ids]) + 1)).tolist()
            if len(ends) != len(part):  # not a vocabulary with word ends
                found.update((p, self._whole(p)) for p in part)
                continue
            raw, start = ids.tobytes(), 0
            for piece, end in zip(part, ends):
                found[piece] = raw[start:end]
                start = end
        return found

    def _learn(self, new: list[str]) -> None:
        split = [_PIECE.findall(word) for word in new]
        ids = self._pieces(list(set().union(*split)))
        for word, pieces in zip(new, split):
            self.words[word] = b"".join([ids[p] for p in pieces])

    def encode(self, text: str | None) -> bytes:
        """The ids of one text; NULL counts as empty."""
        if not text:
            return b""
        if _OTHER.search(text) or any(s in text for s in self.special):
            return self._whole(text)
        words = text.lower().split()
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            new = list(set(words).difference(self.words))
        if len(new) > self.limit // 2:  # more new words than the table should hold
            return self._whole(text)
        if len(self.words) + len(new) > self.limit:
            self.words.clear()
            new = list(set(words))
        self._learn(new)
        return b"".join(map(self.words.__getitem__, words))


@lru_cache(maxsize=2)
def encoder(path: str, plain: bool = False) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(path, plain)


def encoded(
    batches: Iterator, path: str, text: str = "text", plain: bool = False
) -> Iterator[tuple[object, list[bytes]]]:
    """Each Arrow batch with the ids of its texts."""
    one = encoder(path, plain)
    for batch in batches:
        yield batch, [one.encode(t) for t in batch.column(text).to_pylist()]
