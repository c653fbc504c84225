"""Words of whole texts as spans of bytes, a bounded number of bytes at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from temperament.llm.arrays import PIECE, span_hashes

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of UTF-8 that belong to a word: ASCII letters and all other characters than ASCII; with digits, these too.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
LETTERS_AND_DIGITS = LETTERS.copy()
LETTERS_AND_DIGITS[48:58] = True


def _cut(raw: np.ndarray, start: int, size: int, in_word: np.ndarray) -> int:
    """Where the piece from `start` on ends: before a byte that is in no word, or at the end of the text."""
    end = start
    while len(raw) - end > size:
        apart = np.flatnonzero(~in_word[raw[end : end + size]])
        if len(apart) and end + apart[-1] > start:
            return end + int(apart[-1])
        end += size
    return len(raw)


def _pieces(texts: list[bytes | None], size: int, in_word: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for index, text in enumerate(texts):
        raw = np.frombuffer(text or b"", np.uint8)
        start = 0
        while len(raw) - start > size:
            end = _cut(raw, start, size, in_word)
            yield index, raw[start:end]
            start = end
        if start < len(raw):
            yield index, raw[start:]


def words(texts: list[bytes | None], in_word: np.ndarray, size: int = PIECE) -> Iterator[tuple[np.ndarray, ...]]:
    """The words of the texts in order, about `size` bytes at a time.

    Yields the bytes with A-Z in lower case, start and end of each word in them, a 64-bit hash of it, and the number of its text.
    Null and empty texts have no words. Only a single word that is longer than `size` makes more than that.
    """
    held, total = [], 0

    def found() -> tuple[np.ndarray, ...]:
        raw = np.zeros(total + len(held), np.uint8)  # a zero byte after each piece ends its last word
        at, stops = 0, []
        for _, piece in held:
            raw[at : at + len(piece)] = LOWER[piece]
            at += len(piece) + 1
            stops.append(at)
        edges = np.flatnonzero(np.diff(np.concatenate(([False], in_word[raw])).view(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        owners = np.array([index for index, _ in held], np.int64)[np.searchsorted(stops, starts, "right")]
        return raw, starts, ends, span_hashes(raw, starts, ends), owners

    for index, piece in _pieces(texts, size, in_word):
        if held and total + len(piece) > size:
            yield found()
            held, total = [], 0
        held.append((index, piece))
        total += len(piece)
    if held:
        yield found()
