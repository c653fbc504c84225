"""Numpy helpers for whole texts inside a task: pieces of bounded size, spans and their hashes."""

from __future__ import annotations

import hashlib
import sys
import types

import numpy as np

#: Characters handled at once; bounds the temporary arrays of a task.
PIECE = 1 << 19
_STEP = 0x9E3779B97F4A7C15  # odd, so that its powers can be inverted
_MASK = (1 << 64) - 1


def worker_memo() -> dict:
    """A dictionary that lives as long as this Python worker, whichever task fills it."""
    return sys.modules.setdefault("_temperament_llm_memo", types.ModuleType("_temperament_llm_memo")).__dict__


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on every other."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    memo = worker_memo()
    if "powers" not in memo or len(memo["powers"][0]) < count:
        size = max(count, PIECE + 4096)
        steps = np.full(size, _STEP, np.uint64)
        back = np.full(size, pow(_STEP, -1, 1 << 64), np.uint64)
        steps[0] = back[0] = 1
        memo["powers"] = (np.multiply.accumulate(steps), np.multiply.accumulate(back))
    forth, back = memo["powers"]
    return forth[:count], back[:count]


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span of symbols, equal for equal spans wherever they stand."""
    forth, back = _powers(len(symbols) + 1)
    sums = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(mixed(symbols.astype(np.uint64) + np.uint64(1)) * forth[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def text_pieces(text: str, size: int = PIECE):
    """The text in pieces of about that size, cut only before a blank that stands alone between other characters."""
    start = 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while 0 < at < len(text) - 1 and (text[at - 1].isspace() or text[at + 1].isspace()):
            at = text.find(" ", at + 1)
        if not 0 < at < len(text) - 1:
            break
        yield text[start:at]
        start = at
    yield text[start:]


def grouped_pieces(texts: list[str], size: int = PIECE):
    """Lists of (index of the text, piece) with about that many characters together."""
    held, total = [], 0
    for index, text in enumerate(texts):
        for piece in text_pieces(text, size):
            if held and total + len(piece) > size:
                yield held
                held, total = [], 0
            held.append((index, piece))
            total += len(piece)
    if held:
        yield held


_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """For every text the hashes of its words in order: runs without ASCII blanks, A-Z in lower case."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for held in grouped_pieces(texts):
        parts = [piece.encode("utf-8", "surrogatepass") for _, piece in held]
        raw = _LOWER[np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)]
        blank = _BLANK[raw]
        edges = np.flatnonzero(np.diff(np.concatenate(([True], blank)).view(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        hashes = span_hashes(raw, starts, ends)
        stops = np.searchsorted(starts, np.cumsum([len(p) + 1 for p in parts]))
        for (index, _), words in zip(held, np.split(hashes, stops[:-1])):
            if len(words):
                found[index].append(words)
    return [np.concatenate(x) if len(x) > 1 else x[0] if x else np.zeros(0, np.uint64) for x in found]


def shingle_set(words: np.ndarray, width: int = 5) -> np.ndarray:
    """The sorted distinct hashes of all runs of `width` words; a shorter text is one run; no word, no run."""
    count = len(words)
    if count == 0:
        return words
    span = min(width, count)
    total = np.full(count - span + 1, span, np.uint64)
    for offset in range(span):
        total = total * np.uint64(_STEP) + words[offset : count - span + 1 + offset]
        total ^= total >> np.uint64(29)
    return np.unique(mixed(total))


def set_digest(values: np.ndarray) -> bytes | None:
    """Sixteen bytes that stand for the whole set; nothing for the empty set."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None
