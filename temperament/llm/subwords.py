"""Byte-level pre-tokens of whole texts, and a bounded memory of the ids of words already met."""

from __future__ import annotations

import hashlib

import numpy as np
import regex

from temperament.llm.arrays import grouped_pieces, span_hashes, worker_memo

OTHER, LETTER, NUMBER, SPACE = range(4)
#: Words remembered per worker before the memory is emptied.
REMEMBERED = 1_000_000
# fixed values: the endings that the pre-tokenizer keeps with their apostrophe
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def character_classes() -> np.ndarray:
    """The class of every code point, from its Unicode properties."""
    memo = worker_memo()
    if "classes" not in memo:
        every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x110000))
        table = np.zeros(0x110000, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
            for found in regex.finditer(pattern, every):
                table[found.start() : found.end()] = kind
        memo["classes"] = table
    return memo["classes"]


def token_starts(codes: np.ndarray, piece_starts: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of several pieces begin, which stand one after the other in `codes`."""
    kinds = character_classes()[codes]
    is_start = np.empty(len(codes), bool)
    is_start[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=is_start[1:])
    is_start[piece_starts] = True
    runs = np.flatnonzero(is_start)
    ends = np.append(runs[1:], len(codes))
    run_kind = kinds[runs]
    goes_on = np.ones(len(runs), bool)  # another run of the same piece follows
    goes_on[np.searchsorted(runs, piece_starts[1:]) - 1] = False
    goes_on[-1] = False

    # of blanks before other characters the last one stands apart, a space with what follows it
    blanks = np.flatnonzero((run_kind == SPACE) & goes_on)
    last = ends[blanks] - 1
    is_start[last] = True
    attached = blanks[codes[last] == 32]
    is_start[ends[attached]] = False
    free = np.ones(len(runs), bool)
    free[attached + 1] = False

    quotes = (run_kind == OTHER) & goes_on & free & (ends - runs == 1) & (codes[runs] == ord("'"))
    quotes = np.flatnonzero(quotes)
    quotes = quotes[run_kind[quotes + 1] == LETTER]
    for at in quotes:
        start, stop = int(runs[at + 1]), int(ends[at + 1])
        word = "".join(map(chr, codes[start : min(stop, start + 2)]))
        for ending in ENDINGS:
            if word.startswith(ending):
                is_start[start] = False
                if start + len(ending) < stop:
                    is_start[start + len(ending)] = True
                break
    return np.flatnonzero(is_start)


class WordMemory:
    """Ids of words by the hash of their characters; emptied when full, so its size is bounded.

    The hashes stand in a table at most half full, a word at the first free place from its own one on.
    """

    def __init__(self):
        self.clear()

    def clear(self):
        self.table = np.zeros(1 << 16, np.uint64)  # 0 is a free place
        self.number = np.zeros(1 << 16, np.int32)
        self.count = 0
        self.begins = np.zeros(1024, np.int64)  # of the words and, last, of the next one
        self.flat = np.zeros(4096, np.int32)

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash stands or would stand, and whether it does."""
        last = len(self.table) - 1
        at = (hashes & np.uint64(last)).astype(np.int64)
        there = self.table[at]
        open_ = np.flatnonzero((there != hashes) & (there != 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & last
            there[open_] = self.table[at[open_]]
            open_ = open_[(there[open_] != hashes[open_]) & (there[open_] != 0)]
        return at, there == hashes

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of the words, -1 for those not remembered. No hash is 0."""
        at, known = self._places(hashes)
        return np.where(known, self.number[at], -1)

    def add(self, hashes: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> None:
        """Remember words by distinct new hashes, numbered as they come."""
        first, count = self.count, len(hashes)
        while first + count >= len(self.begins):
            self.begins = np.resize(self.begins, 2 * len(self.begins))
        used = int(self.begins[first])
        while used + len(flat) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.begins[first + 1 : first + count + 1] = used + np.cumsum(sizes)
        self.flat[used : used + len(flat)] = flat
        self.count += count
        numbers = np.arange(first, self.count, dtype=np.int32)
        if 2 * self.count > len(self.table):
            taken = self.table != 0
            hashes, numbers = np.append(self.table[taken], hashes), np.append(self.number[taken], numbers)
            size = 1 << (2 * self.count - 1).bit_length()
            self.table, self.number = np.zeros(size, np.uint64), np.zeros(size, np.int32)
        while len(hashes):  # of those that want one free place, one gets it
            at, _ = self._places(hashes)
            self.table[at] = hashes
            got = self.table[at] == hashes
            self.number[at[got]] = numbers[got]
            hashes, numbers = hashes[~got], numbers[~got]

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words one after the other, and how many each has."""
        begins = self.begins[numbers]
        sizes = self.begins[numbers + 1] - begins
        before = np.cumsum(sizes) - sizes
        return self.flat[np.repeat(begins - before, sizes) + np.arange(sizes.sum())], sizes


def word_memory(name: bytes) -> WordMemory:
    """This worker's memory for one encoder, named by what identifies its vocabulary."""
    return worker_memo().setdefault("words-" + hashlib.sha256(name).hexdigest(), WordMemory())


def encode_texts(texts: list[str], encode_words, memory: WordMemory, special: dict[str, int]) -> list[np.ndarray]:
    """The ids of every text. `encode_words` turns pre-tokens into (all ids, number of ids of each)."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    parts: list[tuple[int, str | int]] = []
    for index, text in enumerate(texts):
        parts.extend((index, piece) for piece in _between(text, special))
    plain = [part for _, part in parts if not isinstance(part, int)]
    owners = [at for at, (_, part) in enumerate(parts) if not isinstance(part, int)]
    encoded: list[list[np.ndarray]] = [[] for _ in parts]
    for held in grouped_pieces(plain):
        held = [(index, piece) for index, piece in held if piece]
        if not held:
            continue
        joined = "".join(piece for _, piece in held)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        sizes = np.array([len(piece) for _, piece in held])
        piece_starts = np.cumsum(sizes) - sizes
        starts = token_starts(codes, piece_starts)
        ends = np.append(starts[1:], len(codes))
        hashes = np.maximum(span_hashes(codes, starts, ends), np.uint64(1))
        numbers = memory.numbers(hashes)
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            new, where = np.unique(hashes[missing], return_index=True)
            if memory.count + len(new) > REMEMBERED:
                memory.clear()
                missing = np.arange(len(hashes))
                new, where = np.unique(hashes, return_index=True)
            where = missing[where]
            words = [joined[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())]
            memory.add(new, *encode_words(words))
            numbers[missing] = memory.numbers(hashes[missing])
        ids, counts = memory.ids(numbers)
        stops = np.cumsum(counts)[np.append(np.searchsorted(starts, piece_starts[1:]), len(starts)) - 1]
        for (index, _), part in zip(held, np.split(ids, stops[:-1])):
            encoded[owners[index]].append(part)
    for at, (index, part) in enumerate(parts):
        found[index].extend([np.array([part], np.int32)] if isinstance(part, int) else encoded[at])
    return [np.concatenate(x) if len(x) > 1 else x[0] if x else np.zeros(0, np.int32) for x in found]


def _between(text: str, special: dict[str, int]):
    """The text cut at special tokens, these as their ids."""
    for token, number in special.items():
        if token in text:
            first, *rest = text.split(token)
            yield from _between(first, special)
            for part in rest:
                yield number
                yield from _between(part, special)
            return
    yield text
