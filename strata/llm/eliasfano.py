"""Elias-Fano coded sequences and a two-level n-gram trie over them, kept in a memory-mapped file."""

from __future__ import annotations

import tempfile

import numpy as np


class Levels:
    """Arrays written one behind the other to an unnamed temporary file and read through a memory map.

    The file has no name and vanishes with the object, so a task leaves nothing behind."""

    def __init__(self):
        self.file = tempfile.TemporaryFile()
        self.parts: list[tuple[int, np.dtype, int]] = []
        self.map: np.ndarray | None = None

    def add(self, values: np.ndarray) -> int:
        self.file.seek(0, 2)
        self.file.write(b"\0" * (-self.file.tell() % 8))
        self.parts.append((self.file.tell(), values.dtype, len(values)))
        values.tofile(self.file)
        return len(self.parts) - 1

    def seal(self) -> None:
        self.file.write(b"\0" * 16)
        self.file.flush()
        self.map = np.memmap(self.file, np.uint8, "r")

    def get(self, part: int) -> np.ndarray:
        start, kind, count = self.parts[part]
        return self.map[start : start + count * kind.itemsize].view(kind)


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary."""

    def __init__(self, levels: Levels, values: np.ndarray):
        self.levels, self.count = levels, len(values)
        top = int(values[-1]) if self.count else 0
        self.low_bits = max(0, (top // max(1, self.count)).bit_length() - 1) if self.count else 0
        low = values & np.uint64((1 << self.low_bits) - 1)
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        self.buckets = (top >> self.low_bits) + 1
        places = high + np.arange(self.count)
        unary = np.zeros(self.count + self.buckets, np.uint8)
        unary[places] = 1
        self.low, self.high = levels.add(self._pack(low)), levels.add(np.packbits(unary))
        self._starts: np.ndarray | None = None

    def _pack(self, low: np.ndarray) -> np.ndarray:
        words = np.zeros(len(low) * self.low_bits // 64 + 2, np.uint64)
        if self.low_bits and len(low):
            at = np.arange(len(low), dtype=np.uint64) * np.uint64(self.low_bits)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(words, word, low << shift)
            over = shift + np.uint64(self.low_bits) > 64
            np.bitwise_or.at(words, word[over] + 1, low[over] >> (np.uint64(64) - shift[over]))
        return words

    def starts(self) -> np.ndarray:
        """Index of the first value of every bucket of high bits, from the zeros of the unary part."""
        if self._starts is None:
            bits = np.unpackbits(self.levels.get(self.high), count=self.count + self.buckets)
            zeros = np.flatnonzero(bits == 0)
            self._starts = np.concatenate(([0], zeros - np.arange(len(zeros)))).astype(np.uint32)
        return self._starts

    def at(self, index: np.ndarray) -> np.ndarray:
        """The values at some places: the bucket that holds each place, and its low bits."""
        high = (np.searchsorted(self.starts(), index, "right") - 1).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self.low_at(index)

    def low_at(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), np.uint64)
        words = self.levels.get(self.low)
        at = index.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        found = words[word] >> shift
        over = np.flatnonzero(shift)
        found[over] |= words[word[over] + 1] << (np.uint64(64) - shift[over])
        return found & np.uint64((1 << self.low_bits) - 1)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Index of each wanted value, -1 where it is not in the sequence: the successor within the bucket
        of its high bits is searched by bisection over the low bits."""
        if not self.count:
            return np.full(len(wanted), -1)
        high = (wanted >> np.uint64(self.low_bits)).astype(np.int64)
        inside = (high >= 0) & (high < self.buckets)
        high = np.where(inside, high, 0)
        first, end = self.starts()[high].astype(np.int64), self.starts()[high + 1].astype(np.int64)
        low = wanted & np.uint64((1 << self.low_bits) - 1)
        left, right = first.copy(), end.copy()
        open_ = np.flatnonzero(left < right)
        while len(open_):
            middle = (left[open_] + right[open_]) >> 1
            less = self.low_at(middle) < low[open_]
            left[open_] = np.where(less, middle + 1, left[open_])
            right[open_] = np.where(less, right[open_], middle)
            open_ = open_[left[open_] < right[open_]]
        hit = np.flatnonzero(inside & (left < end))
        found = np.full(len(wanted), -1)
        same = self.low_at(left[hit]) == low[hit]
        found[hit[same]] = left[hit[same]]
        return found


class Quantised:
    """Doubles as 16-bit steps between the least and the greatest."""

    def __init__(self, levels: Levels, values: np.ndarray):
        self.levels = levels
        self.least = float(values.min()) if len(values) else 0.0
        self.step = ((float(values.max()) - self.least) / 65535 if len(values) else 0.0) or 1.0
        self.part = levels.add(np.rint((values - self.least) / self.step).astype(np.uint16))

    def at(self, index: np.ndarray) -> np.ndarray:
        return self.least + self.levels.get(self.part)[index] * self.step


class Trie:
    """Words, and below each word the contexts it was seen in.

    Three monotone levels: the words; pointers from each word to its first context; and the contexts. Those are relative to
    their word: each word's go on from the last of the word before, so that the level as a whole ascends, and one
    successor search from there finds them. Values are quantised; the counts of words are kept as they are.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, context_word: np.ndarray, context: np.ndarray, values: np.ndarray):
        """`context_word` is the place of each context's word and ascends; contexts ascend within a word."""
        self.levels = Levels()
        self.words = EliasFano(self.levels, words)
        self.counts = self.levels.add(counts.astype(np.int64))
        sizes = np.bincount(context_word, minlength=len(words))
        ends = np.cumsum(sizes)
        self.pointers = EliasFano(self.levels, np.concatenate(([0], ends)).astype(np.uint64))
        steps = np.zeros(len(words), np.uint64)
        steps[sizes > 0] = context[ends[sizes > 0] - 1].astype(np.uint64) + np.uint64(1)
        before = np.cumsum(steps) - steps
        self.contexts = EliasFano(self.levels, context.astype(np.uint64) + before[context_word])
        self.values = Quantised(self.levels, values)
        self.levels.seal()

    def word(self, wanted: np.ndarray) -> np.ndarray:
        return self.words.find(wanted)

    def count(self, index: np.ndarray) -> np.ndarray:
        counts = self.levels.get(self.counts)
        return np.where(index >= 0, counts[np.maximum(index, 0)], 0) if len(counts) else np.zeros(len(index), np.int64)

    def value(self, index: np.ndarray, context: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
        """Value of each (word, context), or `otherwise` where the pair is not in the trie."""
        known = np.flatnonzero(index >= 0)
        out = otherwise.copy()
        if not len(known) or not self.contexts.count:
            return out
        first = self.pointers.at(index[known]).astype(np.int64)
        end = self.pointers.at(index[known] + 1).astype(np.int64)
        base = np.where(first > 0, self.contexts.at(np.maximum(first - 1, 0)) + np.uint64(1), np.uint64(0))
        found = self.contexts.find(context[known].astype(np.uint64) + base)
        hit = (found >= first) & (found < end)
        out[known[hit]] = self.values.at(found[hit])
        return out
