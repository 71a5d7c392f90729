"""Texts as flat byte arrays: their words and byte strings as numbers, for tasks that count them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: The symbol before a text's begin and behind its end, and the bits of a symbol.
EDGE, WIDTH = 256, 9


def mix(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64, copy=False)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def runs(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions of runs one after the other, and the number of the run of each."""
    before = np.cumsum(lengths) - lengths
    run = np.repeat(np.arange(len(starts)), lengths)
    return np.arange(len(run)) + (starts - before)[run], run


class Places:
    """Finds distinct numbers by a table of twice their size and more, open addressing."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.bits = keys, max(1, int(2 * len(keys)).bit_length())
        self.slot = np.full(1 << self.bits, -1, np.int32)
        left, at = np.arange(len(keys), dtype=np.int32), self._first(keys)
        while len(left):
            free = self.slot[at] < 0
            self.slot[at[free]] = left[free]
            out = self.slot[at] != left
            left, at = left[out], (at[out] + 1) & (len(self.slot) - 1)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place in `keys` of each wanted number; all of them have to be there."""
        at = self._first(wanted)
        found = self.slot[at]
        left = np.flatnonzero(self.keys[found] != wanted)
        at = at[left]
        while len(left):
            at = (at + 1) & (len(self.slot) - 1)
            found[left] = self.slot[at]
            if (found[left] < 0).any():
                raise KeyError("a number that is not among the keys")
            out = self.keys[found[left]] != wanted[left]
            left, at = left[out], at[out]
        return found


class Texts:
    """The bytes of a column of texts, A-Z lower-cased if asked for."""

    def __init__(self, column: pa.Array | pa.ChunkedArray, lower: bool = True):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = column.cast(pa.large_binary())
        self.ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        self.data = data + ((data >= 65) & (data <= 90)) * np.uint8(32) if lower else data
        self.space = (self.data == 32) | ((self.data >= 9) & (self.data <= 13))

    def slices(self, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, start, end) of parts of about `limit` bytes together; a text is cut behind white
        space only."""
        texts, starts, ends, held = [], [], [], 0
        for i in range(len(self.ends) - 1):
            start, stop = int(self.ends[i]), int(self.ends[i + 1])
            while True:
                end = stop
                if stop - start > limit:
                    later = np.flatnonzero(self.space[start + limit : min(start + 2 * limit, stop)])
                    if not len(later):
                        later = np.flatnonzero(self.space[start + limit : stop])
                    end = start + limit + int(later[0]) + 1 if len(later) else stop
                texts.append(i)
                starts.append(start)
                ends.append(end)
                held += end - start
                if held >= limit:
                    yield np.array(texts), np.array(starts), np.array(ends)
                    texts, starts, ends, held = [], [], [], 0
                if end == stop:
                    break
                start = end
        if texts:
            yield np.array(texts), np.array(starts), np.array(ends)

    def whole(self, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The same for uncut texts: at least one, and no more than `limit` bytes if several."""
        sizes, at = np.diff(self.ends), 0
        while at < len(sizes):
            end = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), limit, "right")) + at)
            rows = np.arange(at, end)
            yield rows, self.ends[rows], self.ends[rows + 1]
            at = end

    def grams(self, text: np.ndarray, start: np.ndarray, end: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """For each symbol of the parts, ends included: the code of it and the `depth` symbols before
        it, the oldest highest; and its text."""
        size, closed = end - start, (end == self.ends[text + 1]).astype(np.int64)
        total = size + depth + closed
        kinds = np.tile(np.array([False, True, False]), len(text))
        inside = np.repeat(kinds, np.c_[np.full(len(text), depth), size, closed].ravel())
        symbols = np.full(len(inside), EDGE, np.int64)
        # The parts of a slice lie side by side.
        symbols[inside] = self.data[start[0] : end[-1]] if len(start) else 0
        begin = np.cumsum(total) - total
        for i in np.flatnonzero(start > self.ends[text]):  # behind a cut: the symbols before it
            before = self.data[max(start[i] - depth, self.ends[text[i]]) : start[i]]
            symbols[begin[i] + depth - len(before) : begin[i] + depth] = before
        code = symbols.copy()
        for k in range(1, depth + 1):
            code[k:] |= symbols[:-k] << (WIDTH * k)
        kinds = np.tile(np.array([False, True]), len(text))
        new = np.repeat(kinds, np.c_[np.full(len(text), depth), size + closed].ravel())
        return code[new], np.repeat(text, size + closed)

    def words(self, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A 64-bit hash of each word of the parts, which lie side by side, and its text."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(text) or start[0] == end[-1]:
            return none
        low, high = start[0], end[-1]
        letter = ~self.space[low:high]
        begins = letter.copy()
        begins[1:] &= ~letter[:-1]
        heads = start[start < end] - low
        begins[heads] = letter[heads]
        first = np.flatnonzero(begins)
        if not len(first):
            return none
        letters = np.flatnonzero(letter)
        at = np.searchsorted(letters, first)
        place = letters - np.repeat(first, np.diff(np.r_[at, len(letters)]))
        mixed = mix((self.data[low:high][letter] + np.int64(256) * place).view(np.uint64))
        owner = text[np.searchsorted(start, first + low, "right") - 1]
        return mix(np.add.reduceat(mixed, at)).view(np.int64), owner
