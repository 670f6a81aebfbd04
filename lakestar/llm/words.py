"""Words of Arrow text batches as NumPy arrays: offsets and 64-bit hashes, no loop over words.

Words are runs of bytes other than 0x20 and 0x09-0x0D; UTF-8 keeps those bytes for
themselves, so splitting bytes splits characters rightly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
GAP = np.zeros(256, bool)
GAP[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a uint64 over all its bits (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int, base: int = BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Words:
    """Words of some texts that lie one behind the other in a byte buffer.

    ``start``/``stop``: byte range of each word; ``first[i]:first[i+1]`` are text i's words.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lower: bool = False):
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        self.data, self.bounds = data, bounds
        inside = ~GAP[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        self.start = np.flatnonzero(inside & (~before | edge[:-1]))
        self.stop = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, bounds)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        lengths = self.stop - self.start
        place = np.arange(len(self.data)) - np.repeat(self.start, np.diff(np.append(self.start, len(self.data)))) if self.start[0] == 0 else None
        if place is None:
            head = self.start[0]
            place = np.zeros(len(self.data), np.int64)
            place[head:] = np.arange(head, len(self.data)) - np.repeat(self.start, np.diff(np.append(self.start, len(self.data))))
        # Bytes between a word's stop and the next start count as zeros.
        term = (self.data.astype(np.uint64) + np.uint64(1)) * powers(int(place.max()) + 1)[place]
        term[GAP[self.data]] = 0
        return mix(np.add.reduceat(term, self.start) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def text(self, i: int) -> bytes:
        """Words of text i joined by one space."""
        return b" ".join(bytes(self.data[self.bounds[i]:self.bounds[i + 1]]).split())


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on; the last k - 1 places are left out."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= np.uint64(BASE)
        out += words[j:j + n]
    return mix(out)


def inside(first: np.ndarray, k: int, n_words: int) -> np.ndarray:
    """Which places of ``grams`` have all their k words in one text."""
    n = n_words - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    last = np.repeat(first[1:], np.diff(first))[:n]
    return np.arange(n) + k <= last


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string or binary column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]] if len(bounds) else data[:0], (bounds - bounds[0]) if len(bounds) else np.zeros(1, np.int64)


def pieces(column: pa.Array, lower: bool = False, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """Rows ``from:to`` of the column and their words, about ``limit`` bytes at a time (one whole text at least)."""
    data, bounds = strings(column)
    at = 0
    while at < len(bounds) - 1:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, side="right")) - 1)
        yield at, to, Words(data[bounds[at]:bounds[to]], bounds[at:to + 1] - bounds[at], lower)
        at = to


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each list."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, kind))


def word_runs(text: bytes, limit: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in order, those of about ``limit`` bytes at a time."""
    open_: list[bytes] = []  # pieces of a word that may go on
    for at in range(0, len(text), limit):
        run = text[at:at + limit]
        words = run.split()
        if open_ and not GAP[run[0]]:
            open_.append(words.pop(0))
            if words or GAP[run[-1]]:
                words.insert(0, b"".join(open_))
                open_ = []
        elif open_:
            words.insert(0, b"".join(open_))
            open_ = []
        if not open_ and not GAP[run[-1]] and at + limit < len(text):
            open_ = [words.pop()]
        if words:
            yield words
    if open_:
        yield [b"".join(open_)]
