"""Substring deduplication on words with an FM-index per shard of candidate regions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from harvestlens.llm import arrays, regions


class FMIndex:
    """Backward search over the Burrows-Wheeler transform of some texts of non-zero symbols.

    The transform is kept as a wavelet matrix: a plane of packed bits per bit of a symbol, with a
    count of ones before every 64 bits. Suffixes are sorted by their first `depth` symbols, which
    keeps the intervals of all patterns shorter than that exact.
    """

    def __init__(self, text: np.ndarray, depth: int):
        self.suffixes = self._sorted(text, depth)
        bwt = text[self.suffixes - 1]
        self.levels = max(1, int(text.max()).bit_length())
        self.before = np.concatenate([[0], np.cumsum(np.bincount(bwt, minlength=1 << self.levels))])
        self.planes = []
        for level in range(self.levels - 1, -1, -1):
            bits = (bwt >> level & 1).astype(np.uint8)
            packed = np.packbits(np.concatenate([bits, np.zeros(64 + -len(bits) % 64, np.uint8)]), bitorder="little").view(np.uint64)
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed))]).astype(np.int64)
            self.planes.append((level, packed, ones, len(bits) - int(bits.sum())))
            bwt = np.concatenate([bwt[bits == 0], bwt[bits == 1]])
        self.first = self._walk(np.arange(1 << self.levels), np.zeros(1 << self.levels, np.int64))

    @staticmethod
    def _sorted(text: np.ndarray, depth: int) -> np.ndarray:
        rank, size = text, 1
        order = arrays.order_of(rank)
        while size < depth:
            ahead = np.concatenate([rank[size:], np.zeros(min(size, len(rank)), rank.dtype)])
            order = arrays.order_of(ahead)
            order = order[arrays.order_of(rank[order])]
            new = (np.diff(rank[order]) != 0) | (np.diff(ahead[order]) != 0)
            rank = np.empty(len(text), np.int64)
            rank[order] = np.concatenate([[1], 1 + np.cumsum(new)])
            size *= 2
        return order

    def _walk(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, packed, ones, zeros in self.planes:
            block, rest = at >> 6, (at & 63).astype(np.uint64)
            one = ones[block] + np.bitwise_count(packed[block] & ((np.uint64(1) << rest) - np.uint64(1)))
            at = np.where(symbols >> level & 1, zeros + one, at - one)
        return at

    def extended(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix intervals of symbol + pattern, from those of the patterns."""
        both = self._walk(np.concatenate([symbols, symbols]), np.concatenate([low, high])).reshape(2, -1)
        base = self.before[symbols] - self.first[symbols]
        return both[0] + base, both[1] + base


def matching_intervals(index: FMIndex, text: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Matching statistics, counted up to `length`, of the positions `ends` (exclusive) of a streamed text.

    Returns the number of symbols before each end that occur at two places or more, and the suffix
    interval of those that reach `length`. A pattern found once only is the streamed place itself.
    """
    size = np.zeros(len(ends), np.int64)
    low, high = np.zeros(len(ends), np.int64), np.full(len(ends), len(index.suffixes))
    live = np.arange(len(ends))
    for step in range(1, length + 1):
        a, b = index.extended(text[ends[live] - step], low[live], high[live])
        go = b - a > 1
        live = live[go]
        low[live], high[live], size[live] = a[go], b[go], step
    return size, low, high


def find_repeats(texts: list[np.ndarray], values: np.ndarray, windows: regions.Windows) -> tuple[np.ndarray, ...]:
    """Text, start and stop of the runs of windows that an earlier place repeats (the smaller value comes earlier)."""
    row, place, value = regions.flat_windows(texts, values, windows)
    if not len(row):
        return row, place, place
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
    inside = np.ones(begin[-1], bool)
    inside[begin[1:] - 1] = False
    text = np.zeros(begin[-1], np.int64)
    text[inside] = arrays.dense(np.concatenate(texts), 1)
    index = FMIndex(text, windows.length + 1)
    at = begin[row] + place
    size, low, high = matching_intervals(index, text, at + windows.length, windows.length)
    own = np.full(len(text), np.iinfo(np.int64).max)
    own[at] = value
    found = np.flatnonzero(size == windows.length)
    if not len(found):
        return row[:0], row[:0], row[:0]
    lows, back = np.unique(low[found], return_inverse=True)
    highs = np.empty_like(lows)
    highs[back] = high[found]
    least = np.minimum.reduceat(np.append(own[index.suffixes], 0), np.stack([lows, highs], 1).reshape(-1))[::2]
    hit = np.zeros(len(row), bool)
    hit[found] = least[back] < value[found]
    return regions.runs_of(row, place, hit, windows.length)


def word_symbols(column: pa.Array) -> list[np.ndarray]:
    """Hashes of the words of every row."""
    data, offsets = arrays.text_buffer(column)
    starts, ends, first = arrays.words(data, offsets, arrays.NOT_BLANK)
    hashes = arrays.word_hashes(data, starts, ends)
    return [hashes[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]


def remove_repeated_passages(docs: DataFrame, length: int = 20, gram: int = 8, most: int = 2000) -> DataFrame:
    """Remove every word in a run of `length` words that also starts earlier in the corpus.

    docs: doc_id, text. Earlier means a smaller doc_id, or the same document and an earlier start;
    runs are judged on the texts as they come. Words are runs of `[^\\x20\\x09-\\x0D]`.
    Returns doc_id, n_words, n_removed, kept (the words left, joined by a blank), a row per row of docs.

    Null or empty text: no words, kept ''. Null ids come last of all and stay null. Rows that share id and
    text are one document and get the same result; rows of one id with different texts are compared
    by their places. Other columns are ignored. An empty table gives an empty table. Equal words are
    told by a 64-bit hash, and so are equal surroundings of an anchor (exact copies, passages that very many documents
    share); the index decides on the others (see `regions`). `most`: different regions around one anchor that one index may hold; larger
    groups are split (see `regions`).
    """

    def apply(bodies: list[bytes], cut: list) -> list[tuple]:
        out = []
        for body, (starts, stops) in zip(bodies, cut, strict=True):
            data = np.frombuffer(body, np.uint8)
            begin, end, _ = arrays.words(data, np.array([0, len(data)]), arrays.NOT_BLANK)
            keep = np.ones(len(begin), bool)
            for a, b in zip(np.maximum(starts, 0), stops, strict=True):
                keep[a:b] = False
            kept = b" ".join(body[a:b] for a, b in zip(begin[keep].tolist(), end[keep].tolist(), strict=True))
            out.append((len(begin), len(begin) - int(keep.sum()), kept.decode()))
        return out

    kinds = [pa.int64(), pa.int64(), pa.string()]
    return regions.applied(docs, regions.Windows(length, gram, most), word_symbols, np.uint64, find_repeats, apply, "n_words long, n_removed long, kept string", kinds)
