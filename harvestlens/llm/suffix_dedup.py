"""Byte-level deduplication by merging Burrows-Wheeler transforms of shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from harvestlens.llm import arrays, regions


def stride_of(length: int, most: int = 10) -> int:
    """Bytes of a symbol: the largest divisor of the window that is not over `most`."""
    return max(d for d in range(1, most + 1) if length % d == 0)


def symbols_of(texts: list[np.ndarray], stride: int) -> tuple[np.ndarray, ...]:
    """A symbol of `stride` bytes for every place of the texts, and what follows and precedes it.

    Each text ends in `stride` end places with symbol 0. Returns symbols, the text of a place, the
    place in its text, and the symbol before it (`stride` bytes back; 0 at a text's start).
    """
    sizes = np.array([len(t) for t in texts])
    begin = np.concatenate([[0], np.cumsum(sizes + stride)])
    row = np.repeat(np.arange(len(texts)), sizes + stride)
    place = np.arange(begin[-1]) - begin[row]
    data = np.zeros(begin[-1] + stride, np.uint64)
    data[:-stride][place < sizes[row]] = np.concatenate(texts)
    packs = stride if stride <= 8 else (stride + 1) // 2
    pack = np.zeros(begin[-1], np.uint64)
    for i in range(packs):
        pack = pack << np.uint64(8) | data[i : i + begin[-1]]
    symbol = arrays.dense(pack, 1)
    if packs < stride:  # two overlapping packs
        ahead = np.concatenate([symbol[stride - packs :], np.zeros(stride - packs, np.int64)])
        symbol = arrays.dense(symbol << 32 | ahead, 1)
    symbol[place >= sizes[row]] = 0
    return symbol, row, place, np.where(place >= stride, np.roll(symbol, stride), 0)


def shard_order(symbol: np.ndarray, row: np.ndarray, stride: int) -> np.ndarray:
    """The places of one shard in the order of their suffixes (equal ones by text), by doubling."""
    rank, step, longest = symbol, stride, int(np.bincount(row).max())
    order = arrays.order_of(rank)
    while step < longest:
        ahead = np.zeros(len(rank), np.int64)
        same = row[step:] == row[:-step]
        ahead[:-step][same] = rank[step:][same]
        order = arrays.order_of(ahead)
        order = order[arrays.order_of(rank[order])]
        new = (np.diff(rank[order]) != 0) | (np.diff(ahead[order]) != 0)
        rank = np.empty(len(symbol), np.int64)
        rank[order] = np.concatenate([[1], 1 + np.cumsum(new)])
        step *= 2
    return order


def interleaved(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge shard transforms: which shard each merged suffix is from, and its common prefix with the one before.

    The interleave starts as one shard after another, sorted by no symbol. Each round reads the
    transforms in the present interleave and sorts the shard numbers stably by the symbols read,
    which sorts the suffixes by one symbol more. Suffixes stay in one block while their prefixes
    agree, so the round in which a block breaks gives the common prefix (at most `depth`, in symbols).
    """
    shard = np.repeat(np.arange(len(transforms)), [len(t) for t in transforms])
    common, block = np.full(len(shard), depth), np.zeros(len(shard), np.int64)
    common[0] = 0
    read = np.empty(len(shard), np.int64)
    for step in range(depth):
        by_shard = arrays.order_of(shard)
        read[by_shard] = np.concatenate(transforms)
        order = arrays.order_of(read)
        symbol, source, shard = read[order], block[order], shard[order]
        new = np.concatenate([[True], (symbol[1:] != symbol[:-1]) | (source[1:] != source[:-1])])
        common[new & (common == depth)] = step
        block = np.cumsum(new) - 1
    return shard, common


def find_repeats(texts: list[np.ndarray], values: np.ndarray, windows: regions.Windows, shard_bytes: int = 20_000) -> tuple[np.ndarray, ...]:
    """Text, start and stop of the runs of windows that an earlier place repeats (the smaller value comes earlier)."""
    stride = stride_of(windows.length)
    symbol, row, place, before = symbols_of(texts, stride)
    sizes = np.array([len(t) for t in texts])
    shard = np.concatenate([[0], np.cumsum(sizes + stride)])[:-1] // shard_bytes
    edges = np.searchsorted(shard[row], np.arange(shard[-1] + 2)) if len(row) else []
    suffixes = [a + shard_order(symbol[a:b], row[a:b] - row[a], stride) for a, b in zip(edges[:-1], edges[1:], strict=True) if b > a]
    source, common = interleaved([before[s] for s in suffixes], windows.length // stride)
    at = np.empty(len(source), np.int64)
    at[arrays.order_of(source)] = np.concatenate(suffixes)
    own = values[row] + place
    value = np.where(place + windows.length <= sizes[row], own, np.iinfo(np.int64).max)
    starts = np.flatnonzero(common < windows.length // stride)
    least = np.minimum.reduceat(value[at], starts)
    hit = np.zeros(len(row), bool)
    hit[at] = np.repeat(least, np.diff(np.append(starts, len(at)))) < own[at]
    hit &= place + windows.length <= sizes[row]
    return regions.runs_of(row, place, hit, windows.length)


def byte_symbols(column: pa.Array) -> list[np.ndarray]:
    """The bytes of every row."""
    data, offsets = arrays.text_buffer(column)
    return [data[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def remove_repeated_bytes(docs: DataFrame, length: int = 100, gram: int = 40, most: int = 1000) -> DataFrame:
    """Remove every byte in a run of `length` bytes that also starts earlier in the corpus.

    docs: doc_id, text; its UTF-8 bytes count. Earlier means a smaller doc_id, or the same document
    and an earlier start; runs are judged on the texts as they come, overlaps count, none crosses documents.
    Returns doc_id, n_bytes, n_removed, spans (array of start and stop of the removed runs), kept
    (binary), a row per row of docs.

    Null text counts as empty. Null ids come last of all and stay null. Rows that share id and text are
    one document and get the same result. Other columns are ignored; an empty table gives an empty one.
    Equal surroundings of an anchor (exact copies, passages that very many documents share) are told by two 64-bit hashes,
    the merged transforms decide on the others (see `regions`). `most`: different regions around one anchor that are merged at once; larger groups are split
    (see `regions`).
    """

    def apply(bodies: list[bytes], cut: list) -> list[tuple]:
        out = []
        for body, (starts, stops) in zip(bodies, cut, strict=True):
            starts, stops = np.maximum(starts, 0).tolist(), np.minimum(stops, len(body)).tolist()
            kept = b"".join(body[a:b] for a, b in zip([0, *stops], [*starts, len(body)], strict=True))
            out.append((len(body), len(body) - len(kept), [{"start": a, "stop": b} for a, b in zip(starts, stops, strict=True)], kept))
        return out

    returns = "n_bytes long, n_removed long, spans array<struct<start:long,stop:long>>, kept binary"
    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    kinds = [pa.int64(), pa.int64(), spans, pa.binary()]
    return regions.applied(docs, regions.Windows(length, gram, most), byte_symbols, np.uint8, find_repeats, apply, returns, kinds)
