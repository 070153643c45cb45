"""Benchmark passages in documents, found by spaced seeds that tolerate substituted words."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlens.llm import arrays

#: Letters, digits and everything beyond ASCII, once A-Z are lower-cased.
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


class Overlap(NamedTuple):
    """Masks (1: the word counts), and what an overlap needs: words, and the percentage of them that are equal."""

    masks: tuple[str, ...] = ("1111111", "110101111", "1110010111", "11011000111")
    words: int = 13
    percent: int = 80


class SeedIndex(NamedTuple):
    """Words of the items one after another, where each begins, and per mask the sorted seed hashes, their places and a bitmap."""

    ids: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    seeds: list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows one after another, and where each row begins."""
    data, offsets = arrays.text_buffer(column)
    data = arrays.LOWER[data]
    starts, ends, first = arrays.words(data, offsets, WORD)
    return arrays.word_hashes(data, starts, ends), first


def seed_hashes(hashes: np.ndarray, first: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """The places where the mask fits into a row, and the hashes of the words that it keeps there."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    places = np.flatnonzero(np.arange(len(hashes)) + len(mask) <= first[1:][row])
    out = np.zeros(len(places), np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            out = out * arrays.STEP + hashes[places + i]
    return places, arrays.mix(out)


def seed_index(ids: np.ndarray, texts: pa.Array, overlap: Overlap) -> SeedIndex:
    """The index of some benchmark items; ids: what tells each of them."""
    hashes, first = hashed_words(texts)
    seeds = []
    for mask in overlap.masks:
        places, own = seed_hashes(hashes, first, mask)
        order = np.argsort(own, kind="stable")
        bits = min(26, max(10, int(np.ceil(np.log2(len(own) + 1))) + 5))
        bitmap = np.zeros(1 << bits, bool)
        bitmap[own >> np.uint64(64 - bits)] = True
        seeds.append((own[order], places[order], bitmap))
    return SeedIndex(ids, hashes, first, seeds)


def hits(index: SeedIndex, hashes: np.ndarray, first: np.ndarray, overlap: Overlap) -> np.ndarray:
    """Distinct (row, item, place of the item's first word in the row) that share a seed."""
    found = [np.zeros((0, 3), np.int64)]
    for mask, (own, item_places, bitmap) in zip(overlap.masks, index.seeds, strict=True):
        places, seeds = seed_hashes(hashes, first, mask)
        maybe = bitmap[seeds >> np.uint64(64 - int(len(bitmap)).bit_length() + 1)]
        places, seeds = places[maybe], seeds[maybe]
        low, high = np.searchsorted(own, seeds, "left"), np.searchsorted(own, seeds, "right")
        n = high - low
        at = np.repeat(low, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        here, there = np.repeat(places, n), item_places[at]
        row, item = np.searchsorted(first, here, "right") - 1, np.searchsorted(index.first, there, "right") - 1
        found.append(np.unique(np.stack([row, item, here - first[row] - (there - index.first[item])], 1), axis=0))
    return np.unique(np.concatenate(found), axis=0)


def best_overlap(equal: np.ndarray, overlap: Overlap) -> tuple[int, int, int] | None:
    """Start, words and equal words of the longest run that is long enough and alike enough, or None if there is none.

    An equal word scores the part that may differ and another one loses the part that must be equal, so a run
    has enough equal words exactly when its score is 0 or more. The longest such run that ends at a place starts where the
    running minimum of the scores first comes down to the score there. Of equally long runs the one with more equal words
    counts, then the first.
    """
    total = np.concatenate([[0], np.cumsum(np.where(equal, 100 - overlap.percent, -overlap.percent))])
    same = np.concatenate([[0], np.cumsum(equal)])
    starts = np.searchsorted(-np.minimum.accumulate(total), -total, "left")
    sizes = np.arange(len(total)) - starts
    longest = int(sizes.max())
    if longest < overlap.words:
        return None
    stops = np.flatnonzero(sizes == longest)
    held = same[stops] - same[stops - longest]
    stop = int(stops[held.argmax()])
    return stop - longest, longest, int(held.max())


def contaminated(docs: DataFrame, benchmark: DataFrame, overlap: Overlap = Overlap(), block_bytes: int = 2 << 20, keep: list[str] = []) -> DataFrame:
    """Benchmark items that documents hold, words substituted here and there.

    docs: doc_id, text; benchmark: item_id, text. Words are runs of letters and digits, A-Z lower-cased. Seeds of documents
    and items are hashes of the words that a mask keeps; where they meet, the item is laid over the document without gaps
    and a run of words must have `overlap.words` words (or the whole item, where that is shorter but as long
    as the shortest mask) and `overlap.percent` of them equal. Returns, per document and item, doc_id, item_id, doc_start,
    item_start (words from 0), n_words and n_equal of the longest such run (ties: more equal words, then the first),
    item_hash (64 bits of the item's text) and the document's columns `keep`. A run is only seen if it shares a seed with the item: of a 13-word item with 2 words
    substituted, 76 of the 78 patterns do.

    The different items are taken in blocks of about `block_bytes` of text, each sent to all tasks; a larger benchmark makes
    more blocks, and every block meets all documents. Null or empty texts and items shorter than the shortest
    mask hold and give nothing. Null ids and repeated rows of docs are rows of their own. An item is a different pair of id, null or
    not, and text: equal rows of the benchmark are one item, and texts that share an id are items of their own, told apart by
    item_hash, so that no block size changes a row. Other columns are ignored; an empty table on either side gives an empty table.
    """
    shortest = min(map(len, overlap.masks))
    items = benchmark.filter("text is not null").select(F.col("item_id").cast("long"), "text").distinct().withColumn("item_hash", F.xxhash64("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = size // block_bytes + 1
    spark, out = docs.sparkSession, None
    returns = arrays.schema_with("doc_id long, item_id long, doc_start long, item_start long, n_words long, n_equal long, item_hash long", docs, keep)

    for block in range(n_blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).orderBy("item_id", "text").collect()
        names = np.empty(len(own), object)
        names[:] = [(r.item_id, r.item_hash) for r in own]
        index = spark.sparkContext.broadcast(seed_index(names, pa.array([r.text for r in own], pa.string()), overlap))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            seeds = index.value
            for batch in batches:
                for chunk in arrays.chunks(batch, "text", arrays.SMALL):
                    hashes, first = hashed_words(chunk.column("text"))
                    ids, best = chunk.column("doc_id").to_pylist(), {}
                    for row, item, at in hits(seeds, hashes, first, overlap).tolist():
                        words, text = seeds.hashes[seeds.first[item] : seeds.first[item + 1]], hashes[first[row] : first[row + 1]]
                        low, high = max(0, -at), min(len(words), len(text) - at)
                        need = overlap._replace(words=max(shortest, min(overlap.words, len(words))))
                        if got := best_overlap(words[low:high] == text[at + low : at + high], need):
                            start, n, same = got
                            key, rank = (row, item), (-n, -same, at + low + start, low + start)
                            best[key] = min(best.get(key, rank), rank)
                    found = [(ids[row], seeds.ids[item][0], r[2], r[3], -r[0], -r[1], seeds.ids[item][1]) for (row, item), r in best.items()]
                    own = pa.array([row for row, _ in best], pa.int64())
                    yield pa.RecordBatch.from_arrays([*(pa.array([f[i] for f in found], pa.int64()) for i in range(7)), *(chunk.column(c).take(own) for c in keep)], returns.names)

        part = docs.select(F.col("doc_id").cast("long"), "text", *keep).mapInArrow(run, returns)
        out = part if out is None else out.unionByName(part)
    return out
