"""Licence scan with a positional index of licence templates, entered by rare words."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlens.llm import arrays
from harvestlens.llm.license_texts import BASE, TEMPLATES

#: Digits, letters and everything beyond ASCII, once A-Z are lower-cased.
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Template(NamedTuple):
    """A label, the numbers of the words, the key phrases' words, and whether it is a base phrase."""

    label: str
    words: np.ndarray
    keys: list[np.ndarray]
    base: bool


class PositionalIndex(NamedTuple):
    """The vocabulary's sorted hashes and a bitmap over them, the templates, and postings: (template, word) to positions."""

    hashes: np.ndarray
    bitmap: np.ndarray
    templates: list[Template]
    postings: dict[tuple[int, int], np.ndarray]


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows one after another, and where each row begins."""
    data, offsets = arrays.text_buffer(column)
    data = arrays.LOWER[data]
    starts, ends, first = arrays.words(data, offsets, WORD)
    return arrays.word_hashes(data, starts, ends), first


def positional_index(templates: list[tuple[str, str, list[str]]] = TEMPLATES, base: list[tuple[str, str]] = BASE) -> PositionalIndex:
    """The index of all templates, base phrases among them."""
    hashed = lambda text: words_of(pa.array([text]))[0]
    texts = [(label, text, keys, False) for label, text, keys in templates] + [(label, text, [text], True) for label, text in base]
    names = np.unique(np.concatenate([hashed(t) for _, t, _, _ in texts]))
    number = lambda text: np.searchsorted(names, hashed(text))
    out = [Template(label, number(text), [number(k) for k in keys], is_base) for label, text, keys, is_base in texts]
    postings = defaultdict(list)
    for i, template in enumerate(out):
        for at, word in enumerate(template.words.tolist()):
            postings[i, word].append(at)
    bitmap = np.zeros(1 << 16, bool)
    bitmap[names >> np.uint64(48)] = True
    return PositionalIndex(names, bitmap, out, {k: np.array(v) for k, v in postings.items()})


def found_words(index: PositionalIndex, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where licence words stand, and their numbers."""
    at = np.flatnonzero(index.bitmap[hashes >> np.uint64(48)])
    number = np.minimum(np.searchsorted(index.hashes, hashes[at]), len(index.hashes) - 1)
    same = index.hashes[number] == hashes[at]
    return at[same], number[same]


def document_frequencies(docs: DataFrame, index: PositionalIndex) -> tuple[np.ndarray, int]:
    """In how many documents each licence word stands, over all documents, and how many documents there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(index.hashes) + 1, np.int64)
        for batch in batches:
            for chunk in arrays.chunks(batch, "text"):
                hashes, first = words_of(chunk.column("text"))
                at, number = found_words(index, hashes)
                row = np.searchsorted(first, at, "right") - 1
                total[:-1] += np.bincount(np.unique(row * len(index.hashes) + number) % len(index.hashes), minlength=len(index.hashes))
                total[-1] += chunk.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["word", "n"])

    sums = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(index.hashes) + 1, np.int64)
    for r in sums:
        out[r.word] = r.n
    return out[:-1], int(out[-1])


def alignments(index: PositionalIndex, template: int, at: np.ndarray, number: np.ndarray, idf: np.ndarray, rare: int) -> np.ndarray:
    """Word positions where the template can begin.

    The file's `rare` highest-IDF words of the template are looked up; each posting says where the template
    would begin. For a base phrase, which stands whole or not at all, only starts that all its words name are kept; for
    others every start that one of the words names, since the share of words in place decides there.
    """
    own = index.templates[template]
    there = np.intersect1d(number, own.words)
    chosen = there[np.lexsort((there, -idf[there]))][: None if own.base else rare]
    starts = []
    for word in chosen.tolist():
        places = at[number == word]
        starts.append(np.unique((places[:, None] - index.postings[template, word][None, :]).reshape(-1)))
    if not starts:
        return np.zeros(0, np.int64)
    start, votes = np.unique(np.concatenate(starts), return_counts=True)
    return start[votes == len(np.unique(own.words))] if own.base else start


def phrase_at(words: np.ndarray, phrase: np.ndarray, low: int, high: int) -> bool:
    """Whether the phrase stands in words[low:high], one word after another."""
    part = words[max(low, 0) : max(high, 0)]
    if len(part) < len(phrase):
        return False
    return bool((np.lib.stride_tricks.sliding_window_view(part, len(phrase)) == phrase).all(axis=1).any())


def scan_words(index: PositionalIndex, words: np.ndarray, at: np.ndarray, number: np.ndarray, idf: np.ndarray, rare: int, least: float) -> dict:
    """Base places, labels and score of one document; `words` are its numbers (-1: no licence word)."""
    out = {"places": [], "base": set(), "labels": set(), "score": 0.0}
    present = np.zeros(len(index.hashes), bool)
    present[number] = True
    for i, template in enumerate(index.templates):
        if not all(present[k].all() for k in template.keys):
            continue
        size = len(template.words)
        for start in alignments(index, i, at, number, idf, rare).tolist():
            low, high = max(0, start), min(len(words), start + size)
            share = float((words[low:high] == template.words[low - start : high - start]).sum()) / size
            if template.base:
                if share == 1.0:
                    out["places"].append(start)
                    out["base"].add(template.label)
                    out["labels"].add(template.label)
                    out["score"] = 1.0
            elif share >= least and all(phrase_at(words, k, start - size, start + 2 * size) for k in template.keys):
                out["labels"].add(template.label)
                out["score"] = max(out["score"], share)
    return out


def scan_licenses(docs: DataFrame, index: PositionalIndex | None = None, rare: int = 6, least: float = 0.6) -> DataFrame:
    """Licence phrases and notices in every whole text.

    docs: doc_id, text. Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased. For every template
    the file's `rare` rarest licence words (by document frequency over all documents) are looked up in the positional
    index, their postings taken to the places where the template would begin, and at one of them at least the share
    `least` of the template's words must stand in place and its key phrases must stand nearby. A label is only lost where none of
    these rare words is in place. Base phrases are templates too, whole and exact, by the intersection of all their words' postings.

    Returns, per row, doc_id, n_words, n_base, first_word, last_word, base_labels, labels (sorted arrays) and score: the
    largest share, 0 without a label. Null or empty text: no words, no labels. Null ids and repeated rows are rows of
    their own. Other columns are ignored; an empty table gives an empty table.
    """
    index = index or positional_index()
    frequency, total = document_frequencies(docs, index)
    idf = np.log((1 + total) / (1 + frequency))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in arrays.chunks(batch, "text"):
                hashes, first = words_of(chunk.column("text"))
                place, number = found_words(index, hashes)
                numbers = np.full(len(hashes), -1)
                numbers[place] = number
                cuts, out = np.searchsorted(place, first), []
                for row in range(chunk.num_rows):
                    low, high = cuts[row], cuts[row + 1]
                    found = scan_words(index, numbers[first[row] : first[row + 1]], place[low:high] - first[row], number[low:high], idf, rare, least)
                    places = found["places"]
                    out.append((int(first[row + 1] - first[row]), len(places), min(places, default=None), max(places, default=None), sorted(found["base"]), sorted(found["labels"]), found["score"]))
                kinds = [pa.int64()] * 4 + [pa.list_(pa.string())] * 2 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), *(pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds))], ["doc_id", *NAMES])

    returns = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, returns)


NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
