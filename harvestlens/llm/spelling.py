"""Groups of spelling variants: one-edit neighbours found through a reduced alphabet."""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlens.llm import arrays
from harvestlens.session import passing_tables, write_and_read

#: The letters of a word: A-Z, a-z and U+00C0 to U+00FF, whose UTF-8 form is the byte C3 and another one.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


class Variants(NamedTuple):
    """How words are noised, which count, when one is the form of another, and the size of the reduced alphabet.

    Of the runs whose hash `noise` divides one letter is dropped (0: of none). Words have `letters` code points and
    `occurrences` at least. A form occurs `ratio` times as often as its variant. Letters are hashed to `symbols` symbols.
    """

    noise: int = 31
    letters: int = 7
    occurrences: int = 2
    ratio: int = 10
    symbols: int = 6


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start and end byte of every run of letters, and the row it stands in."""
    inner, lead = ASCII_LETTER[data], data == 0xC3
    inner |= lead
    inner[1:] |= lead[:-1]
    number = np.flatnonzero(inner)
    if not len(number):
        return number, number, number
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begin, end = inner.copy(), inner.copy()
    begin[1:] &= ~inner[:-1] | cut[1:-1]
    end[:-1] &= ~inner[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def counted_words(ids: list, column: pa.Array, variants: Variants) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of some documents that are long enough, and how often each occurs."""
    data, offsets = arrays.text_buffer(column)
    data = arrays.LOWER[data]
    starts, ends, row = runs(data, offsets)
    continuation = np.concatenate([[0], np.cumsum((data & 0xC0) == 0x80)])
    letters = ends - starts - (continuation[ends] - continuation[starts])
    enough = letters >= variants.letters
    starts, ends, row, letters = starts[enough], ends[enough], row[enough], letters[enough]
    if not variants.noise:
        noised = np.zeros(len(starts), bool)
    else:
        before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
        hashes = arrays.crc32(data, starts, ends, before[row])
        noised = hashes % np.uint32(variants.noise) == 0
    cut = []
    shorter = noised & (letters > variants.letters)
    for a, b, h in zip(starts[shorter].tolist(), ends[shorter].tolist(), hashes[shorter].tolist() if shorter.any() else [], strict=True):
        word = data[a:b].tobytes().decode()
        at = h % len(word)
        cut.append(word[:at] + word[at + 1 :])
    whole = arrays.strings(data, starts[~noised], ends[~noised])
    words = pa.concat_arrays([whole, pa.array(cut, pa.large_string())]).dictionary_encode()
    return words.dictionary.cast(pa.string()), np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary)).astype(np.int64)


def vocabulary(docs: DataFrame, variants: Variants) -> DataFrame:
    """word, n: the words of all documents that are long and frequent enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in arrays.chunks(batch, "text", 1 << 23):
                words, n = counted_words(chunk.column("doc_id").to_pylist(), chunk.column("text"), variants)
                yield pa.RecordBatch.from_arrays([words, pa.array(n)], ["word", "n"])

    counts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= variants.occurrences)


#: The symbol of each letter, by a hash of the letter, before it is taken modulo the number of symbols.
LETTER_HASH = np.zeros(256, np.int64)
LETTER_HASH[[ord(c) for c in LETTERS]] = [zlib.crc32(c.encode()) >> 8 for c in LETTERS]
BASE = int(arrays.STEP)
POWER_BACK = pow(BASE, -1, 1 << 64)


def reduced_keys(words: list[str], symbols: int, edits: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Word numbers, 64-bit keys and whether a key is that of the reduced word itself; with `edits` also the keys of its edits.

    The one-edit neighbourhood of reduced words is symmetric, so each pair of neighbours is generated from one side only: the
    longer word drops each letter, and of two equally long words the one with the smaller symbol replaces it by each
    larger one. A key is a polynomial of the symbols, so the key of an edited word follows from those of its parts: a word
    costs as many steps as it has edits. Equal reduced words have equal keys; a word's keys are given once each.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    for size in np.unique(sizes).tolist():
        number = np.flatnonzero(sizes == size)
        text = "".join(words[i] for i in number.tolist()).encode("latin-1")
        value = (LETTER_HASH[np.frombuffer(text, np.uint8)] % symbols + 1).astype(np.uint64).reshape(len(number), size)
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, BASE, np.uint64)]), dtype=np.uint64)
        prefix = np.concatenate([np.zeros((len(number), 1), np.uint64), np.cumsum(value * power[:size], axis=1, dtype=np.uint64)], axis=1)
        whole = prefix[:, -1:]
        key = lambda polynomial, length: arrays.mix(polynomial + np.uint64(length * BASE % (1 << 64)))
        yield number, key(whole, size)[:, 0], np.ones(len(number), bool)
        if edits and size > 1:
            dropped = key(prefix[:, :-1] + (whole - prefix[:, 1:]) * np.uint64(POWER_BACK), size - 1)
            new = np.ones(dropped.shape, bool)
            new[:, 1:] = value[:, 1:] != value[:, :-1]  # of equal neighbours either drop gives the same
            yield np.broadcast_to(number[:, None], new.shape)[new], dropped[new], np.zeros(int(new.sum()), bool)
        for symbol in range(2, symbols + 1) if edits else ():
            new = value < symbol
            replaced = key(whole + (np.uint64(symbol) - value) * power[:size], size)
            yield np.broadcast_to(number[:, None], new.shape)[new], replaced[new], np.zeros(int(new.sum()), bool)


def with_keys(words: DataFrame, symbols: int, edits: bool) -> DataFrame:
    """(word, n) with the keys of the reduced word, or of its one-edit neighbourhood, and whether a key is its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 5000):
                part = batch.slice(row, 5000)
                for number, keys, own in reduced_keys(part.column("word").to_pylist(), symbols, edits):
                    at = pa.array(number)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("word").take(at), part.column("n").take(at), pa.array(keys.view(np.int64)), pa.array(own)], ["word", "n", "key", "own"]
                    )

    return words.mapInArrow(run, "word string, n long, key long, own boolean")


def near_words(words: DataFrame, symbols: int) -> DataFrame:
    """word, other, other_n: all pairs of words of (word, n) that differ by one letter, each in both directions.

    The neighbourhoods of reduced words meet the reduced forms of all words in an equi-join, and what shares a key is
    verified on the words themselves. A replaced letter may have the symbol of the one it replaces, so words with
    the same reduced form are neighbours too.
    """
    asked = with_keys(words, symbols, True)
    there = with_keys(words, symbols, False).select(F.col("word").alias("other"), F.col("n").alias("other_n"), "key")
    # Spark takes the neighbourhoods for no larger than the words, so it would broadcast them
    joined = asked.join(there.hint("merge"), "key").filter((~F.col("own") | (F.col("word") < F.col("other"))) & (F.levenshtein("word", "other", 1) == 1))
    pair = lambda a, b, n: F.struct(F.col(a).alias("word"), F.col(b).alias("other"), F.col(n).alias("other_n"))
    return joined.select(F.inline(F.array(pair("word", "other", "other_n"), pair("other", "word", "n"))))


def roots(forms: DataFrame, keep) -> DataFrame:
    """word, root for words of (word, form): the end of the chain of forms, by joins that double the step each round.

    A form occurs more often than its variant, so there is no cycle; each round is written to the shared folder.
    """
    state = forms.select("word", F.col("form").alias("root"))
    for step in itertools.count():
        state = keep(state, f"roots-{step}")
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if state.join(further, "root", "left_semi").isEmpty():
            return state
        state = state.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))


def group_variants(docs: DataFrame, variants: Variants = Variants()) -> DataFrame:
    """Words of all whole texts with the frequent word that each is a variant of.

    docs: doc_id, text. A run is a longest stretch of `[A-Za-z\\u00C0-\\u00FF]`, A-Z lower-cased. If `noise` divides h, the
    unsigned CRC-32 of the UTF-8 text `<doc_id>:<run>`, the run loses its code point h % length. Words are the results
    with enough code points and occurrences (n). Two words are near if one inserted, deleted or replaced code point makes
    one the other. A word's form is its near word of largest n (ties: smallest in code-point order) if that occurs
    `ratio` times as often at least. Returns word, form (or null), root (the last of the chain of forms, or the word
    itself), n, n_near (near words), form_n (the form's n, or null).

    Null text has no runs; a null id is written as nothing (`:<run>`). Repeated rows are counted as often as they stand.
    Other columns are ignored; an empty table gives an empty table. Only words, not their occurrences, are shuffled and joined.
    """
    with passing_tables(docs.sparkSession, "spelling") as keep:
        words = keep(vocabulary(docs, variants), "words")
        best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
        near = near_words(words, variants.symbols).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
        joined = words.join(near, "word", "left").withColumn("form_n", -F.col("best.less"))
        is_form = F.col("form_n") >= variants.ratio * F.col("n")
        linked = keep(joined.select(
            "word", F.when(is_form, F.col("best.form")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("form_n")).alias("form_n"),
        ), "linked")
        ends = roots(linked.filter("form is not null"), keep)
        out = linked.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
        return write_and_read(out, "spelling")
