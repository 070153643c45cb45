"""Token counts under a unigram vocabulary, without building the tokens."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlens.llm import arrays

#: The mark that stands for a blank in the vocabulary.
MARK = "▁"
MARK_BYTES = np.frombuffer(MARK.encode(), np.uint8)
#: How much worse than the worst piece an unknown character scores, as public unigram tokenizers have it.
UNKNOWN_PENALTY = 10.0


class Automaton(NamedTuple):
    """Aho-Corasick over the bytes of all pieces.

    go: next state by state and byte. size: bytes of the piece that ends in a state (0: none); score: its score.
    report: the state itself if a piece ends in it, else the longest suffix state where one does (0: none);
    shorter: the same among the state's proper suffixes. whole: no piece has a blank mark behind another
    character, so that texts can be cut before every run of marks.
    """

    go: np.ndarray
    size: np.ndarray
    score: np.ndarray
    report: np.ndarray
    shorter: np.ndarray
    unknown: float
    whole: bool


def automaton(vocabulary: list[tuple[str, float]]) -> Automaton:
    """Of pieces and scores; of equal pieces the last counts, empty ones don't."""
    pieces = {p.encode(): s for p, s in vocabulary if p}
    children: list[dict[int, int]] = [{}]
    size, score = [0], [0.0]
    for piece, value in pieces.items():
        state = 0
        for byte in piece:
            if byte not in children[state]:
                children[state][byte] = len(children)
                children.append({})
                size.append(0)
                score.append(0.0)
            state = children[state][byte]
        size[state], score[state] = len(piece), value
    go = np.zeros((len(children), 256), np.int32)
    fail, shorter = np.zeros(len(children), np.int32), np.zeros(len(children), np.int32)
    queue = deque()
    for byte, child in children[0].items():
        go[0, byte] = child
        queue.append(child)
    while queue:
        state = queue.popleft()
        back = fail[state]
        shorter[state] = back if size[back] else shorter[back]
        go[state] = go[back]
        for byte, child in children[state].items():
            fail[child] = go[back, byte]
            go[state, byte] = child
            queue.append(child)
    sizes = np.array(size, np.int32)
    report = np.where(sizes > 0, np.arange(len(sizes)), shorter).astype(np.int32)
    whole = not any(MARK in p.lstrip(MARK) for p, _ in vocabulary)
    return Automaton(go, sizes, np.array(score), report, shorter, min(s for _, s in vocabulary) - UNKNOWN_PENALTY, whole)


@lru_cache(maxsize=2)
def automaton_of_file(path: str) -> Automaton:
    """Of a sentencepiece model's pieces and scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return automaton([(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())])


def best_counts(auto: Automaton, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Pieces of the best segmentation of every part of the data (UTF-8), all parts at once, byte by byte.

    best[i] is the best score of the first i bytes and count[i] its pieces. Pieces that end at i are tried from the
    longest, that is from the earliest start, and last the unknown character; only a better score replaces
    what is there. An unknown character counts as one piece per byte.
    """
    out = np.zeros(len(starts), np.int64)
    order = np.argsort(starts - ends, kind="stable")
    starts, sizes = starts[order], (ends - starts)[order]
    longest = int(sizes.max(initial=0))
    best = np.full((longest + 1, len(starts)), -np.inf)
    count = np.zeros((longest + 1, len(starts)), np.int64)
    best[0], state = 0.0, np.zeros(len(starts), np.int32)
    begun = np.zeros(len(starts), np.int64)  # where the present character begins
    for i in range(longest):
        live = int(np.searchsorted(-sizes, -i, "left"))  # parts longer than i come first
        byte = data[starts[:live] + i]
        begun[:live] = np.where((byte & 0xC0) != 0x80, i, begun[:live])
        state = auto.go[state[:live], byte]
        last = starts[:live] + i + 1
        closes = (i + 1 == sizes[:live]) | ((data[np.minimum(last, len(data) - 1)] & 0xC0) != 0x80)
        found = auto.report[state]
        here, known = np.arange(live), np.zeros(live, bool)
        while True:
            some = found[here] > 0
            here = here[some]
            if not len(here):
                break
            piece = found[here]
            size = auto.size[piece]
            value = best[i + 1 - size, here] + auto.score[piece]
            known[here] |= i + 1 - size == begun[here]
            better = value > best[i + 1, here]
            won = here[better]
            best[i + 1, won] = value[better]
            count[i + 1, won] = count[i + 1 - size[better], won] + 1
            found[here] = auto.shorter[piece]
        here = np.flatnonzero(closes & ~known)
        value = best[begun[here], here] + auto.unknown
        better = value > best[i + 1, here]
        won = here[better]
        best[i + 1, won] = value[better]
        count[i + 1, won] = count[begun[won], won] + i + 1 - begun[won]
    out[order] = count[sizes, np.arange(len(sizes))]
    return out


def best_count(auto: Automaton, text: bytes) -> int:
    """The same for one long part, in memory for its bytes only."""
    best, count, state, begun = [0.0], [0], 0, 0
    go, sizes, scores, report, shorter = auto.go, auto.size, auto.score, auto.report, auto.shorter
    for i, byte in enumerate(text):
        if byte & 0xC0 != 0x80:
            begun = i
        state = go[state, byte]
        top, pieces, found, known = -np.inf, 0, report[state], False
        while found:
            start = i + 1 - int(sizes[found])
            known |= start == begun
            if (value := best[start] + scores[found]) > top:
                top, pieces = value, count[start] + 1
            found = shorter[found]
        if not known and (i + 1 == len(text) or text[i + 1] & 0xC0 != 0x80) and (value := best[begun] + auto.unknown) > top:
            top, pieces = value, count[begun] + i + 1 - begun
        best.append(top)
        count.append(pieces)
    return count[-1]


def counts(auto: Automaton, texts: list[str | None], long: int = 64) -> np.ndarray:
    """Token counts of texts; equal parts of a call are segmented once."""
    column = pa.array([(MARK + t.replace(" ", MARK)) if t else "" for t in texts], pa.string())
    data, offsets = arrays.text_buffer(column)
    begins = np.zeros(len(data) + 1, bool)
    if auto.whole and len(data):
        at = np.flatnonzero(data[:-2] == MARK_BYTES[0])
        at = at[(data[at + 1] == MARK_BYTES[1]) & (data[at + 2] == MARK_BYTES[2])]
        begins[at] = True
        after = np.zeros(len(data) + 1, bool)
        after[at + 3] = True
        begins &= ~after
    begins[offsets] = True
    begins[-1] = False
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(data))
    short = ends - starts <= long
    number = np.zeros(len(starts), np.int64)
    if short.any():
        hashes = arrays.word_hashes(data, starts[short], ends[short])
        _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        number[short] = best_counts(auto, data, starts[short][first], ends[short][first])[back]
    for i in np.flatnonzero(~short):
        number[i] = best_count(auto, data[starts[i] : ends[i]].tobytes())
    total = np.concatenate([[0], np.cumsum(number)])
    return np.diff(total[np.searchsorted(starts, offsets)])


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The number of unigram tokens of every whole text.

    docs: doc_id, text. path: a sentencepiece model whose pieces and scores are taken as a unigram vocabulary (the 32k
    vocabulary where None). A text gets a blank mark before it and for every blank; its tokens are the segmentation
    with the best sum of scores. Ties go to the earliest start of the last piece; a character that no piece
    covers scores 10 less than the worst piece and counts as one token per byte. Returns, per row, doc_id, n_bytes and n_tokens.

    Scores are added as 64-bit floats, from the last cut before a blank mark on: exact for whole-number scores. Null
    or empty text: 0 and 0. Null ids and repeated rows are rows of their own. Other columns are ignored; an empty
    table gives an empty table.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton_of_file(path)
        for batch in batches:
            for chunk in arrays.chunks(batch, "text"):
                number = counts(auto, chunk.column("text").to_pylist())
                sizes = np.diff(arrays.text_buffer(chunk.column("text"))[1])
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(number, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
