"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestlens.llm import arrays

UNDETERMINED = "und"


class Training(NamedTuple):
    """Documents a language may give, characters taken of each, bytes of a sequence, units a direction, and steps of the fit."""

    documents: int = 250
    characters: int = 260
    steps: int = 64
    units: int = 8
    epochs: int = 12
    batch: int = 128
    rate: float = 0.02
    seed: int = 5


class Network(NamedTuple):
    """Per direction (forwards, backwards): input table (256, 3H), recurrent weights (H, 3H), output weights (H, C); then the output bias."""

    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    outputs: list[np.ndarray]
    bias: np.ndarray

    @property
    def parts(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, *self.outputs, self.bias]


def network(units: int, classes: int, seed: int) -> Network:
    """Random weights."""
    draw = np.random.Generator(np.random.PCG64(seed)).standard_normal
    scaled = lambda *shape: [(draw(shape) / np.sqrt(units)).astype(np.float32) for _ in range(2)]
    return Network(scaled(256, 3 * units), scaled(units, 3 * units), scaled(units, classes), np.zeros(classes, np.float32))


def states(x: np.ndarray, there: np.ndarray, inputs: np.ndarray, recurrent: np.ndarray, order: range, trace: list | None = None) -> np.ndarray:
    """Hidden states (T, B, H) of one direction; `there` is 1 where a byte is and 0 at padding, where the state stays 0."""
    units = recurrent.shape[0]
    half, two = np.float32(0.5), slice(None, 2 * units)
    gates_in, gates_back = np.ascontiguousarray(inputs[:, two]) * half, np.ascontiguousarray(recurrent[:, two]) * half
    new_in, new_back = np.ascontiguousarray(inputs[:, 2 * units :]), np.ascontiguousarray(recurrent[:, 2 * units :])
    h, out = np.zeros((x.shape[1], units), recurrent.dtype), np.empty((*x.shape, units), recurrent.dtype)
    whole = there.all(axis=1)
    for t in order:
        gates = gates_in.take(x[t], axis=0)
        gates += h @ gates_back
        np.tanh(gates, out=gates)  # a sigmoid is half a hyperbolic tangent of half the value, and a half
        gates += 1
        gates *= half
        keep, reset, back = gates[:, :units], gates[:, units:], h @ new_back
        new = reset * back
        new += new_in.take(x[t], axis=0)
        np.tanh(new, out=new)
        if trace is not None:
            trace.append((t, h, keep, reset, new, back))
        h = h - new
        h *= keep
        h += new
        if not whole[t]:
            h *= there[t][:, None]
        out[t] = h
    return out


def probabilities(net: Network, x: np.ndarray, there: np.ndarray, traces: list | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Class probabilities (T, B, C) of every position, and the states of both directions."""
    orders = (range(len(x)), range(len(x) - 1, -1, -1))
    hidden = [states(x, there, net.inputs[d], net.recurrent[d], orders[d], traces and traces[d]) for d in (0, 1)]
    logits = hidden[0] @ net.outputs[0] + hidden[1] @ net.outputs[1] + net.bias
    logits = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return logits / logits.sum(axis=-1, keepdims=True), hidden


def gradients(net: Network, x: np.ndarray, there: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all positions, and its gradient by backpropagation through time."""
    traces = _Traces()
    prob, hidden = probabilities(net, x, there, traces)
    total, rows = float(there.sum()), np.arange(x.shape[1])
    loss = -float((np.log(prob[:, rows, label] + 1e-12) * there).sum()) / total
    prob[:, rows, label] -= 1
    out = prob * (there[:, :, None] / total).astype(prob.dtype)
    inputs, recurrent, outputs = [], [], []
    for d in (0, 1):
        units = net.recurrent[d].shape[0]
        above = out @ net.outputs[d].T
        outputs.append(np.einsum("tbh,tbc->hc", hidden[d], out))
        table, weights, carried = np.zeros_like(net.inputs[d]), np.zeros_like(net.recurrent[d]), 0.0
        for t, h, keep, reset, new, back in reversed(traces[d]):
            now = (above[t] + carried) * there[t][:, None]
            d_new = now * (1 - keep) * (1 - new * new)
            d_keep = now * (h - new) * keep * (1 - keep)
            d_reset = d_new * back * reset * (1 - reset)
            np.add.at(table, x[t], np.concatenate([d_keep, d_reset, d_new], 1))
            inner = np.concatenate([d_keep, d_reset, d_new * reset], 1)
            weights += h.T @ inner
            carried = now * keep + inner @ net.recurrent[d].T
        inputs.append(table)
        recurrent.append(weights)
    return loss, [*inputs, *recurrent, *outputs, out.sum(axis=(0, 1))]


class _Traces(list):
    """One list per direction; true although they begin empty."""

    def __init__(self):
        super().__init__([[], []])


def trained(texts: list[bytes], labels: np.ndarray, classes: int, how: Training) -> Network:
    """Fit by Adam on sequences of `how.steps` bytes cut from the texts."""
    pieces = [(t[a : a + how.steps], y) for t, y in zip(texts, labels, strict=True) for a in range(0, len(t), how.steps)]
    x, there = np.zeros((how.steps, len(pieces)), np.uint8), np.zeros((how.steps, len(pieces)), np.float32)
    for i, (piece, _) in enumerate(pieces):
        x[: len(piece), i], there[: len(piece), i] = np.frombuffer(piece, np.uint8), 1
    y, net = np.array([p[1] for p in pieces]), network(how.units, classes, how.seed)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parts]
    shuffle, step = np.random.Generator(np.random.PCG64(how.seed)), 0
    for epoch in range(how.epochs):
        rate = how.rate * (1 - epoch / how.epochs)
        order = shuffle.permutation(len(pieces))
        for at in range(0, len(order), how.batch):
            part, step = order[at : at + how.batch], step + 1
            _, grads = gradients(net, x[:, part], there[:, part], y[part])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            for p, g, (m, v) in zip(net.parts, grads, moments, strict=True):
                g = g / max(1.0, norm)
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(p.dtype)
    return net


def pooled(net: Network, data: np.ndarray, offsets: np.ndarray, steps: int, tile: int = 1024) -> np.ndarray:
    """Mean class probabilities over all bytes of every row (0 for empty rows); texts are read whole, in sequences of `steps` bytes."""
    sizes = np.diff(offsets)
    counts = -(-sizes // steps)
    row = np.repeat(np.arange(len(sizes)), counts)
    begin = offsets[row] + steps * (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts))
    length = np.minimum(steps, offsets[row + 1] - begin)
    out = np.zeros((len(sizes), len(net.bias)))
    for at in range(0, len(row), tile):
        places = begin[at : at + tile] + np.arange(steps)[:, None]
        there = (np.arange(steps)[:, None] < length[at : at + tile]).astype(np.float32)
        prob, _ = probabilities(net, data[np.minimum(places, len(data) - 1)], there)
        np.add.at(out, row[at : at + tile], (prob * there[:, :, None]).sum(axis=0, dtype=np.float64))
    return out / np.maximum(sizes, 1)[:, None]


def held_out(docs: DataFrame) -> DataFrame:
    """Adds held_out: crc32 of the id's text mod 4 is 2 (false for a null id)."""
    return docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)))


def fitted(docs: DataFrame, how: Training = Training()) -> tuple[list[str], Network | None]:
    """The languages and the network learned from rows with text, lang and id that are not held out.

    A bounded sample is read: `how.documents` documents a language (those whose id has the smallest hash) and
    `how.characters` characters from a place of each that its id's hash chooses.
    """
    rows = held_out(docs.select("doc_id", "text", "lang")).filter("not held_out and doc_id is not null and lang is not null").filter(F.col("text").rlike(r"\p{L}"))
    hashed = rows.select("lang", "text", "doc_id", F.xxhash64("doc_id").alias("h"))
    first = F.pmod(F.col("h"), F.greatest(F.lit(1), F.length("text") - how.characters)).cast("int") + 1
    pieces = hashed.select("lang", "h", "doc_id", F.substring("text", first, F.lit(how.characters)).alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id", "text"))
    sample = pieces.withColumn("place", place).filter(F.col("place") <= how.documents).select("lang", "place", "text").orderBy("lang", "place").collect()
    if not sample:
        return [], None
    languages = sorted({r.lang for r in sample})
    labels = np.array([languages.index(r.lang) for r in sample])
    return languages, trained([r.text.encode() for r in sample], labels, len(languages), how)


def identify_language(docs: DataFrame, how: Training = Training(), keep: list[str] = []) -> DataFrame:
    """The language of every whole text, learned from the labelled rows that are not held out.

    docs: doc_id, text, lang. Returns, per row, doc_id, held_out, lang_pred, score and the columns `keep`. Every byte is labelled from the
    states of both directions; a document's probabilities are the mean over all its bytes, lang_pred is the most
    probable language (ties: the first by name) and score its probability.

    Text that is null or has no letter gets `und` and 0, and so does every row where nothing can be learned. Rows with
    a null id are predicted, never learned from, and not held out. Other columns are ignored; repeated rows are
    rows of their own; an empty table gives an empty table.
    """
    languages, net = fitted(docs, how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in arrays.chunks(batch, "text"):
                letters = np.array(chunk.column("letters").to_pylist(), bool) & (net is not None)
                names, scores = [UNDETERMINED] * len(letters), np.zeros(len(letters))
                if letters.any():
                    prob = pooled(net, *arrays.text_buffer(chunk.column("text")), how.steps)
                    scores = np.where(letters, np.clip(prob.max(axis=1), 0, 1), 0)
                    names = [languages[i] if ok else UNDETERMINED for i, ok in zip(prob.argmax(axis=1), letters, strict=True)]
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), chunk.column("held_out"), pa.array(names, pa.string()), pa.array(scores), *(chunk.column(c) for c in keep)], ["doc_id", "held_out", "lang_pred", "score", *keep])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = held_out(docs.select("doc_id", "text", *(c for c in keep if c != "text")))
    rows = rows.select(F.col("doc_id").cast("long"), "held_out", "text", letters.alias("letters"), *(c for c in keep if c != "text"))
    return rows.mapInArrow(run, arrays.schema_with("doc_id long, held_out boolean, lang_pred string, score double", docs, keep))
