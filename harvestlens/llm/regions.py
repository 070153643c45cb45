"""Places in documents that can hold repeated windows, brought together by shared anchors.

Documents are sequences of symbols (bytes, or hashed words). A window is `length` symbols. In
every window the `gram`-symbol runs with the smallest hash are anchors, so equal windows share an
anchor at the same place. Around each anchor lies a region: all windows that hold it. Regions are
grouped by their anchor; equal regions of a group collapse to the earliest one, groups of a single
region need no index, and what is left goes, group by group, to the caller's index, which finds
equal windows.

Two things decide that windows are equal. Regions whose 64-bit hash and whose anchor's 64-bit hash are
equal count as equal: all but the earliest are repeats, and no index looks at them. That holds for exact copies of
documents and, within a task, before any shuffle. Windows of regions that differ are compared by the index.

A group of more than `most` different regions (a passage that a large part of the documents
shares, each time between other words) is split by halves of the window starts: all windows of a
half have a longer run in common, which takes the anchor's place. At the last split it is the
window itself, so the number of rounds is bounded by log2(length). Equal parts of a split are told by
two 64-bit hashes too; where a split goes down to the window, hashes alone decide for that window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestlens.llm import arrays
from harvestlens.session import write_and_read

LAST = 2**63 - 1
PLACE = "doc long, v long"
OCCURRENCE = f"key long, hash long, {PLACE}, pos long, stop long"
REGION = f"key long, hash long, {PLACE}, start long, at int, low int, high int, region binary"
SPAN = f"{PLACE}, start long, stop long"


class Windows(NamedTuple):
    """Symbols of a window, of an anchor, and different regions of a group that one index may hold."""

    length: int
    gram: int
    most: int

    @property
    def reach(self) -> int:
        return self.length - self.gram


def identified(docs: DataFrame, keep: list[str] = []) -> tuple[DataFrame, DataFrame]:
    """doc, v, text of all rows, and of different rows: the id (null last of all) and what tells rows of one id apart.

    v is 0 while ids are whole, and else a hash of the text: rows that share id and text are one document.
    The first also has the columns `keep`.
    """
    spare = docs.select("doc_id").groupBy("doc_id").count().filter("count > 1 or doc_id is null")
    once = spare.isEmpty()
    rows = docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), (F.lit(0).cast("long") if once else F.xxhash64("text")).alias("v"), "text", *keep)
    own = rows.select("doc", "v", "text") if keep else rows
    return rows, own if once else own.dropDuplicates(["doc", "v"])


def applied(docs: DataFrame, windows: Windows, symbols: Callable, dtype, find: Callable, apply: Callable, returns: str, kinds: list[pa.DataType]) -> DataFrame:
    """Per row of docs: doc_id and what `apply(text, starts, stops)` makes of its text and its merged repeated spans.

    apply takes lists of bytes and of arrays for some rows and gives a list of tuples, as `returns` says to Spark and `kinds` to Arrow:
    all batches of a task must be of one schema, and from rows that are all without a span Arrow would tell none for the spans.
    """
    rows, different = identified(docs)
    bodies, spans = repeated(different, windows, symbols, dtype, find)
    names = [c.split()[0] for c in returns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 500):
                part = batch.slice(row, 500)
                bodies = [unpacked(b) for b in part.column("body").to_pylist()]
                cut = [arrays.merged(np.array(a or [], np.int64), np.array(b or [], np.int64)) for a, b in zip(part.column("starts").to_pylist(), part.column("stops").to_pylist(), strict=True)]
                out = zip(*apply(bodies, cut), strict=True)
                yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("v"), *(pa.array(x, kind) for x, kind in zip(out, kinds, strict=True))], ["doc", "v", *names])

    done = bodies.join(spans, ["doc", "v"], "left").mapInArrow(run, f"{PLACE}, {returns}")
    if rows is not different:
        done = rows.select("doc", "v").join(done, ["doc", "v"])
    return done.select(F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"), *names)


def packed(docs: DataFrame) -> DataFrame:
    """doc, v, body: the text compressed for the shuffles; repeated rows once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for chunk in arrays.chunks(batch, "text", arrays.SMALL):
                body = [press.compress((t or "").encode()) for t in chunk.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([chunk.column("doc"), chunk.column("v"), pa.array(body, pa.binary())], ["doc", "v", "body"])

    return docs.mapInArrow(run, f"{PLACE}, body binary")


def unpacked(body: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(body)


def anchors(symbols: np.ndarray, windows: Windows) -> tuple[np.ndarray, ...]:
    """Positions of the anchors, their hashes and the hashes of their regions."""
    if len(symbols) < windows.length:
        none = np.zeros(0, np.uint64)
        return none.astype(np.int64), none, none
    hashes, wide = arrays.rolling(symbols, windows.gram), windows.reach + 1
    least = arrays.sliding(hashes, wide)
    edge = np.zeros(windows.reach, np.uint64)
    pos = np.flatnonzero(arrays.sliding(np.concatenate([edge, least, edge]), wide, np.maximum) == hashes)
    edge = np.zeros(windows.reach, np.uint64)
    around = np.concatenate([edge, arrays.mix(symbols.astype(np.uint64) + np.uint64(7)), edge])
    return pos, hashes[pos], arrays.rolling(around, windows.length + windows.reach)[pos]


def occurrences(docs: DataFrame, windows: Windows, symbols: Callable, batch_anchors: int = 500_000) -> DataFrame:
    """A row per anchor; those whose region a task has seen earlier in order become spans at once (key 0, pos to stop)."""
    schema = pa.schema([(c, pa.int64()) for c in ("key", "hash", "doc", "v", "pos", "stop")])

    def combined(parts: list) -> pa.RecordBatch:
        key, region, pos = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 2))
        doc, v = (np.repeat([p[i] for p in parts], [len(p[2]) for p in parts]) for i in (3, 4))
        order = np.lexsort((pos, v, doc, region, key))
        same = np.concatenate([[False], (key[order][1:] == key[order][:-1]) & (region[order][1:] == region[order][:-1])])
        later, kept = order[same], order[~same]
        out = {"key": [key[kept].view(np.int64)], "hash": [region[kept].view(np.int64)], "doc": [doc[kept]], "v": [v[kept]], "pos": [pos[kept]], "stop": [np.full(len(kept), -1)]}
        later = later[np.lexsort((pos[later], v[later], doc[later]))]
        cuts = np.flatnonzero((np.diff(doc[later]) != 0) | (np.diff(v[later]) != 0)) + 1
        for part in np.split(later, cuts) if len(later) else []:
            start, stop = arrays.merged(pos[part] - windows.reach, pos[part] + windows.length)
            n = len(start)
            for c, x in (("key", arrays.mix(start.astype(np.uint64) + np.uint64(doc[part[0]] % 2**40 << 20)).view(np.int64)), ("hash", np.zeros(n, np.int64)), ("doc", np.full(n, doc[part[0]])), ("v", np.full(n, v[part[0]])), ("pos", start), ("stop", stop)):
                out[c].append(x)
        return arrays.table_of({c: np.concatenate(x) for c, x in out.items()}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, count = [], 0
        for batch in batches:
            for chunk in arrays.chunks(batch, "text"):
                ids = zip(chunk.column("doc").to_pylist(), chunk.column("v").to_pylist(), strict=True)
                for (doc, v), own in zip(ids, symbols(chunk.column("text")), strict=True):
                    pos, key, region = anchors(own, windows)
                    if len(pos):
                        parts.append((key, region, pos, doc, v))
                        count += len(pos)
                if count >= batch_anchors:
                    yield combined(parts)
                    parts, count = [], 0
        if parts:
            yield combined(parts)

    return docs.mapInArrow(run, OCCURRENCE)


def grouped(rows: DataFrame) -> DataFrame:
    """Adds rn, the place among equal regions of a group, and n, the number of different regions of the group."""
    return rows.repartition("key").withColumn(
        "rn", F.row_number().over(Window.partitionBy("key", "hash").orderBy("doc", "v", "pos"))
    ).withColumn("n", F.sum((F.col("rn") == 1).cast("int")).over(Window.partitionBy("key")))


def ranked(rows: DataFrame) -> DataFrame:
    """The same as `grouped` (rn is 1 or 2) for few rows in large groups: by aggregates and joins, so no group meets in one task."""
    place = F.struct("doc", "v", "pos")
    firsts = rows.groupBy("key", "hash").agg(F.min(place).alias("first"))
    sizes = firsts.groupBy("key").agg(F.count("*").alias("n"))
    joined = rows.join(firsts, ["key", "hash"]).join(sizes, "key")
    return joined.withColumn("rn", F.when(place == F.col("first"), 1).otherwise(2)).drop("first")


def regions(marks: DataFrame, bodies: DataFrame, windows: Windows, symbols: Callable) -> DataFrame:
    """The symbols of the regions to index, with n; one row per document joins its text."""
    wanted = marks.filter("stop = -1 and rn = 1 and n > 1").groupBy("doc", "v").agg(F.collect_list(F.struct("key", "hash", "pos", "n")).alias("wanted"))
    schema = pa.schema([("key", pa.int64()), ("hash", pa.int64()), ("doc", pa.int64()), ("v", pa.int64()), ("start", pa.int64()), ("at", pa.int32()), ("low", pa.int32()), ("high", pa.int32()), ("region", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 500):
                out = {f.name: [] for f in schema}
                part = batch.slice(row, 500)
                texts = pa.array([unpacked(b) for b in part.column("body").to_pylist()], pa.large_binary())
                for own, doc, v, marked in zip(symbols(texts), part.column("doc").to_pylist(), part.column("v").to_pylist(), part.column("wanted").to_pylist(), strict=True):
                    for m in marked:
                        start = max(0, m["pos"] - windows.reach)
                        region = own[start : m["pos"] + windows.length].tobytes()
                        for c, x in zip(schema.names, (m["key"], m["hash"], doc, v, start, m["pos"] - start, -windows.reach, 0, region, m["n"]), strict=True):
                            out[c].append(x)
                yield arrays.table_of(out, schema)

    joined = bodies.join(wanted, ["doc", "v"])
    return joined.mapInArrow(run, f"{REGION}, n long")


def halves(hot: DataFrame, windows: Windows, width: int) -> DataFrame:
    """Each region twice, for the lower and the upper half of its window starts; keys hold what all windows of a half share."""

    def hash_of(*parts: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(b"".join(parts), digest_size=8).digest(), "little", signed=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                middle = (r["low"] + r["high"] + 1) // 2
                size = len(r["region"]) // width
                for low, high in ((r["low"], middle - 1), (middle, r["high"])):
                    first, last = max(low, -r["at"]), min(high, size - r["at"] - windows.length)
                    if low > high or first > last:
                        continue
                    cut = lambda a, b, r=r: r["region"][(r["at"] + a) * width : (r["at"] + b) * width]
                    core, region = cut(high, low + windows.length), cut(first, last + windows.length)
                    out.append({"key": hash_of(r["key"].to_bytes(8, "little", signed=True), bytes([low == r["low"]] * 8), core), "hash": hash_of(region, len(region).to_bytes(8, "little")), "doc": r["doc"], "v": r["v"], "start": r["start"] + r["at"] + first, "at": -first, "low": low, "high": high, "region": region})
            schema = schema or pa.schema([(f.name, f.type) for f in batch.schema if f.name in REGION_NAMES])
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return hot.select(*REGION_NAMES).mapInArrow(run, REGION)


REGION_NAMES = [c.split()[0] for c in REGION.split(", ")]


def indexed(groups: DataFrame, windows: Windows, dtype, find: Callable, batch_symbols: int = 60_000) -> DataFrame:
    """Spans of windows that an earlier window of their group equals: `find(texts, values, windows)` per some groups."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc", "v", "start", "stop")])

    def found(rows: list) -> pa.RecordBatch:
        texts = [np.frombuffer(r[3], dtype) for r in rows]
        docs = np.unique(np.array([(r[0], r[1]) for r in rows], np.int64), axis=0, return_inverse=True)[1].reshape(-1)
        values = docs.astype(np.int64) << 40
        values += np.array([r[2] for r in rows], np.int64)
        row, start, stop = find(texts, values, windows)
        doc, v, base = (np.array([r[i] for r in rows], np.int64) for i in range(3))
        return arrays.table_of({"doc": doc[row], "v": v[row], "start": base[row] + start, "stop": base[row] + stop}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, symbols, last = [], 0, None
        size = np.dtype(dtype).itemsize
        for batch in batches:
            for key, doc, v, start, region in zip(*(batch.column(c).to_pylist() for c in ("key", "doc", "v", "start", "region")), strict=True):
                if key != last and symbols >= batch_symbols:
                    yield found(rows)
                    rows, symbols = [], 0
                rows.append((doc, v, start, region))
                symbols, last = symbols + len(region) // size, key
        if rows:
            yield found(rows)

    ordered = groups.select("key", "doc", "v", "start", "region").repartition("key").sortWithinPartitions("key", "doc", "v", "start")
    return ordered.mapInArrow(run, SPAN)


def repeated(docs: DataFrame, windows: Windows, symbols: Callable, dtype, find: Callable) -> tuple[DataFrame, DataFrame]:
    """Texts (doc, v, body) and, per document, the spans of windows that start earlier too, as lists of start and stop.

    docs: doc, v, text of `identified`. symbols: from a text column to an array of `dtype` per row.
    """
    name, width = f"repeats-{windows.length}", np.dtype(dtype).itemsize
    bodies = packed(docs)
    marks = write_and_read(grouped(occurrences(docs, windows, symbols)).filter("stop <> -1 or rn > 1 or n > 1"), name)
    shares = write_and_read(regions(marks, bodies, windows, symbols), name)
    small, hot, spans = shares.filter(F.col("n") <= windows.most), shares.filter(F.col("n") > windows.most), []
    while not hot.isEmpty():
        halved = write_and_read(halves(hot, windows, width).withColumn("pos", F.col("start")), name)
        split = write_and_read(ranked(halved).filter("rn > 1 or n > 1"), name)
        spans.append(split.filter("rn > 1").select("doc", "v", "start", (F.col("start") + (F.length("region") / width).cast("long")).alias("stop")))
        firsts = split.filter("rn = 1 and n > 1").select(*small.columns)
        small, hot = small.unionByName(firsts.filter(F.col("n") <= windows.most)), firsts.filter(F.col("n") > windows.most)
    spans.append(indexed(small, windows, dtype, find))
    spans.append(marks.filter("stop <> -1 or rn > 1").select(
        "doc", "v", F.when(F.col("stop") != -1, F.col("pos")).otherwise(F.col("pos") - windows.reach).alias("start"),
        F.when(F.col("stop") != -1, F.col("stop")).otherwise(F.col("pos") + windows.length).alias("stop"),
    ))
    every = spans[0]
    for more in spans[1:]:
        every = every.unionByName(more)
    return bodies, every.groupBy("doc", "v").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))


def flat_windows(texts: list[np.ndarray], values: np.ndarray, windows: Windows) -> tuple[np.ndarray, ...]:
    """Of all windows of some texts: text, place in it, and value (the order of documents and places)."""
    counts = np.array([max(0, len(t) - windows.length + 1) for t in texts])
    row = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    return row, place, values[row] + place


def runs_of(row: np.ndarray, place: np.ndarray, hit: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Text, start and stop of the runs of neighbouring windows that are hit."""
    row, place = row[hit], place[hit]
    if not len(row):
        return row, place, place
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)])
    return row[new], place[new], place[np.concatenate([new[1:], [True]])] + length
