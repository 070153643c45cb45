"""Token ids of documents in binary files, reached by key through minimal perfect hash indexes.

Layout below the root of a store:

* `ids/<shard>-<attempt>.ids`: the ids of neighbouring documents one after another, nothing else, as little-endian
  unsigned integers of 2 or 4 bytes. Shards follow the order of doc_id.
* `index/<part>-<attempt>.mph`: an index over the keys of one part; parts are dealt by a hash of the key.
* `shards`, `parts`, `keys`: Parquet tables that name the files of the task attempts that counted, and all keys.

Files are written and read by tasks, through the file system that the root's address names, and a task that runs again
writes files of its own, so a lost executor leaves at most a file that no table names.
"""

from __future__ import annotations

import json
import os
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harvestlens.llm import arrays
from harvestlens.session import passing_tables, scratch_path

KEY = ["known", "id", "copy"]
#: What an index holds for a key: its fingerprint, the shard, its first id there, and how many ids it has.
SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("at", "<u8"), ("n", "<u8")])
#: Bits of a level for each key that reaches it, and the levels before the keys left over are listed.
ROOM, LEVELS = 2, 32


class Store(NamedTuple):
    """A root folder, the bytes of an id in its files, and the number of index parts."""

    root: str
    width: int
    n_parts: int

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.root}/{name}")


# -- files ----------------------------------------------------------------------------------


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address and the path in it."""
    return fs.FileSystem.from_uri(root)


def new_file(root: str, folder: str, number: int) -> tuple[str, pa.NativeFile]:
    """The name below the root of a file of this attempt's own, and the file to write to."""
    system, path = opened(root)
    name = f"{folder}/{number:08d}-{uuid.uuid4().hex}"
    system.create_dir(f"{path}/{folder}", recursive=True)
    return name, system.open_output_stream(f"{path}/{name}")


# -- minimal perfect hash -------------------------------------------------------------------


def key_hashes(known: np.ndarray, ids: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each key."""
    first = arrays.mix(ids.astype(np.int64).view(np.uint64) + known.astype(np.uint64) * arrays.STEP)
    return arrays.mix(first + copies.astype(np.uint64))


def level_bits(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    return (arrays.mix(hashes ^ arrays.mix(np.full(1, level + 1, np.uint64))) % np.uint64(size)).astype(np.int64)


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (arrays.mix(hashes + arrays.STEP) >> np.uint64(32)).astype(np.uint32)


class PerfectHash(NamedTuple):
    """Sizes of the levels, all their bits, the set bits before every 512, and the hashes of keys that no level holds, sorted.

    On each level a key has a bit; keys that share theirs go on to the next level. A key's slot is the number of
    set bits before its own, so n keys have the slots 0 to n-1.
    """

    sizes: np.ndarray
    bits: np.ndarray
    before: np.ndarray
    rest: np.ndarray


def perfect_hash(hashes: np.ndarray) -> PerfectHash:
    """Of distinct hashes."""
    sizes, levels = [], []
    while len(hashes) and len(sizes) < LEVELS:
        size = ROOM * len(hashes) + 1
        at = level_bits(hashes, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        levels.append(alone)
        hashes = hashes[~alone[at]]
    bits = np.concatenate([*levels, np.zeros(0, bool)])
    bits = np.concatenate([bits, np.zeros(-len(bits) % 512, bool)])
    counts = bits.reshape(-1, 512).sum(axis=1)
    before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    return PerfectHash(np.array(sizes, np.int64), np.packbits(bits, bitorder="little"), before, np.sort(hashes))


def slots(index: PerfectHash, hashes: np.ndarray) -> np.ndarray:
    """The slot of each key of the index; of another key some slot, or -1."""
    out, open_, base = np.full(len(hashes), -1), np.arange(len(hashes)), 0
    for level, size in enumerate(index.sizes.tolist()):
        at = base + level_bits(hashes[open_], level, size)
        hit = (index.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        own, word = at[hit], at[hit] >> 9
        block = index.bits.reshape(-1, 64)[word]
        inside = np.unpackbits(block, axis=1, bitorder="little") & (np.arange(512) < (own & 511)[:, None])
        out[open_[hit]] = index.before[word] + inside.sum(axis=1)
        open_, base = open_[~hit], base + size
    place = np.searchsorted(index.rest, hashes[open_])
    there = place < len(index.rest)
    there[there] = index.rest[place[there]] == hashes[open_][there]
    out[open_[there]] = index.before[-1] + place[there]
    return out


def write_index(root: str, part: int, keys: tuple[np.ndarray, ...], rows: np.ndarray) -> str:
    """Write the index of a part's distinct keys and what is held for them; returns the file's name."""
    hashes = key_hashes(*keys)
    if len(np.unique(hashes)) < len(hashes):
        raise ValueError("two keys of a part share a 64-bit hash")
    index = perfect_hash(hashes)
    table = np.empty(len(rows), SLOT)
    rows["fingerprint"] = fingerprints(hashes)
    table[slots(index, hashes)] = rows
    head = json.dumps({"keys": len(rows), **{c: len(x) for c, x in index._asdict().items()}}).encode()
    name, file = new_file(root, "index", part)
    with file:
        file.write(np.array([len(head)], "<u8").tobytes() + head)
        for x in (*index, table):
            file.write(x.tobytes())
    return name


def read_index(root: str, name: str) -> tuple[PerfectHash, pa.NativeFile, int, int]:
    """A part's hash, the file, where its slots begin, and how many there are."""
    system, path = opened(root)
    file = system.open_input_file(f"{path}/{name}")
    head = json.loads(file.read_at(size := int(np.frombuffer(file.read_at(8, 0), "<u8")[0]), 8))
    at, found = 8 + size, []
    for c, kind in (("sizes", "<i8"), ("bits", "u1"), ("before", "<i8"), ("rest", "<u8")):
        n = head[c] * np.dtype(kind).itemsize
        found.append(np.frombuffer(file.read_at(n, at), kind))
        at += n
    return PerfectHash(*found), file, at, head["keys"]


def held(root: str, name: str, keys: tuple[np.ndarray, ...], few: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Whether the index holds each key (by its fingerprint), and what it holds; a few keys are read slot by slot."""
    index, file, begin, n = read_index(root, name)
    with file:
        hashes = key_hashes(*keys)
        slot = slots(index, hashes) if n else np.full(len(hashes), -1)
        if len(slot) <= few:
            parts = [file.read_at(SLOT.itemsize, begin + s * SLOT.itemsize) if s >= 0 else bytes(SLOT.itemsize) for s in slot.tolist()]
            rows = np.frombuffer(b"".join(parts), SLOT)
        else:
            rows = np.frombuffer(file.read_at(n * SLOT.itemsize, begin), SLOT)[np.maximum(slot, 0)] if n else np.zeros(len(slot), SLOT)
    return (slot >= 0) & (rows["fingerprint"] == fingerprints(hashes)), rows


# -- token ids ------------------------------------------------------------------------------


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


#: A part of a text on its own between two others, so that many parts are encoded in one call.
BETWEEN = "\x01"


class WordIds:
    """Ids of texts, by a tokenizer that cuts at ASCII white space and drops it.

    Such a tokenizer gives a text the ids of its parts between white space one after another, so each different part is
    encoded once, many in one call with a mark between them, and kept until `most` parts are known. A stop after an ASCII
    letter begins a part as well, and parts of ASCII alone are lower-cased first: the tokenizer does both.
    """

    def __init__(self, path: str, most: int = 1 << 19, together: int = 100):
        self.encoder, self.most, self.together = tokenizer(path), most, together
        self.mark = self.encode([BETWEEN])[0]
        if len(self.mark) != 1:
            raise ValueError("the mark between parts is not one id")
        self.forget()

    def forget(self) -> None:
        self.known, self.flat, self.ends = {}, [], [np.zeros(1, np.int64)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.encoder.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: list[str]) -> None:
        """Encode new parts; their ids follow those of the known ones."""
        plain = [w for w in words if BETWEEN not in w]
        odd = [w for w in words if BETWEEN in w]
        joint = [f" {BETWEEN} ".join([*plain[i : i + self.together], ""]) for i in range(0, len(plain), self.together)]
        ids = np.concatenate([*self.encode(joint), np.zeros(0, np.uint32)])
        marks = np.flatnonzero(ids == self.mark[0])
        if len(marks) == len(plain):
            sizes, ids = np.diff(marks, prepend=-1) - 1, np.delete(ids, marks)
        else:  # the mark's id stands for something else as well
            plain, odd, sizes, ids = [], words, np.zeros(0, np.int64), ids[:0]
        each = self.encode(odd)
        for w in (*plain, *odd):
            self.known[w] = len(self.known)
        self.flat.extend([ids, *each])
        self.ends.append(self.ends[-1][-1] + np.cumsum([*sizes, *map(len, each)], dtype=np.int64))

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows one after another, and how many each row has."""
        apart = pc.replace_substring_regex(column.cast(pa.large_string()).fill_null(""), "([A-Za-z])([,.;:!?])", r"\1 \2")
        parts = pc.ascii_split_whitespace(apart)
        words = parts.flatten().dictionary_encode()
        names = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        names = [w.lower() if w.isascii() and "<|" not in w else w for w in names]  # special tokens are found before
        if len(self.known) > self.most:
            self.forget()
        self.learn(list({w for w in names if w not in self.known}))
        self.flat, self.ends = [np.concatenate(self.flat)], [np.concatenate(self.ends)]
        number = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))[words.indices.to_numpy()]
        begin, own = self.ends[0][number], self.ends[0][number + 1] - self.ends[0][number]
        total = np.concatenate([[0], np.cumsum(own)])
        at = np.arange(total[-1]) + np.repeat(begin - total[:-1], own)
        cuts = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))]).astype(np.int64)
        return self.flat[0][at], np.diff(total[cuts])


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One for a worker, so that its tasks share what is known."""
    return WordIds(path)


def write_ids(docs: DataFrame, root: str, path: str | None = None, end_id: int = 1, shard_bytes: int = 1 << 26, part_keys: int = 1 << 20) -> Store:
    """Write the token ids of all documents below `root`, in ascending doc_id order, and an index over their keys.

    docs: doc_id, text. path: a tokenizer file whose tokenizer cuts at white space and drops it (the 49k vocabulary where
    None). Every document gets its ids and `end_id`; a null or empty text has the end id alone. A key is a doc_id and a
    copy: the rows of one id are its copies 0, 1, 2..., ordered by a hash of their texts, equal rows by their place; null is an id like
    others and comes last. Shards hold the ids of about `shard_bytes` of text each, in ranges of (id, hash, place), so rows of one
    id may lie in several; a shard's task encodes its texts and writes their ids, and no table of ids passes between tasks. Index parts hold `part_keys` keys at most on average, and there are as many as shuffle partitions at least. Other
    columns are ignored; an empty table gives a store without keys.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    spark = docs.sparkSession
    width = 2 if max(tokenizer(path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4

    def write_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, name, file, shard, at, last, copy, first = word_ids(path), None, None, -1, 0, None, 0, None
        try:
            for batch in batches:
                for chunk in arrays.chunks(batch, "text", 1 << 23):
                    own = chunk.column("doc_id").to_pylist()
                    if file is None:
                        shard, first = chunk.column("shard")[0].as_py(), own[0]
                        name, file = new_file(root, "ids", shard)
                    ids, n = encode(chunk.column("text"))
                    file.write(np.insert(ids, np.cumsum(n), end_id).astype(f"<u{width}").tobytes())
                    n, copies = n + 1, []
                    for i in own:
                        last, copy = ((i,), 0) if (i,) != last else (last, copy + 1)
                        copies.append(copy)
                    starts, at = at + np.cumsum(n) - n, at + int(n.sum())
                    yield pa.RecordBatch.from_arrays([
                        pa.array([shard] * len(own), pa.int64()), pa.array([name] * len(own)), chunk.column("doc_id").is_valid(),
                        chunk.column("doc_id").fill_null(0), pa.array(copies, pa.int64()), pa.array([i == first for i in own]), pa.array(starts), pa.array(n),
                    ], ["shard", "file", "known", "id", "copy", "opens", "at", "n"])
        finally:
            if file is not None:
                file.close()

    def write_part(table: pa.Table) -> pa.Table:
        keys = tuple(table.column(c).to_numpy() for c in KEY)
        rows = np.zeros(table.num_rows, SLOT)
        for c in ("shard", "at", "n"):
            rows[c] = table.column(c).to_numpy()
        part = table.column("part")[0].as_py()
        return pa.table({"part": [part], "file": [write_index(root, part, keys, rows)], "keys": [table.num_rows]})

    with passing_tables(spark, "ids") as keep:
        size, n_docs = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
        rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
        order = [F.col("doc_id").asc_nulls_last(), "tie", "row"]
        dealt = rows.repartitionByRange(size // shard_bytes + 1, *order).sortWithinPartitions(*order)
        entries = keep(dealt.select("doc_id", "text", F.spark_partition_id().alias("shard")).mapInArrow(
            write_shards, "shard long, file string, known boolean, id long, copy long, opens boolean, at long, n long"
        ), "entries")

        ids_before = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        shards = entries.groupBy("shard").agg(F.first("file").alias("file"), F.sum("n").alias("n_ids"), F.count("*").alias("n_docs"))
        shards.withColumn("before", ids_before).write.parquet(f"{root}/shards")

        # copies of the id that opens a shard go on from those in earlier shards
        opening = entries.filter("opens").select("known", "id").distinct()
        runs = entries.join(opening, ["known", "id"], "left_semi").groupBy("known", "id", "shard").agg(F.count("*").alias("own"))
        earlier = F.sum("own").over(Window.partitionBy("known", "id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
        shift = runs.select("known", "id", "shard", F.lit(True).alias("opens"), earlier.alias("earlier")).filter("earlier > 0")
        keyed = entries.join(shift, ["known", "id", "shard", "opens"], "left").withColumn("copy", F.col("copy") + F.coalesce("earlier", F.lit(0)))
        n_parts = max(n_docs // part_keys + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        keyed = keep(keyed.select(F.pmod(F.xxhash64(*KEY), F.lit(n_parts)).alias("part"), *KEY, "shard", "at", "n"), "keyed")
        parts = keyed.groupBy("part").applyInArrow(write_part, "part long, file string, keys long")
        parts.write.parquet(f"{root}/parts")
        keyed.select(*KEY).write.parquet(f"{root}/keys")
    return Store(root, width, n_parts)


def key_of(doc_id, copy) -> list:
    """The key columns of a doc_id and a copy."""
    return [doc_id.isNotNull().alias("known"), F.coalesce(doc_id.cast("long"), F.lit(0)).alias("id"), copy.cast("long").alias("copy")]


def located(spark: SparkSession, store: Store, keys: DataFrame) -> DataFrame:
    """known, id, copy, shard, at, n of every key (known, id, copy); shard, at and n are null for keys that the store lacks.

    Keys are asked for once each and meet their part's index in one task, which opens it once.
    """
    schema = pa.schema([("known", pa.bool_()), ("id", pa.int64()), ("copy", pa.int64()), ("shard", pa.int64()), ("at", pa.int64()), ("n", pa.int64())])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column("file").to_pylist()
            cuts = [0, *(i for i in range(1, len(files)) if files[i] != files[i - 1]), len(files)]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                own = batch.slice(low, high - low)
                if not len(files) or files[low] is None:
                    there, rows = np.zeros(own.num_rows, bool), np.zeros(own.num_rows, SLOT)
                else:
                    there, rows = held(store.root, files[low], tuple(own.column(c).to_numpy(zero_copy_only=False) for c in KEY))
                values = [pa.array(rows[c].astype(np.int64), mask=~there) for c in ("shard", "at", "n")]
                yield pa.RecordBatch.from_arrays([*(own.column(c) for c in KEY), *values], schema=schema)

    dealt = keys.select(*KEY).distinct().withColumn("part", F.pmod(F.xxhash64(*KEY), F.lit(store.n_parts)))
    found = dealt.join(store.table(spark, "parts").select("part", "file"), "part", "left").select(*KEY, "file")
    return found.repartition("file").sortWithinPartitions("file").mapInArrow(look_up, "known boolean, id long, copy long, shard long, at long, n long")


class Reader:
    """Spans of id files; the few files used last stay open, and reads that follow each other are taken from one block."""

    def __init__(self, root: str, block: int = 1 << 22, most: int = 8):
        self.system, self.path = opened(root)
        self.block, self.most, self.files, self.last = block, most, OrderedDict(), (None, 0, b"")

    def __call__(self, name: str, at: int, size: int) -> bytes:
        file, begin, data = self.last
        if name != file or at < begin or at + size > begin + len(data):
            if name not in self.files:
                self.files[name] = self.system.open_input_file(f"{self.path}/{name}")
                if len(self.files) > self.most:
                    self.files.popitem(last=False)[1].close()
            data, begin = self.files[name].read_at(max(size, self.block), at), at
            self.last = (name, begin, data)
        return data[at - begin : at - begin + size]


def read_ids(spark: SparkSession, store: Store, keys: DataFrame, piece_ids: int = 1 << 20) -> DataFrame:
    """doc_id, copy, start, n_tokens, ids of every key (known, id, copy), from the store's files.

    start: the ids of all documents before it; ids: little-endian unsigned 32-bit integers one after another. Keys that
    the store lacks have nulls. Documents are read in pieces of about `piece_ids` neighbouring ids, a piece in one task.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(store.root)
        for batch in batches:
            names, ats, sizes = (batch.column(c).to_pylist() for c in ("file", "at", "n"))
            row = 0
            while row < batch.num_rows:  # some rows at a time, a long document alone
                stop, total, payload = row, 0, []
                while stop < batch.num_rows and (stop == row or total < 1 << 22):
                    name, n = names[stop], sizes[stop]
                    raw = None if name is None else np.frombuffer(reader(name, ats[stop] * store.width, n * store.width), f"<u{store.width}")
                    if raw is not None and len(raw) != n:
                        raise OSError(f"{name} ends too early")
                    payload.append(None if raw is None else raw.astype("<u4").tobytes())
                    total, stop = total + (n or 0), stop + 1
                own = batch.slice(row, stop - row)
                yield pa.RecordBatch.from_arrays([*(own.column(c) for c in ("doc_id", "copy", "start", "n")), pa.array(payload, pa.binary())], ["doc_id", "copy", "start", "n_tokens", "ids"])
                row = stop

    shards = store.table(spark, "shards").select("shard", "file", "before")
    found = located(spark, store, keys).join(shards, "shard", "left").select(
        F.when(F.col("known"), F.col("id")).alias("doc_id"), "copy", (F.col("before") + F.col("at")).alias("start"), "n", "file", "at",
        F.floor(F.col("at") / piece_ids).alias("piece"),
    )
    return found.repartition("file", "piece").sortWithinPartitions("file", "at").drop("piece").mapInArrow(
        read, "doc_id long, copy long, start long, n_tokens long, ids binary"
    )


def write_and_read_ids(docs: DataFrame, root: str | None = None, **how) -> DataFrame:
    """write_ids, and read_ids of all keys of the store."""
    spark = docs.sparkSession
    store = write_ids(docs, root or scratch_path(spark, "id-files"), **how)
    return read_ids(spark, store, store.table(spark, "keys"))
