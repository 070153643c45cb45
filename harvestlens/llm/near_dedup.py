"""Near-duplicate documents by an inverted join over the coordinates of MinHash signatures."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestlens.llm import arrays, graph, regions
from harvestlens.session import write_and_read


class Similarity(NamedTuple):
    """Words of a shingle, least similarity in percent, coordinates of a signature, and how many must agree.

    At a similarity of 80 % fewer than 24 of 48 coordinates agree with a probability below 1e-6.
    """

    shingle: int = 5
    percent: int = 80
    coordinates: int = 48
    agree: int = 24

    @property
    def prefix(self) -> int:
        """Two signatures that agree in `agree` coordinates share one of these many rarest postings."""
        return self.coordinates - self.agree + 1


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the word shingles of every row; a shorter text is one shingle, no word is none."""
    data, offsets = arrays.text_buffer(column)
    data = arrays.LOWER[data]
    starts, ends, first = arrays.words(data, offsets, arrays.NOT_BLANK)
    hashes, out = arrays.word_hashes(data, starts, ends), []
    for a, b in zip(first[:-1], first[1:], strict=True):
        out.append(np.unique(arrays.rolling(hashes[a:b], min(size, b - a))) if b > a else hashes[:0])
    return out


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """The least scrambled hash of the set, per coordinate, as unsigned 32-bit values."""
    seeds = np.random.Generator(np.random.PCG64(coordinates)).integers(0, 2**63, (2, coordinates, 1), dtype=np.uint64)
    out = np.full(coordinates, 2**32 - 1, np.uint64)
    for at in range(0, len(shingles), 4096):
        scrambled = ((shingles[at : at + 4096] ^ seeds[0]) * (seeds[1] | np.uint64(1))) >> np.uint64(32)
        out = np.minimum(out, scrambled.min(axis=1))
    return out.astype(np.uint32)


def described(docs: DataFrame, like: Similarity) -> DataFrame:
    """doc, text_hash, n_shingles, the hash of the set (two longs) and its signature for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in arrays.chunks(batch, "text", arrays.SMALL):
                sets = shingle_sets(chunk.column("text"), like.shingle)
                digests = np.array([np.frombuffer(hashlib.md5(s.tobytes()).digest(), np.int64) for s in sets]).reshape(-1, 2)
                signatures = pa.array([signature(s, like.coordinates).tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("doc"), chunk.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1]), signatures],
                    ["doc", "text_hash", "n_shingles", "s1", "s2", "signature"],
                )

    return docs.select("doc", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, "doc long, text_hash long, n_shingles long, s1 long, s2 long, signature binary")


def postings(classes: DataFrame, like: Similarity, most: int) -> DataFrame:
    """The rarest postings of every class: token (coordinate and value), node, n_shingles, signature, mask (the bits of the
    coordinates that it is posted under, 63 at most), and blocks of long lists.

    Tokens of one document only are left out after they are counted as its rarest. A token with more than
    `most` documents is dealt out: its documents fall into blocks, and every pair of blocks is a list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high = np.arange(like.coordinates, dtype=np.int64) << 32
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, like.coordinates)
            tokens = (high + values).reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("node").to_numpy(), like.coordinates)), pa.array(tokens)], ["node", "token"])

    tokens = classes.select("node", "signature").mapInArrow(run, "node long, token long")
    common = tokens.groupBy("token").agg(F.count("*").alias("documents")).filter("documents > 1")
    by_node = Window.partitionBy("node")
    chosen = (
        tokens.join(common, "token")
        .withColumn("place", F.row_number().over(by_node.orderBy("documents", "token")) + like.coordinates - F.count("*").over(by_node))
        .filter(F.col("place") <= like.prefix)
        .withColumn("mask", F.bit_or(F.expr("shiftleft(1L, cast(shiftright(token, 32) as int))")).over(by_node))
    )
    blocks = F.ceil(F.col("documents") / most)
    own = F.pmod(F.xxhash64("node"), blocks)
    return (
        chosen.join(classes.select("node", "n_shingles", "signature"), "node")
        .select("token", "node", "n_shingles", "mask", "signature", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"))
        .select("token", F.least("own", "other").alias("block"), F.greatest("own", "other").alias("block2"), "own", "node", "n_shingles", "mask", "signature")
    )


def candidates(lists: DataFrame, like: Similarity, all_pairs: bool, wide: int = 32) -> DataFrame:
    """Pairs (a, b) of nodes that share a posting and agree in enough coordinates.

    Lists stream through a task in order. Without `all_pairs` only the first node of a list is paired
    with the others. With it, all nodes whose labels differ are; but where a label has more than `wide` nodes in a list, a
    node is paired with the label as a whole (kind 1: b is the label) as soon as it agrees with one of them, and a node that
    agrees with more than `wide` others is paired with the list as a whole (kind 2: b is the token). So a node
    gives a bounded number of rows per list. A pair (kind 0) comes from the first list that both are in, so none comes twice.
    """
    bits = np.int64(1) << np.arange(like.coordinates, dtype=np.int64)

    def alike(row: int, others: np.ndarray, sizes: np.ndarray, signatures: np.ndarray) -> np.ndarray:
        low, high = np.minimum(sizes[row], sizes[others]), np.maximum(sizes[row], sizes[others])
        others = others[100 * low >= like.percent * high]
        return others[(signatures[others] == signatures[row]).sum(axis=1) >= like.agree]

    def pairs(token: int, rows: list) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        nodes, labels, owns, sizes, masks = (np.array([r[i] for r in rows], np.int64) for i in range(5))
        signatures = np.frombuffer(b"".join(r[5] for r in rows), np.uint32).reshape(len(rows), -1)
        if not all_pairs:
            got = alike(0, np.arange(1, len(rows)), sizes, signatures)
            yield np.full(len(got), nodes[0]), nodes[got], np.zeros(len(got), np.int64)
            return
        names, member, counts = np.unique(labels, return_inverse=True, return_counts=True)
        if len(names) == 1:
            return
        rank = np.empty(len(names), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(names))
        place, many = rank[member], counts[member] > wide
        for row in np.flatnonzero(place > 0):
            # Each pair of labels is looked at from the one with fewer nodes here.
            others = np.flatnonzero(place < place[row])
            if owns.min() != owns.max():
                others = others[owns[others] != owns[row]]
            got = alike(row, others, sizes, signatures)
            posted = (signatures[got] == signatures[row]) & ((masks[got] & masks[row])[:, None] & bits > 0)
            got = got[posted.argmax(axis=1) == token >> 32]
            few, groups = nodes[got[~many[got]]], np.unique(labels[got[many[got]]])
            kinds = [few, groups, few[:0]] if len(few) <= wide else [few[:0], groups, np.array([token])]
            yield np.full(sum(map(len, kinds)), nodes[row]), np.concatenate(kinds), np.repeat([0, 1, 2], [len(x) for x in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list) -> pa.RecordBatch:
            none = (np.zeros(0, np.int64),) * 3
            a, b, kind = (np.concatenate([f[i] for f in [*found, none]]) for i in range(3))
            low, high = np.where(kind > 0, a, np.minimum(a, b)), np.where(kind > 0, b, np.maximum(a, b))
            every = np.unique(np.stack([low, high, kind], 1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(every[:, i]) for i in range(3)], ["a", "b", "kind"])

        key, rows, found, count = None, [], [], 0
        for batch in batches:
            for token, b1, b2, *row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if (token, b1, b2) != key:
                    for got in pairs(key[0], rows) if len(rows) > 1 else ():
                        found.append(got)
                        count += len(got[0]) + 1
                    if count > 100_000:
                        yield out(found)
                        found, count = [], 0
                    key, rows = (token, b1, b2), []
                rows.append(row)
        found += pairs(key[0], rows) if len(rows) > 1 else ()
        yield out(found)

    columns = ["token", "block", "block2", "node", "label", "own", "n_shingles", "mask", "signature"]
    ordered = lists.select(*columns).repartition("token", "block", "block2").sortWithinPartitions("token", "block", "block2", "node")
    return ordered.mapInArrow(run, "a long, b long, kind long").distinct()


def sets_of(part: pa.RecordBatch, column: str, like: Similarity) -> list[np.ndarray]:
    """Shingle sets of compressed texts."""
    return shingle_sets(pa.array([regions.unpacked(x) for x in part.column(column).to_pylist()], pa.large_binary()), like.shingle)


def needed(bodies: DataFrame, nodes: DataFrame, most: int = 1_000_000) -> DataFrame:
    """The texts of some nodes. Up to `most` nodes (a few MB, counted first) are sent to the texts; more are left to a join's own choice."""
    nodes = write_and_read(nodes.distinct(), "nodes")
    small = nodes.count() <= most
    return bodies.join(F.broadcast(nodes) if small else nodes, "node", "left_semi")


def confirmed(pairs: DataFrame, bodies: DataFrame, like: Similarity) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part, keep = batch.slice(at, 200), []
                sets = [sets_of(part, c, like) for c in ("body_a", "body_b")]
                for one, two in zip(*sets, strict=True):
                    shared = len(np.intersect1d(one, two, assume_unique=True))
                    keep.append(100 * shared >= like.percent * (len(one) + len(two) - shared))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    bodies = needed(bodies, pairs.select(F.explode(F.array("a", "b")).alias("node")))
    side = lambda name: bodies.select(F.col("node").alias(name), F.col("body").alias(f"body_{name}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "body_a", "body_b").mapInArrow(run, "a long, b long")


def linked_to_groups(wanted: DataFrame, every: DataFrame, bodies: DataFrame, like: Similarity, each: int | None, members: int = 2000) -> DataFrame:
    """Links (a, b) of nodes a of wanted to texts of their group b: all, or `each` per part of the group (1 for a connected group).

    every: label (the group) and node, for all members of the groups.
    Large groups are dealt into parts of about `members` texts; a task indexes a part's sets by shingle and counts the
    shared shingles of one node after another. Only links leave it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, index = None, [], None
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part, links = batch.slice(at, 200), []
                for *now, asks, node, own in zip(*(part.column(c).to_pylist() for c in ("b", "part", "asks", "node")), sets_of(part, "body", like), strict=True):
                    if now != key:
                        key, group, index = now, [], None
                    if not asks:
                        group.append((node, own))
                        continue
                    if index is None and group:
                        sizes = np.array([len(x) for _, x in group])
                        values, owner = np.concatenate([x for _, x in group]), np.repeat(np.arange(len(group)), sizes)
                        order = np.argsort(values, kind="stable")
                        index = (values[order], owner[order], sizes)
                    if index is not None:
                        values, owner, sizes = index
                        low, high = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
                        n = high - low
                        hit = np.repeat(low, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                        shared = np.bincount(owner[hit], minlength=len(sizes))
                        near = np.flatnonzero(100 * shared >= like.percent * (sizes + len(own) - shared))
                        links += [(node, group[i][0]) for i in near.tolist() if group[i][0] != node][:each]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])

    inside = every.join(wanted.select(F.col("b").alias("label")).distinct(), "label")
    parts = inside.groupBy("label").agg(F.ceil(F.count("*") / members).alias("parts"))
    given = inside.join(parts, "label").select(F.col("label").alias("b"), F.pmod(F.xxhash64("node"), "parts").alias("part"), F.lit(False).alias("asks"), "node")
    asking = wanted.join(parts, wanted.b == parts.label).select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(True).alias("asks"), F.col("a").alias("node"))
    rows = given.unionByName(asking)
    rows = rows.join(needed(bodies, rows.select("node")), "node").repartition("b", "part").sortWithinPartitions("b", "part", "asks", "node")
    return rows.mapInArrow(run, "a long, b long")


def in_groups(docs: DataFrame, like: Similarity, most: int) -> DataFrame:
    """doc (null ids as regions.LAST), text_hash, n_shingles and label, the group (null: no shingle), for every row of docs."""
    rows, different = regions.identified(docs)
    sets = write_and_read(described(rows, like), "sets")
    whole = rows is different
    node = F.min("doc") if whole else F.first("s1")
    classes = sets.filter("n_shingles > 0").groupBy("s1", "s2").agg(node.alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    # Different sets of so few shingles are never similar enough.
    least = like.percent / (100 - like.percent)
    lists = write_and_read(postings(classes.filter(F.col("n_shingles") >= least), like, most), "postings")

    if whole:
        bodies = regions.packed(rows).select(F.col("doc").alias("node"), "body")
    else:
        ids = described(rows.select(F.xxhash64("doc", "v").alias("doc"), "text"), like).select("doc", F.col("s1").alias("node"))
        bodies = regions.packed(different.withColumn("doc", F.xxhash64("doc", "v"))).join(ids, "doc").select("node", "body").dropDuplicates(["node"])

    starts = write_and_read(candidates(lists.withColumn("label", F.col("node")), like, False).select("a", "b"), "candidates")
    first = write_and_read(confirmed(starts, bodies, like), "links")
    label = graph.components(first)
    labelled = lists.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    rest = write_and_read(candidates(labelled, like, True), "candidates")
    groups = label.unionByName(label.select(F.col("label").alias("node"), "label").distinct())
    posted = lists.select(F.col("token").alias("label"), "node").distinct()
    second = confirmed(rest.filter("kind = 0").select("a", "b"), bodies, like)
    third = linked_to_groups(rest.filter("kind = 1").select("a", "b"), groups, bodies, like, 1)
    fourth = linked_to_groups(rest.filter("kind = 2").select("a", "b"), posted, bodies, like, None)
    final = graph.components(first.unionByName(second).unionByName(third).unionByName(fourth))
    grouped = sets.join(classes.select("s1", "s2", "node"), ["s1", "s2"], "left").join(final, "node", "left").withColumn("label", F.coalesce("label", "node"))
    return grouped.select("doc", "text_hash", "n_shingles", "label")


def given(c: str) -> Column:
    """Ids as they came, null for regions.LAST."""
    return F.when(F.col(c) != regions.LAST, F.col(c))


def near_duplicates(docs: DataFrame, like: Similarity = Similarity(), most: int = 20_000) -> DataFrame:
    """The group of near-duplicates of every document.

    docs: doc_id, text. Words `[^\\x20\\x09-\\x0D]+` of the text with A-Z lower-cased; the set of a document
    holds its distinct shingles of `like.shingle` words (fewer words: all as one; none: empty, linked with nothing).
    Documents are linked when 100 * shared >= percent * union. Returns, per row of docs, doc_id, n_shingles,
    component_id (smallest doc_id reachable over links, its own included), kept (doc_id = component_id) and text_hash (xxhash64 of the text).

    Documents with equal sets collapse first. Signatures are posted under their rarest (coordinate, value)
    pairs; lists pair their first node with the others, and once those links have joined their groups, all nodes of
    different groups, or nodes with large groups as a whole. What agrees in enough coordinates is confirmed on full sets, so links are exact;
    a link is missed only if its signatures agree in fewer than `like.agree` coordinates.

    Null text counts as empty. Null ids come last; a group of null ids only has a null component_id and
    counts as kept. Rows that repeat an id are documents of their own. Other columns are ignored.
    """
    grouped = in_groups(docs, like, most)
    least_id = grouped.filter("label is not null").groupBy("label").agg(F.min("doc").alias("least"))
    out = grouped.join(least_id, "label", "left").withColumn("component", F.coalesce("least", "doc"))
    return out.select(given("doc").alias("doc_id"), "n_shingles", given("component").alias("component_id"), (F.col("doc") == F.col("component")).alias("kept"), "text_hash")


def one_of_each_group(docs: DataFrame, keep: list[str] = [], like: Similarity = Similarity(), most: int = 20_000) -> DataFrame:
    """doc_id, text and the columns `keep` of one row of every group of near-duplicates, and of all rows without a word.

    The document with the smallest id stays; of documents that share it (or whose ids are all null), the one with the smallest
    text hash; of rows equal in id and text, the first by the columns `keep`. Rows without a word are linked with nothing.
    """
    rows = docs.select("doc_id", "text", *keep).withColumns({"doc": F.coalesce("doc_id", F.lit(regions.LAST)), "text_hash": F.xxhash64("text")})
    worded = F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    # Equal rows are cut to one in each task, so an id that many rows share (or lack) meets in no task as a whole.
    place = F.row_number().over(Window.partitionBy("doc", "text_hash").orderBy(*keep, F.lit(0)))
    once = rows.filter(worded).withColumn("place", place).filter("place = 1")
    groups = in_groups(docs, like, most).filter("label is not null").groupBy("label")
    least = groups.agg(F.min(F.struct("doc", "text_hash")).alias("least")).select("least.*")
    out = once.join(least, ["doc", "text_hash"], "left_semi").select("doc_id", "text", *keep)
    return out.unionByName(rows.filter(~worded).select("doc_id", "text", *keep))
