"""Packing of examples into training sequences by the dot-product heuristic of vector bin packing."""

from __future__ import annotations

import base64
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlens.llm import arrays


class Limits(NamedTuple):
    """What a sequence may hold at most: tokens, segments, and tokens that bear loss."""

    tokens: int = 1024
    segments: int = 64
    loss: int = 1024


def dot_product_bins(tokens: np.ndarray, loss: np.ndarray, limits: Limits) -> list[list[int]]:
    """Bins of indices, each within all limits. Examples over a limit are an error.

    One bin is open at a time. It takes the example with the largest dot product of its demands and the room
    left, each as a share of the limit and weighted by how much of the limit all examples ask for; equal
    demands are one kind, taken in order. When none fits, the bin is closed.
    """
    sizes = np.stack([tokens, np.ones_like(tokens), loss], 1).astype(np.int64)
    limit = np.array(limits, np.int64)
    if (sizes > limit).any():
        raise ValueError("an example is larger than a sequence")
    if not len(sizes):
        return []
    kinds, kind = np.unique(sizes, axis=0, return_inverse=True)
    members = np.split(np.argsort(kind.reshape(-1), kind="stable"), np.cumsum(np.bincount(kind.reshape(-1)))[:-1])
    left, share = np.array([len(m) for m in members]), kinds / limit
    weighted = share * (share * left[:, None]).sum(axis=0)
    bins, rest = [], len(sizes)
    while rest:
        room, held = limit.copy(), []
        while True:
            fits = (left > 0) & (kinds <= room).all(axis=1)
            if not fits.any():
                break
            best = int(np.where(fits, weighted @ (room / limit), -1.0).argmax())
            left[best] -= 1
            held.append(int(members[best][left[best]]))
            room -= kinds[best]
        bins.append(held)
        rest -= len(held)
        if rest and len(kinds) > 2 * (left > 0).sum():
            some = left > 0
            kinds, weighted, left, members = kinds[some], weighted[some], left[some], [m for m, s in zip(members, some, strict=True) if s]
    return bins


def pack_examples(examples: DataFrame, block_of: list[str], n_blocks: int, limits: Limits = Limits()) -> DataFrame:
    """Adds sequence_id and offset to examples with columns n_tokens and n_loss.

    Examples are dealt into `n_blocks` blocks by the columns `block_of`; a block is packed in one task and its
    sequence_id is its number times 2^32 plus a count. Within a block the order is that of all columns, so a repeated
    task gives the same sequences. Examples that fill a sequence alone take no part in the search.
    """
    schema = examples.schema
    names = schema.names

    def run(block: pa.Table) -> pa.Table:
        number = block.column("block")[0].as_py()
        rows = block.select(names).sort_by([(c, "ascending") for c in names])
        tokens, loss = (rows.column(c).to_numpy().astype(np.int64) for c in ("n_tokens", "n_loss"))
        full = tokens >= limits.tokens
        sequence, offset = np.empty(len(tokens), np.int64), np.zeros(len(tokens), np.int64)
        sequence[full] = np.arange(full.sum())
        rest = np.flatnonzero(~full)
        for bin_number, held in enumerate(dot_product_bins(tokens[rest], loss[rest], limits), int(full.sum())):
            own = rest[held]
            sequence[own] = bin_number
            offset[own] = np.cumsum(tokens[own]) - tokens[own]
        return rows.append_column("sequence_id", pa.array((number << 32) + sequence)).append_column("offset", pa.array(offset))

    dealt = examples.withColumn("block", F.pmod(F.xxhash64(*block_of), F.lit(n_blocks)))
    returns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return dealt.groupBy("block").applyInArrow(run, f"{returns}, sequence_id long, offset long")


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function from texts to ids, as the tokenizer file at `path` gives them (special tokens are not added).

    If the same vocabulary lies beside it as byte ranks, texts that hold no special token are encoded from
    those, which is several times faster and gives the same ids.
    """
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    whole = Tokenizer.from_file(path)
    plain = lambda texts: [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    beside = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(beside):
        return plain
    import public_tokenizers
    import tiktoken

    with open(beside, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    special = [t.content for t in whole.get_added_tokens_decoder().values()]

    def encode(texts: list[str]) -> list[list[int]]:
        return [plain([t])[0] if any(s in t for s in special) else fast.encode_ordinary(t) for t in texts]

    return encode


def token_pieces(docs: DataFrame, path: str, length: int, end_id: int = 0) -> DataFrame:
    """Pieces of `length` ids of every document's ids and `end_id`; the last piece may be shorter.

    Returns doc_id, start, n_tokens, n_loss (without the end id), ids_crc32, doc_tokens and deal, a number that
    spreads documents evenly, also where they share an id, null or not: equal rows are told apart by their partition and by
    how many of them a task has seen before, so a task that runs again gives the same rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(path), Counter()
        for batch in batches:
            for chunk in arrays.chunks(batch, "text"):
                out = {c: [] for c in ("doc_id", "start", "n_tokens", "n_loss", "ids_crc32", "doc_tokens", "deal")}
                texts = [t or "" for t in chunk.column("text").to_pylist()]
                keys = zip(*(chunk.column(c).to_pylist() for c in ("doc_id", "hash", "part")), strict=True)
                for (doc_id, text_hash, part), ids in zip(keys, encode(texts), strict=True):
                    ids, place = np.array([*ids, end_id], "<u4"), (doc_id is None, doc_id or 0, text_hash, part)
                    deal = hash((*place, seen[place]))
                    seen[place] += 1
                    for start in range(0, len(ids), length):
                        piece = ids[start : start + length]
                        last = start + length >= len(ids)
                        for c, x in zip(out, (doc_id, start, len(piece), len(piece) - last, zlib.crc32(piece.tobytes()), len(ids), deal), strict=True):
                            out[c].append(x)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out.values()], list(out))

    returns = "doc_id long, start long, n_tokens long, n_loss long, ids_crc32 long, doc_tokens long, deal long"
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("hash"), F.spark_partition_id().alias("part"))
    return rows.mapInArrow(run, returns)


def pack_documents(docs: DataFrame, path: str | None = None, limits: Limits = Limits(), block_documents: int = 8192) -> DataFrame:
    """Cut the token ids of documents into pieces and pack the pieces into sequences.

    docs: doc_id, text. path: a tokenizer file (the 50k byte-level vocabulary where None). Returns, per piece,
    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, n_loss. Pieces fill a sequence as far as the document lasts;
    the last pieces are packed under all limits, in blocks of about `block_documents` documents.

    All tokens but the end id bear loss, so `limits.loss` is idle unless it is below `limits.tokens`.
    Null or empty text: one piece, the end id. Null ids and repeated rows are documents of their own. Other columns are
    ignored; an empty table gives an empty table. A document lies in one block, however long it is; no id makes a block large.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    n_blocks = docs.count() // block_documents + 1
    pieces = token_pieces(docs, path, min(limits.tokens, limits.loss))
    packed = pack_examples(pieces, ["deal"], n_blocks, limits)
    return packed.select("doc_id", "start", F.col("n_tokens").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset", "n_loss")
