"""Importance resampling towards a target distribution over hashed word features."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harvestlens.llm import arrays
from harvestlens.session import passing_tables, write_and_read

#: Letters, digits and everything beyond ASCII, once A-Z are lower-cased.
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


class Draw(NamedTuple):
    """Longest word run that is a feature, buckets, seed of the noise, words a document needs, and the percentage drawn."""

    run: int = 1
    buckets: int = 10_000
    seed: int = 2024
    words: int = 20
    percent: int = 10


def feature_buckets(column: pa.Array, draw: Draw) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of every feature of some texts, and each row's number of words.

    A run of several words is hashed as its words joined by one space: the CRC of the shorter run is carried on.
    """
    data, offsets = arrays.text_buffer(column)
    data = np.concatenate([arrays.LOWER[data], np.frombuffer(b" ", np.uint8)])
    starts, ends, first = arrays.words(data[:-1], offsets, WORD)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    blank, own = np.full(len(starts), len(data) - 1), arrays.crc32(data, starts, ends)
    crcs, rows, n = [own], [row], len(starts)
    for size in range(2, draw.run + 1):
        n = max(0, len(starts) - size + 1)
        joined = arrays.crc32(data, blank[:n], blank[:n] + 1, own[:n])
        own = arrays.crc32(data, starts[size - 1 :], ends[size - 1 :], joined)
        inside = row[:n] == row[size - 1 :]
        crcs.append(own[inside])
        rows.append(row[:n][inside])
    return np.concatenate(crcs) % np.uint32(draw.buckets), np.concatenate(rows), np.diff(first)


def bucket_counts(texts: DataFrame, draw: Draw) -> np.ndarray:
    """How many features of all texts fall into each bucket: one row per task and bucket is summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(draw.buckets, np.int64)
        for batch in batches:
            for chunk in arrays.chunks(batch, "text"):
                total += np.bincount(feature_buckets(chunk.column("text"), draw)[0], minlength=draw.buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    sums = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(draw.buckets, np.int64)
    for r in sums:
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed bucket shares in the target and the source, floored."""
    above, below = (target + 1) * float(source.sum() + len(source)), (source + 1) * float(target.sum() + len(target))
    return np.floor(1000.0 * np.log(above / below)).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, draw: Draw) -> DataFrame:
    """doc_id, n_words, n_features, weight: the floored mean gain of a document's features, 0 without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in arrays.chunks(batch, "text"):
                bucket, row, words = feature_buckets(chunk.column("text"), draw)
                number = np.bincount(row, minlength=chunk.num_rows)
                order = np.argsort(row, kind="stable") if draw.run > 1 else slice(None)
                total = np.concatenate([[0], np.cumsum(gain[bucket[order]])])
                stops = np.cumsum(number)
                weight = (total[stops] - total[stops - number]) // np.maximum(number, 1)
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("doc_id"), chunk.column("tie"), pa.array(words, pa.int64()), pa.array(number, pa.int64()), pa.array(weight, pa.int64())],
                    ["doc_id", "tie", "n_words", "n_features", "weight"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tie"))
    return rows.mapInArrow(run, "doc_id long, tie long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a standard Gumbel variate that the id decides, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share))).cast("long")


#: What decides who is drawn, and whether the largest comes first: the score, then the id (null last), the text's hash, the row.
ORDER = [("score", True), ("order_id", False), ("tie", False), ("row", False)]


def cutoff(rows: DataFrame, wanted: int) -> list[int] | None:
    """The values of ORDER of the last row that is drawn, or None if no row is.

    Column by column, a bisection between the least and the largest value finds the value of the last row: each step is an
    exact count of the rows on one side, over the column alone. What is left to draw of the rows with that value is
    decided by the next column; the last one differs in all rows.
    """
    found = []
    for column, falling in ORDER:
        low, high, total = rows.agg(F.min(column), F.max(column), F.count("*")).first()
        if not found and min(wanted, total) <= 0:
            return None
        while low < high:
            middle = (low + high + (1 if falling else 0)) // 2
            side = F.col(column) >= middle if falling else F.col(column) <= middle
            enough = rows.filter(side).count() >= wanted
            if falling:
                low, high = (middle, high) if enough else (low, middle - 1)
            else:
                low, high = (low, middle) if enough else (middle + 1, high)
        found.append(low)
        side = F.col(column) > low if falling else F.col(column) < low
        wanted -= rows.filter(side).count()
        rows = rows.filter(F.col(column) == low)
    return found


def at_or_before(last: list[int]) -> Column:
    """True for the rows that ORDER puts up to the one with these values."""
    out = F.lit(True)
    for (column, falling), value in reversed([*zip(ORDER, last, strict=True)]):
        before = F.col(column) > value if falling else F.col(column) < value
        out = before | ((F.col(column) == value) & out)
    return out


def ranked(rows: DataFrame, keep) -> DataFrame:
    """Adds rank (1, 2, 3...) in ORDER: the rows are dealt by ranges, numbered within each and shifted by the sizes before it."""
    by = [F.col(c).desc() if falling else F.col(c).asc() for c, falling in ORDER]
    dealt = keep(rows.repartitionByRange(*by).withColumn("part", F.spark_partition_id()), "dealt")
    sizes = dealt.groupBy("part").agg(F.count("*").alias("size"))
    shift = sizes.select("part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shift"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(*by))
    return dealt.withColumn("own", own).join(F.broadcast(shift), "part").withColumn("rank", F.col("shift") + F.col("own"))


def resample(docs: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """Draw the documents that a target's feature distribution favours, with noise, without replacement.

    docs: doc_id, text; target: text. Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` with A-Z lower-cased; features are runs of
    1 to `run` words, hashed into `buckets`. A bucket's gain is floor(1000 ln((t+1)(S+B)/((s+1)(T+B)))) of its counts s, t and all
    counts S, T in docs and target. A document's weight is the floored mean gain, its score adds floor(1000 Gumbel noise) that
    the seed and the id decide. Of the N documents of `words` words at least, the floor(percent N/100) best scores are drawn, ties to the
    smaller id. Returns, per row, doc_id, n_features, weight, score and rank (null if not drawn).

    Null or empty text: no feature, weight 0, never drawn if `words` is 1 or more. A null id is hashed as nothing and comes last
    among ties; rows that share an id are decided by a hash of their text, equal rows by their place. Other columns are
    ignored. An empty table gives an empty table; an empty target has zero counts. Counts fill an array of `buckets` numbers,
    all that passes through the driver; the ranges hold only drawn rows.
    """
    gain = gains(bucket_counts(docs, draw), bucket_counts(target, draw))
    scored = weighted(docs, gain, draw).withColumns({
        "score": F.col("weight") + noise(F.col("doc_id"), draw.seed),
        "order_id": F.coalesce("doc_id", F.lit(2**63 - 1)), "row": F.monotonically_increasing_id(),
    })
    scored = write_and_read(scored, "resampling-scored")
    eligible, names = scored.filter(F.col("n_words") >= draw.words), ["doc_id", "n_features", "weight", "score"]
    last = cutoff(eligible, draw.percent * eligible.count() // 100)
    if last is None:
        return scored.select(*names, F.lit(None).cast("long").alias("rank"))
    drawn = (F.col("n_words") >= draw.words) & at_or_before(last)
    with passing_tables(docs.sparkSession, "resampling") as keep:
        ranks = write_and_read(ranked(scored.filter(drawn), keep).select(*names, "rank"), "resampling-ranks")
    return ranks.unionByName(scored.filter(~drawn).select(*names, F.lit(None).cast("long").alias("rank")))
