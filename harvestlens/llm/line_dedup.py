"""Line deduplication by overlapping windows of consecutive lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlens.llm import arrays, regions


def line_windows(rows: DataFrame, size: int) -> DataFrame:
    """doc, v, pos and a 128-bit hash (h1, h2) of every run of `size` lines."""
    lines, at = F.col("lines"), lambda i: [F.col("lines")[i + k] for k in range(size)]
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(lines) - size),
        lambda i: F.struct(F.xxhash64(*at(i)).alias("h1"), F.xxhash64(F.lit(1), *at(i)).alias("h2")),
    )
    split = rows.select("doc", "v", F.split("text", "\n").alias("lines")).filter(F.size(lines) >= size)
    return split.select("doc", "v", F.posexplode(hashes).alias("pos", "h")).select("doc", "v", "pos", "h.h1", "h.h2")


def remove_repeated_lines(docs: DataFrame, size: int = 3, keep: list[str] = []) -> DataFrame:
    """Remove every line in a window of `size` consecutive lines that also starts earlier in the corpus.

    docs: doc_id, text. Lines are what stands between line feeds. A window is told by two 64-bit hashes; its
    earliest place (smallest doc_id, then line) stays, the lines of all others go, overlaps merged;
    windows are judged on the texts as they come. Returns doc_id, n_lines, n_removed, kept (the lines left,
    joined by line feeds) and the columns `keep`, a row per row of docs.

    Null text has no line and keeps ''; an empty text is one empty line; texts of fewer lines than a window stay
    as they are. Null ids come last and stay null. Rows that share id and text are one document and get the
    same result. Other columns are ignored. An empty table gives an empty table.
    """
    rows, different = regions.identified(docs, keep)
    windows, place = line_windows(different, size), F.struct("doc", "v", "pos")
    firsts = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = windows.join(firsts, ["h1", "h2"]).filter(place != F.col("first"))
    by_doc = later.groupBy("doc", "v").agg(F.collect_list("pos").alias("covered"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in (c for batch in batches for c in arrays.chunks(batch, "text", arrays.SMALL)):
            total, removed, texts = [], [], []
            for text, covered in zip(chunk.column("text").to_pylist(), chunk.column("covered").to_pylist(), strict=True):
                lines = [] if text is None else text.split("\n")
                stay = np.ones(len(lines), bool)
                for k in range(size if covered else 0):
                    stay[np.array(covered) + k] = False
                total.append(len(lines))
                removed.append(len(lines) - int(stay.sum()))
                texts.append("\n".join(x for x, y in zip(lines, stay.tolist(), strict=True) if y))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc"), chunk.column("v"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string()), *(chunk.column(c) for c in keep)],
                ["doc", "v", "n_lines", "n_removed", "kept", *keep],
            )

    returns = arrays.schema_with(f"{regions.PLACE}, n_lines long, n_removed long, kept string", docs, keep)
    out = rows.join(by_doc, ["doc", "v"], "left").select("doc", "v", "text", "covered", *keep).mapInArrow(run, returns)
    return out.select(F.when(F.col("doc") != regions.LAST, F.col("doc")).alias("doc_id"), "n_lines", "n_removed", "kept", *keep)
