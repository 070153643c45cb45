"""Document fingerprints: bottom-k sketches of word shingles, with Spark functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestlens.llm import regions
from harvestlens.session import write_and_read

SHINGLE, K = 5, 128


def word_hashes(text: Column) -> Column:
    """A hash of every word of a text, in order; words stand between white space, null has none."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\t-\r]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(hashes: Column, shingle: int = SHINGLE) -> Column:
    """Hashes of the word shingles, from a column (no expression: it is read once per shingle) of word hashes.

    Fewer words than a shingle are one shingle, no word gives none.
    """
    short = F.array(F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: F.xxhash64(a, h)))
    runs = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - shingle),
        lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(shingle)]),
    )
    none = F.array().cast("array<long>")
    return F.when(F.size(hashes) == 0, none).when(F.size(hashes) < shingle, short).otherwise(runs)


def with_sketch(df: DataFrame, text: str, name: str, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Adds the sketch of a text column."""
    hashed = df.withColumn("word hashes", word_hashes(F.col(text)))
    return hashed.withColumn(name, bottom_k(shingle_hashes(F.col("`word hashes`"), shingle), k)).drop("word hashes")


def bottom_k(hashes: Column, k: int = K) -> Column:
    """The k least distinct hashes, in order."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(one: Column, two: Column, k: int = K) -> Column:
    """The sketch of both parts together, from their sketches."""
    return F.slice(F.sort_array(F.array_union(one, two)), 1, k)


def _shared(one: Column, two: Column, k: int) -> tuple[Column, Column]:
    both = merged(one, two, k)
    return F.size(F.array_intersect(both, F.array_intersect(one, two))), F.size(both)


def resemblance(one: Column, two: Column, k: int = K) -> Column:
    """Estimated shared part of all distinct shingles of two texts; two empty sketches are alike."""
    shared, size = _shared(one, two, k)
    return F.when(size == 0, F.lit(1.0)).otherwise(shared / size)


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    largest = (F.get(sketch, F.lit(k - 1)).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / largest)


def containment(one: Column, two: Column, k: int = K) -> Column:
    """Estimated part of the first text's distinct shingles that the second holds, 1 at most; 1 for an empty first text."""
    ratio = resemblance(one, two, k) * distinct_shingles(merged(one, two, k), k) / distinct_shingles(one, k)
    return F.when(F.size(one) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), ratio))


def written(sketch: Column) -> Column:
    """A sketch as a string: 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def merged_over(sketches: DataFrame, by: list[str], sketch: str, k: int = K) -> DataFrame:
    """One sketch per group from the sketches of its parts: distinct hashes, ranked in two steps.

    A group's hashes are first cut to k in each of 64 parts by their value, then over the parts, so no task gets more of a
    group than one part's distinct hashes or 64 times k. Groups of empty or null sketches get an empty one.
    """
    each = sketches.select(*by, F.explode_outer(sketch).alias("h")).distinct()
    part = F.pmod(F.xxhash64("h"), F.lit(64)).alias("part")
    within = Window.partitionBy(*by, "part").orderBy("h")
    cut = each.withColumn("part", part).withColumn("place", F.row_number().over(within)).filter(F.col("place") <= k)
    return cut.groupBy(*by).agg(F.slice(F.sort_array(F.collect_list("h")), 1, k).alias(sketch))


def neighbours(rows: DataFrame) -> DataFrame:
    """doc, v, and of the document before it (of the first: the last one): prev_doc, prev_v, prev_chars.

    Ids go to ranges, neighbours inside a range come from a window over it, and those over range ends from one row a
    range. The ranges are written once, so repeated tasks see the same ones.
    """
    ids = rows.select("doc", "v", F.coalesce(F.length("text"), F.lit(0)).alias("chars")).repartitionByRange("doc", "v")
    ranges = write_and_read(ids.withColumn("part", F.spark_partition_id()), "neighbours")
    here = F.struct("doc", "v", "chars")
    ends = ranges.groupBy("part").agg(F.max(here).alias("last"))
    # One row a range: as many as shuffle partitions.
    one = Window.orderBy("part")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("part", F.coalesce(F.lag("last").over(one), F.last("last").over(whole)).alias("before"))
    inside = F.lag(here).over(Window.partitionBy("part").orderBy("doc", "v"))
    prev = ranges.join(ends, "part").select("doc", "v", F.coalesce(inside, F.col("before")).alias("prev"))
    return prev.select("doc", "v", F.col("prev.doc").alias("prev_doc"), F.col("prev.v").alias("prev_v"), F.col("prev.chars").alias("prev_chars"))


def fingerprint_documents(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """The fingerprint of every whole text, of its edited text, and how alike they and its neighbour's are.

    docs: doc_id, text. The edited text has its last floor(n_chars / 4) code points replaced by the first as many (or
    all) of the next document, in ascending doc_id; the first follows the last. Returns, per row, doc_id, n_chars,
    edited, sketch, edited_sketch (arrays of hashes), near_edited and near_next (resemblance of the sketches), and contained_edited.

    Null text counts as empty. Null ids come last and stay null. Rows of one id stand in the order of a hash of their texts;
    rows that share id and text are one document and get the same result. A single document is its own neighbour.
    Other columns are ignored; an empty table gives an empty table.
    """
    rows, different = regions.identified(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    order = neighbours(different)
    lent = with_sketch(different.join(order, ["doc", "v"]), "text", "next_sketch", k, shingle).select(
        F.col("prev_doc").alias("doc"), F.col("prev_v").alias("v"),
        F.substring("text", F.lit(1), F.floor(F.col("prev_chars") / 4).cast("int")).alias("tail"), "next_sketch",
    )
    n = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), (n - F.floor(n / 4)).cast("int")), F.col("tail"))
    both = rows.join(lent, ["doc", "v"]).select("doc", n.cast("long").alias("n_chars"), "text", edited.alias("edited"), "next_sketch")
    both = with_sketch(with_sketch(both, "text", "sketch", k, shingle), "edited", "edited_sketch", k, shingle)
    one, two = F.col("sketch"), F.col("edited_sketch")
    return both.select(
        F.when(F.col("doc") != regions.LAST, F.col("doc")).alias("doc_id"), "n_chars", "edited", "sketch", "edited_sketch",
        resemblance(one, two, k).alias("near_edited"), resemblance(one, F.col("next_sketch"), k).alias("near_next"),
        containment(one, two, k).alias("contained_edited"), distinct_shingles(one, k).alias("shingles"),
    )
