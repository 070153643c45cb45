"""Queries over the documents tables, and their SQL twins where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from harvestlens.llm import (
    decontamination, fingerprints, keyed_ids, language_id, license_scan, line_dedup, near_dedup, packing, resampling, spelling,
    substring_dedup, suffix_dedup, token_counts,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(c: str):
    return F.sha2(F.col(c).cast("binary"), 256).alias("kept_sha256")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_language(_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeated_passages(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", _sha256("kept"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeated_bytes(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), _sha256("kept"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan_licenses(_table(spark, sf_dir, "documents"))
    joined = {c: F.array_join(c, ",") for c in ("base_labels", "labels")}
    return out.withColumns(joined)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_repeated_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", _sha256("kept"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprints.fingerprint_documents(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.written(F.col("sketch")).alias("fingerprint"), fingerprints.written(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited", "near_next", "contained_edited", "shingles",
    )


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), near_dedup.Similarity(shingle=2)).drop("text_hash")


def op11_keyed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = keyed_ids.write_and_read_ids(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(_table(spark, sf_dir, "documents"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_substring_dedup, op3_packing, op4_suffix_dedup, op5_license_scan, op6_decontamination,
        op7_line_dedup, op8_token_counts, op9_fingerprints, op10_near_dedup, op11_keyed_ids, op12_spelling_variants,
        op13_resampling,
    )
} | {"pipeline": corpus_pipeline.run}

#: CTEs: `crc_table` has the CRC-32 table `t` as a list, by its rule; `_crc32(s)` is an expression over it.
CRC_TABLE = """
    crc_table AS (
      SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
      FROM range(256) AS r(i)
    )
"""


def _crc32(s: str) -> str:
    codes = f"list_transform(range(octet_length(encode({s}))), lambda i: ('0x' || substr(hex(encode({s})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


SQL = {
    "op2_substring_dedup": r"""
        WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w FROM documents),
        windows AS (
          SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') AS run
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM words)
        ),
        ranked AS (SELECT doc_id, p, row_number() OVER (PARTITION BY run ORDER BY doc_id, p) AS k FROM windows),
        covered AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM ranked WHERE k > 1),
        each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words),
        kept AS (
          SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM each ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM words LEFT JOIN kept USING (doc_id)
    """,
    "op4_suffix_dedup": """
        WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        windows AS (
          SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS run
          FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS p FROM docs)
        ),
        ranked AS (SELECT doc_id, p, row_number() OVER (PARTITION BY run ORDER BY doc_id, p) AS k FROM windows),
        later AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM ranked WHERE k > 1),
        numbered AS (
          SELECT doc_id, p, sum(CASE WHEN before >= p - 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM later
        ),
        spans AS (SELECT doc_id, span, min(p) AS a, max(p) + 100 AS b FROM numbered GROUP BY doc_id, span),
        ends AS (
          SELECT doc_id, a, b, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS c, row_number() OVER (PARTITION BY doc_id ORDER BY a) AS k FROM spans
        ),
        cut AS (
          SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
            string_agg((CASE WHEN k = 1 THEN substr(h, 1, 2 * a) ELSE '' END) || substr(h, 2 * b + 1, 2 * (coalesce(c, len(h) // 2) - b)), '' ORDER BY a) AS kept
          FROM ends JOIN docs USING (doc_id) GROUP BY doc_id
        )
        SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
          sha256(unhex(coalesce(kept, h))) AS kept_sha256
        FROM docs LEFT JOIN cut USING (doc_id)
    """,
    "op7_line_dedup": """
        WITH docs AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
        windows AS (SELECT doc_id, p, l[p:p + 2] AS run FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS p FROM docs)),
        ranked AS (SELECT doc_id, p, row_number() OVER (PARTITION BY run ORDER BY doc_id, p) AS k FROM windows),
        covered AS (SELECT DISTINCT doc_id, unnest(range(p, p + 3)) AS p FROM ranked WHERE k > 1),
        each AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS p FROM docs),
        kept AS (SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY p) AS text FROM each ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, coalesce(len(l), 0) AS n_lines, coalesce(len(l), 0) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (doc_id)
    """,
    "op10_near_dedup": r"""
        WITH RECURSIVE words AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
          FROM documents
        ),
        sets AS (
          SELECT doc_id, list_distinct(CASE WHEN len(w) = 1 THEN [w[1]]
            ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
          FROM words
        ),
        each AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
        links AS (
          SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
        ),
        reach(doc_id, other) AS (
          SELECT doc_id, doc_id FROM documents
          UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
        )
        SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
    """,
    "op12_spelling_variants": rf"""
        WITH RECURSIVE {CRC_TABLE},
        each AS (
          SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
          FROM documents
        ),
        runs AS (SELECT doc_id, run, count(*) AS n FROM each WHERE length(run) >= 7 GROUP BY doc_id, run),
        hashed AS (SELECT run, n, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, crc_table),
        noised AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
        words AS (SELECT word, sum(n)::BIGINT AS n FROM noised WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words),
        cut AS (SELECT word, n, p, substr(word, 1, p - 1) AS before, substr(word, p + 1) AS after FROM places),
        less AS (SELECT DISTINCT cut.word, cut.n, other.word AS other, other.n AS other_n FROM cut JOIN words other ON other.word = cut.before || cut.after),
        near AS (
          SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (p, before, after) WHERE a.word <> b.word
          UNION ALL SELECT word, other, other_n FROM less UNION ALL SELECT other, word, n FROM less
        ),
        best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n FROM near GROUP BY word),
        linked AS (
          SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form, CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
          FROM words LEFT JOIN best USING (word)
        ),
        chain(word, last) AS (
          SELECT word, word FROM linked UNION ALL SELECT chain.word, linked.form FROM chain JOIN linked ON linked.word = chain.last WHERE linked.form IS NOT NULL
        ),
        ends AS (SELECT chain.word, last AS root FROM chain JOIN linked ON linked.word = chain.last WHERE linked.form IS NULL)
        SELECT word, form, root, n, n_near, form_n FROM linked JOIN ends USING (word)
    """,
    "op13_resampling": rf"""
        WITH {CRC_TABLE},
        texts AS (SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
        each AS (
          SELECT side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
          FROM texts
        ),
        buckets AS (SELECT word, {_crc32("word")} % 10000 AS bucket FROM (SELECT DISTINCT word FROM each), crc_table),
        counts AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM each JOIN buckets USING (word) GROUP BY bucket),
        totals AS (SELECT sum(s)::BIGINT AS total_s, sum(t)::BIGINT AS total_t FROM counts),
        gains AS (
          SELECT bucket, floor(1000.0::DOUBLE * ln(((t + 1) * (total_s + 10000)::DOUBLE) / ((s + 1) * (total_t + 10000)::DOUBLE)))::BIGINT AS gain FROM counts, totals
        ),
        weights AS (
          SELECT doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
          FROM each JOIN buckets USING (word) JOIN gains USING (bucket) WHERE side = 0 GROUP BY doc_id
        ),
        scored AS (
          SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000.0::DOUBLE
            * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
          FROM documents LEFT JOIN weights USING (doc_id)
        ),
        ranked AS (
          SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
    """,
}
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
