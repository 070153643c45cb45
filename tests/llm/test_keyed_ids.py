"""Binary id files and their perfect hash index: round trips against the tokenizer itself."""

import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from harvestlens.llm import keyed_ids

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(whole, text):
    return [*whole.encode(text or "", add_special_tokens=False).ids, 1]


def texts(n, seed=5):
    rnd = random.Random(seed)
    kinds = ["plain", "A.'s", "b,c", "B!'T", "x;\u0301", "Q.—", "<|ENDOFTEXT|>", "z?<|endoftext|>", "J\u030c", "I\u0307", "Über", "naïve", "don't", "we'll", "x\x1cy", "a b", "a b", "é", "́", "日本語", "12.5", "<|endoftext|>", "a<|startoftext|>b", "\x85", "\x0b", "İ", "ẞ", "'S", "‍", "ﬁ"]
    return ["".join(rnd.choice(kinds) + rnd.choice([" ", "\n", "  ", "\t", "", "\r\n", "\x0c"]) for _ in range(rnd.randrange(40))) for _ in range(n)]


def test_parts_between_white_space_have_the_ids_of_the_whole_text(whole):
    rows = texts(300) + ["", " ", "x" * 5000, "ab " * 5000]
    for most in (500_000, 3):
        ids, n = keyed_ids.WordIds(PATH, most)(pa.array([*rows, None]))
        cuts = np.concatenate([[0], np.cumsum(n)])
        for i, text in enumerate(rows):
            assert ids[cuts[i] : cuts[i + 1]].tolist() == ids_of(whole, text)[:-1]
        assert n[-1] == 0


def test_every_unicode_character(whole):
    rows = [f"a{chr(c)}b {chr(c)}" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    ids, n = keyed_ids.WordIds(PATH)(pa.array(rows))
    cuts = np.concatenate([[0], np.cumsum(n)])
    for i, e in enumerate(whole.encode_batch(rows, add_special_tokens=False)):
        assert ids[cuts[i] : cuts[i + 1]].tolist() == e.ids, hex(i)


@pytest.mark.parametrize("n", [0, 1, 2, 700, 5000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    hashes = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
    index = keyed_ids.perfect_hash(hashes)
    assert sorted(keyed_ids.slots(index, hashes).tolist()) == list(range(len(hashes)))
    other = rng.integers(0, 2**63, 100).astype(np.uint64)
    assert all(-1 <= s < max(1, len(hashes)) for s in keyed_ids.slots(index, other).tolist()) or not n
    listed = index._replace(sizes=index.sizes[:0], bits=index.bits[:0], before=np.zeros(1, np.int64), rest=np.sort(hashes))
    assert sorted(keyed_ids.slots(listed, hashes).tolist()) == list(range(len(hashes)))


def test_files_hold_every_document_in_order(spark, docs_of, odd_rows, whole, tmp_path):
    rows = odd_rows + [(2**60 + 1, "big"), (-3, "minus"), *((20 + i, t) for i, t in enumerate(texts(60)))]
    rows += [(None, f"null {i}") for i in range(40)] + [(None, "same")] * 20 + [(77, "copy")] * 25 + [(77, "another copy")]
    docs = docs_of(rows).repartition(5)
    found = {}
    for shard_bytes in (1 << 25, 3000):
        root = str(tmp_path / f"of{shard_bytes}")
        store = keyed_ids.write_ids(docs, root, shard_bytes=shard_bytes, part_keys=16)
        out = keyed_ids.read_ids(spark, store, store.table(spark, "keys"), piece_ids=300).collect()
        out.sort(key=lambda r: r.start)
        starts = np.cumsum([0, *(r.n_tokens for r in out)])
        assert [r.start for r in out] == starts[:-1].tolist()
        assert [r.doc_id for r in out] == sorted((r[0] for r in rows), key=lambda i: (i is None, i or 0))
        got = sorted((str(r.doc_id), r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) for r in out)
        assert got == sorted((str(i), len(x), x) for i, x in ((i, ids_of(whole, t)) for i, t in rows))
        for i in (None, 77):
            assert [r.copy for r in out if r.doc_id == i] == list(range(sum(r[0] == i for r in rows)))
        n_shards = store.table(spark, "shards").count()
        assert (n_shards == 1) == (shard_bytes > 3000)
        size = sum(p.stat().st_size for p in Path(root, "ids").iterdir())
        assert store.width == 2 and size == 2 * starts[-1]
        found[shard_bytes] = [(r.doc_id, r.start, r.ids) for r in out]
    assert found[3000] == found[1 << 25]


def test_lookup_by_key(spark, docs_of, tmp_path):
    store = keyed_ids.write_ids(docs_of([(i, f"word {i}") for i in range(0, 300, 3)]), str(tmp_path / "ids"))
    asked = spark.createDataFrame([(i, 0) for i in [*range(300), 6, 6]] + [(None, 0), (3, 1)], "doc_id long, copy long")
    out = keyed_ids.read_ids(spark, store, asked.select(*keyed_ids.key_of(F.col("doc_id"), F.col("copy")))).collect()
    assert len(out) == 302
    for r in out:
        assert (r.n_tokens is not None) == (r.doc_id is not None and r.doc_id % 3 == 0 and r.copy == 0) == (r.ids is not None)


def test_a_task_that_runs_again_leaves_the_store_right(spark, docs_of, tmp_path):
    """Files that no table names, as a lost executor leaves them, are not read."""
    root = str(tmp_path / "ids")
    store = keyed_ids.write_ids(docs_of([(1, "a b"), (2, "c")]), root)
    for folder in ("ids", "index"):
        Path(root, folder, f"{0:08d}-lost").write_bytes(b"torn")
    out = keyed_ids.read_ids(spark, store, store.table(spark, "keys")).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in out] == [(1, 0, 3), (2, 3, 2)]


def test_no_documents(spark, docs_of):
    assert keyed_ids.write_and_read_ids(docs_of([])).collect() == []


def test_the_query_against_the_tokenizer(spark, whole):
    import __spark_entry__

    sf_dir = "/root/testdata/sf0.001"
    if not Path(sf_dir).is_dir():
        pytest.skip("needs the tables")
    rows = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    start, truth = 0, []
    for doc_id, text in rows:
        ids = np.array(ids_of(whole, text), "<u4")
        truth.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = __spark_entry__.queries()["op11_keyed_ids"](spark, sf_dir).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found) == truth
