"""Importance resampling against plain loops."""

import hashlib
import math
import random
import re
import zlib

import pytest

from harvestlens.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, draw):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + k]) for k in range(1, draw.run + 1) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(r.encode()) % draw.buckets for r in runs]


def plain(rows, target, draw):
    source, aim = [0] * draw.buckets, [0] * draw.buckets
    for _, text in rows:
        for b in features(text, draw)[1]:
            source[b] += 1
    for text in target:
        for b in features(text, draw)[1]:
            aim[b] += 1
    total_s, total_t = sum(source), sum(aim)
    gain = [math.floor(1000 * math.log((t + 1) * (total_s + draw.buckets) / ((s + 1) * (total_t + draw.buckets)))) for s, t in zip(source, aim, strict=True)]
    out, eligible = [], []
    for number, (doc_id, text) in enumerate(rows):
        words, own = features(text, draw)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{draw.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(own), weight, score, None])
        if words >= draw.words:
            eligible.append(number)
    order = sorted(eligible, key=lambda i: (-out[i][3], out[i][0] is None, out[i][0] or 0))
    for rank, i in enumerate(order[: draw.percent * len(eligible) // 100], 1):
        out[i][4] = rank
    return [tuple(r) for r in out]


def corpus(n, seed):
    rnd = random.Random(seed)
    words = [f"w{i}" if i % 3 else f"É{i}" for i in range(200)]
    return [(3 * i - 40, " ".join(rnd.choice(words) for _ in range(rnd.randrange(80)))) for i in range(n)]


def rows_of(found):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in found.collect()), key=str)


@pytest.mark.parametrize("draw", [resampling.Draw(), resampling.Draw(run=3, buckets=50, percent=35, words=5), resampling.Draw(percent=100, words=0), resampling.Draw(percent=0)])
def test_all_rows(spark, docs_of, odd_rows, draw):
    rows = corpus(300, 6) + [(i + 5000 if i else i, t) for i, t in odd_rows]
    target = [t for _, t in corpus(10, 7)] + [None, ""]
    found = resampling.resample(docs_of(rows).repartition(3), spark.createDataFrame([(t, 1) for t in target], "text string, score int"), draw)
    assert rows_of(found) == sorted(plain(rows, target, draw), key=str)


def test_ties_go_to_the_smaller_id(spark, docs_of, monkeypatch):
    """All scores are equal: bisection over the ids decides."""
    monkeypatch.setattr(resampling, "noise", lambda doc_id, seed: resampling.F.lit(0).cast("long"))
    rows = [(i, "same words " * 15) for i in random.Random(1).sample(range(-10**12, 10**12), 200)]
    found = resampling.resample(docs_of(rows), spark.createDataFrame([], "text string")).collect()
    drawn = sorted((r.rank, r.doc_id) for r in found if r.rank)
    assert drawn == [*enumerate(sorted(i for i, _ in rows)[:20], 1)]


def test_repeated_ids_and_rows(spark, docs_of):
    """Exactly the share is drawn where a third of the rows share an id, null or not, and rows are equal."""
    rows = [(None, f"null text {i} " * 10) for i in range(40)] + [(None, "equal rows " * 12)] * 30 + [(9, "one id " * 12)] * 50 + corpus(120, 8)
    found = resampling.resample(docs_of(rows), spark.createDataFrame([("null text",)], "text string"), resampling.Draw(percent=30)).collect()
    n = sum(len((t or "").split()) >= 20 for _, t in rows)
    assert len(found) == len(rows)
    assert sorted(r.rank for r in found if r.rank) == list(range(1, 30 * n // 100 + 1))
    worst = min(r.score for r in found if r.rank)
    assert all(r.rank or r.score <= worst or r.n_features < 20 for r in found)


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "text string")
    assert resampling.resample(docs_of([]), none).collect() == []
    assert [r.rank for r in resampling.resample(docs_of([(1, None), (2, "")]), none).collect()] == [None, None]
