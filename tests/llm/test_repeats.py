"""Passage, byte, line and near deduplication against plain loops."""

import random
import re

import pytest

from harvestlens.llm import line_dedup, near_dedup, regions, substring_dedup, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def covered(sequences, length):
    """Per sequence, which symbols a window covers that starts earlier too."""
    seen, out = set(), []
    for symbols in sequences:
        mask = [False] * len(symbols)
        for i in range(len(symbols) - length + 1):
            window = tuple(symbols[i : i + length])
            if window in seen:
                mask[i : i + length] = [True] * length
            seen.add(window)
        out.append(mask)
    return out


def corpus(seed, n=60):
    """Texts of few words that share passages, hold copies, and repeat themselves."""
    rnd = random.Random(seed)
    words = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(300)]
    fresh = lambda k: [rnd.choice(words) for _ in range(k)]
    shared = [fresh(30) for _ in range(3)]
    rows = []
    for i in range(n):
        text = fresh(rnd.randrange(0, 60))
        for _ in range(rnd.randrange(3)):
            passage = rnd.choice(shared)[: rnd.randrange(10, 30)]
            at = rnd.randrange(len(text) + 1)
            text[at:at] = passage
        rows.append((1000 - 3 * i, " ".join(text)))
    rows += [(2000, rows[0][1]), (2001, "ab " * 80), (2002, "a" * 400), (2003, "a" * 400), (3, None), (4, "")]
    rnd.shuffle(rows)
    return rows


def key(row):
    return (row[0] is None, row[0] or 0)


@pytest.mark.parametrize("most", [2000, 2])
def test_passages(docs_of, most):
    rows = sorted(corpus(1))
    found = {r.doc_id: r for r in substring_dedup.remove_repeated_passages(docs_of(corpus(1)), most=most).collect()}
    texts = [WORD.findall(t or "") for _, t in rows]
    for (doc_id, _), words, mask in zip(rows, texts, covered(texts, 20)):
        got = found[doc_id]
        assert (got.n_words, got.n_removed, got.kept) == (len(words), sum(mask), " ".join(w for w, m in zip(words, mask) if not m))
    assert len(found) == len(rows)


@pytest.mark.parametrize("most", [400, 2])
def test_bytes(docs_of, most):
    rows = sorted(corpus(2))
    found = {r.doc_id: r for r in suffix_dedup.remove_repeated_bytes(docs_of(corpus(2)), most=most).collect()}
    texts = [(t or "").encode() for _, t in rows]
    for (doc_id, _), data, mask in zip(rows, texts, covered(texts, 100)):
        got = found[doc_id]
        assert (got.n_bytes, got.n_removed) == (len(data), sum(mask))
        assert bytes(got.kept) == bytes(b for b, m in zip(data, mask) if not m)
        runs = re.sub("1+", "1", "".join("01"[m] for m in mask)).count("1")
        assert len(got.spans) == runs


@pytest.mark.parametrize("length, gram", [(7, 3), (12, 5), (26, 9)])
def test_other_window_lengths(docs_of, length, gram):
    rows = sorted(corpus(3, 25))
    found = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeated_bytes(docs_of(rows), length, gram).collect()}
    masks = covered([(t or "").encode() for _, t in rows], length)
    assert found == {d: sum(m) for (d, _), m in zip(rows, masks)}


def test_lines(docs_of):
    rnd = random.Random(4)
    rows = [(i, "\n".join(rnd.choice("abc") for _ in range(rnd.randrange(12)))) for i in range(40)] + [(50, None)]
    found = {r.doc_id: r for r in line_dedup.remove_repeated_lines(docs_of(rows[::-1])).collect()}
    lines = [[] if t is None else t.split("\n") for _, t in rows]
    for (doc_id, _), own, mask in zip(rows, lines, covered(lines, 3)):
        got = found[doc_id]
        assert (got.n_lines, got.n_removed, got.kept) == (len(own), sum(mask), "\n".join(x for x, m in zip(own, mask) if not m))


def shingle_set(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set()


@pytest.mark.parametrize("most", [20_000, 3])
def test_near_duplicates(docs_of, most):
    rnd = random.Random(5)
    rows, texts = [], []
    for i in range(120):
        if texts and rnd.random() < 0.7:
            words = rnd.choice(texts).split()
            for _ in range(rnd.randrange(1 + len(words) // 15)):
                words[rnd.randrange(len(words))] = f"x{rnd.randrange(50)}"
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(f"W{rnd.randrange(900)}" for _ in range(rnd.randrange(1, 90))))
        rows.append((500 - i, texts[-1]))
    rows += [(900, None), (901, ""), (902, "Solo"), (903, "solo"), (904, "a b"), (905, "a b a b")]
    sets = {d: shingle_set(t, 2) for d, t in rows}
    parent = {d: d for d in sets}
    for d in sorted(sets):
        for e in sets:
            shared = len(sets[d] & sets[e])
            if shared and 100 * shared >= 80 * len(sets[d] | sets[e]) and parent[d] != parent[e]:
                low, high = sorted((parent[d], parent[e]))
                parent = {x: low if p == high else p for x, p in parent.items()}
    found = {r.doc_id: r for r in near_dedup.near_duplicates(docs_of(rows), near_dedup.Similarity(shingle=2), most).collect()}
    assert {d: (r.n_shingles, r.component_id, r.kept) for d, r in found.items()} == {d: (len(sets[d]), parent[d], parent[d] == d) for d in sets}
    assert any(not r.kept for r in found.values())


@pytest.mark.parametrize("wide", [32, 2])
def test_near_duplicates_of_large_groups(docs_of, monkeypatch, wide):
    monkeypatch.setattr(near_dedup.candidates, "__defaults__", (wide,))
    # Copies of one text, some edited too much to be near its first copy but near another one.
    rnd = random.Random(8)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(160):
        words = list(base)
        for at in rnd.sample(range(100), rnd.randrange(0, 9) if i % 8 else 8 + rnd.randrange(6)):
            words[at] = f"e{rnd.randrange(10**6) if i % 16 else i % 3}"
        rows.append((i, " ".join(words)))
    sets = {d: shingle_set(t, 2) for d, t in rows}
    parent = {d: d for d in sets}
    for d in sets:
        for e in sets:
            if 100 * len(sets[d] & sets[e]) >= 80 * len(sets[d] | sets[e]) and parent[d] != parent[e]:
                low, high = sorted((parent[d], parent[e]))
                parent = {x: low if p == high else p for x, p in parent.items()}
    found = near_dedup.near_duplicates(docs_of(rows), near_dedup.Similarity(shingle=2)).collect()
    assert {r.doc_id: r.component_id for r in found} == parent
    assert 1 < len(set(parent.values())) < 100


def test_two_sets_need_no_common_first_node(docs_of):
    # A chain: each text is near the next one, but the ends are not near one another.
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[2 * i : 2 * i + 40])) for i in range(10)]
    found = near_dedup.near_duplicates(docs_of(rows), near_dedup.Similarity(shingle=2)).collect()
    assert {r.component_id for r in found} == {0}


OPERATORS = {
    "passages": (substring_dedup.remove_repeated_passages, "n_words"),
    "bytes": (suffix_dedup.remove_repeated_bytes, "n_bytes"),
    "lines": (line_dedup.remove_repeated_lines, "n_lines"),
    "near": (near_dedup.near_duplicates, "n_shingles"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(docs_of, odd_rows, name):
    run, size = OPERATORS[name]
    found = sorted(((r.doc_id, r[size]) for r in run(docs_of(odd_rows)).collect()), key=key)
    assert [d for d, _ in found] == [5, 6, 7, 8, 9, 10, 11, None]
    assert dict(found)[5] == 0
    assert run(docs_of([])).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_repeated_ids_and_rows(docs_of, name):
    run, _ = OPERATORS[name]
    text = "\n".join(f"line {i} of a text that is long enough to be found again" for i in range(12))
    rows = [(1, text), (1, text), (1, "other " * 3), (2, text), (None, text)]
    found = sorted(run(docs_of(rows)).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, str(r)))
    assert [r.doc_id for r in found] == [1, 1, 1, 2, None]
    if name == "near":
        assert [r.component_id for r in found] == [1] * 5
        assert [r.kept for r in found] == [True] * 3 + [False] * 2
    else:
        assert sorted(r.n_removed for r in found[:3]) == [0, 0, 0]
        assert found[3].n_removed == found[4].n_removed > 0


def test_a_common_passage_is_split_before_it_is_indexed(spark, docs_of):
    rnd = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(25))
    fill = lambda: " ".join(f"f{rnd.randrange(10**6)}" for _ in range(30))
    rows = [(i, f"{fill()} {passage} {fill()}") for i in range(60)]
    found = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeated_passages(docs_of(rows), most=5).collect()}
    assert found == {0: 0} | dict.fromkeys(range(1, 60), 25)


def test_a_task_takes_rows_without_spans_before_and_after_others(docs_of):
    """A task hands on 500 rows at a time; of these, all, some or none may have spans."""
    rnd = random.Random(9)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(300))
    rows = [(i, f"text {i}") for i in range(1, 1300)] + [(2000, long), (2001, f"{long} and more")]
    found = {r.doc_id: r for r in suffix_dedup.remove_repeated_bytes(docs_of(rows).coalesce(1)).collect()}
    assert len(found) == len(rows)
    assert {d: [tuple(s) for s in r.spans] for d, r in found.items() if r.spans} == {2001: [(0, 300)]}
    assert found[2001].kept == b" and more" and found[7].kept == b"text 7"


def test_anchors_of_equal_windows_agree():
    import numpy as np

    rnd = np.random.default_rng(7)
    windows = regions.Windows(20, 8, 10)
    one, two = rnd.integers(0, 5, 200).astype(np.uint64), rnd.integers(0, 5, 200).astype(np.uint64)
    two[50:80] = one[90:120]
    places = {tuple(one[p : p + 8]): p for p in regions.anchors(one, windows)[0].tolist() if 90 <= p <= 112}
    for start in range(50, 61):
        inside = [p for p in regions.anchors(two, windows)[0].tolist() if start <= p <= start + 12]
        assert any(places.get(tuple(two[p : p + 8])) == p + 40 for p in inside)
