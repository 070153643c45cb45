"""Spelling variants against plain loops over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from harvestlens.llm import arrays, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows, variants):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if variants.noise and h % variants.noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= variants.letters and n >= variants.occurrences}
    out, forms = {}, {}
    for w, n in words.items():
        near = sorted((-m, v) for v, m in words.items() if one_edit(w, v))
        form = near[0][1] if near and -near[0][0] >= variants.ratio * n else None
        forms[w], out[w] = form, [form, None, n, len(near), words[form] if form else None]
    for w, row in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        row[1] = root
    return {w: tuple(row) for w, row in out.items()}


def texts(n, seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcdeéÿ×ÖA") for _ in range(rnd.randrange(5, 11))) for _ in range(40)]
    for i in range(n):
        words = []
        for _ in range(rnd.randrange(60)):
            w = base[min(int(rnd.expovariate(0.25)), 39)]
            while rnd.random() < 0.15:
                at = rnd.randrange(len(w) + 1)
                w = rnd.choice([w[:at] + w[at + 1 :], w[:at] + rnd.choice("abcé") + w[at + 1 :], w[:at] + "z" + w[at:]])
            words.append(w)
        yield 7 * i - 50, rnd.choice([" ", "-", " 1 ", "日"]).join(words)


def found_in(docs, variants):
    rows = spelling.group_variants(docs, variants).collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@pytest.mark.parametrize("variants", [spelling.Variants(), spelling.Variants(noise=3, letters=4, ratio=2, symbols=2), spelling.Variants(noise=0, letters=3, occurrences=1, ratio=2, symbols=1)])
def test_groups_of_all_words(docs_of, odd_rows, variants):
    rows = list(texts(300, 2)) + odd_rows + [(None, "Straßenbahn ÉCOLE École Écoles"), (70, "x" * 3000 + " " + "x" * 2999)] * 3
    found, truth = found_in(docs_of(rows), variants), plain(rows, variants)
    assert found == truth
    assert any(r[3] for r in truth.values())


def test_chains_of_forms(docs_of):
    words = ["aaaaaaa", "aaaaaaab", "aaaaaabb", "aaaaabbb", "aaaabbbb"]
    rows = [(i, " ".join([w] * 10 ** (4 - k) * (2 if k else 4))) for i, (k, w) in enumerate(enumerate(words))]
    variants = spelling.Variants(noise=0, ratio=5)
    found = found_in(docs_of(rows), variants)
    assert found == plain(rows, variants)
    assert {r[1] for r in found.values()} == {"aaaaaaa"} and found["aaaabbbb"][0] == "aaaaabbb"


def test_neighbourhood_keys():
    """Two words share a key from one side or the other exactly if their reduced words are equal or one edit apart."""
    rnd, symbols = random.Random(4), 3
    words = ["".join(rnd.choice(spelling.LETTERS[26:40]) for _ in range(rnd.randrange(1, 6))) for _ in range(120)]
    short = ["".join(str(spelling.LETTER_HASH[ord(c)] % symbols) for c in w) for w in words]
    own, asked = {}, {}
    for edits, found in ((False, own), (True, asked)):
        for number, keys, is_own in spelling.reduced_keys(words, symbols, edits):
            for i, key, same in zip(number.tolist(), keys.tolist(), is_own.tolist(), strict=True):
                found.setdefault(i, []).append(key)
                assert same == (key == own[i][0])
    for i, a in enumerate(short):
        assert len(own[i]) == 1 and len(asked[i]) == len(set(asked[i]))
        for j, b in enumerate(short):
            near = a == b or one_edit(a, b)
            met = (own[j][0] in asked[i]) + (own[i][0] in asked[j])
            assert met == (2 if a == b else int(near))


def test_hashes_of_ranges():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = rng.integers(0, 5000, 400)
    ends = np.minimum(starts + rng.integers(0, 200, 400), 5000)
    before = rng.integers(0, 2**32, 400).astype(np.uint32)
    got = arrays.crc32(data, starts, ends, before)
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes(), int(c)) for a, b, c in zip(starts, ends, before, strict=True)]
    assert arrays.crc32(data, starts[:0], ends[:0]).tolist() == []


def test_no_words(docs_of):
    assert spelling.group_variants(docs_of([])).collect() == []
    assert spelling.group_variants(docs_of([(1, None), (2, ""), (3, "12 34"), (4, "lonelyword")])).collect() == []
