"""Language ID, packing, licences, decontamination, token counts and fingerprints against plain versions."""

import itertools
import random
import re
import zlib

import numpy as np
import pytest

from harvestlens.llm import decontamination, fingerprints, language_id, license_scan, packing, token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")


def fakes(n, seed=1):
    rnd = random.Random(seed)
    kinds = {"aa": ["lo", "ma", "ri", "na"], "bb": ["sch", "ung", "keit", "zt"]}
    for i in range(n):
        lang = rnd.choice(list(kinds))
        yield i, " ".join("".join(rnd.choices(kinds[lang], k=3)) for _ in range(rnd.randrange(5, 60))), lang


def test_language_of_held_out_documents(docs_of):
    rows = list(fakes(120)) + [(500, None, "aa"), (501, "12 34", "aa"), (None, "loma rina", None)]
    found = language_id.identify_language(docs_of(rows), language_id.Training(documents=40, epochs=4)).collect()
    truth = {r[0]: r[2] for r in rows}
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id in (500, 501):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is None:
            assert (r.lang_pred, r.held_out) == ("aa", False)
        else:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
            assert r.lang_pred == truth[r.doc_id] and 0.5 < r.score <= 1


def test_nothing_to_learn(docs_of):
    assert [r.lang_pred for r in language_id.identify_language(docs_of([(1, "abc")])).collect()] == ["und"]
    assert language_id.identify_language(docs_of([])).collect() == []


def test_gradient_of_the_network():
    rng = np.random.default_rng(3)
    net = language_id.Network(*([p.astype(float) for p in part] if isinstance(part, list) else part.astype(float) for part in language_id.network(3, 2, 4)))
    x, there, label = rng.integers(0, 6, (5, 4)), np.ones((5, 4)), np.array([0, 1, 1, 0])
    there[3:, 1] = 0
    _, grads = language_id.gradients(net, x, there, label)
    for part, grad in zip(net.parts, grads, strict=True):
        for at in [tuple(rng.integers(0, s) if s < 10 else int(rng.choice(x.reshape(-1))) for s in part.shape) for _ in range(4)]:
            kept, step = part[at], 1e-5
            part[at] = kept + step
            up = language_id.gradients(net, x, there, label)[0]
            part[at] = kept - step
            down = language_id.gradients(net, x, there, label)[0]
            part[at] = kept
            assert abs((up - down) / (2 * step) - grad[at]) < 1e-6


def test_packing_round_trip(docs_of, odd_rows):
    from tokenizers import Tokenizer

    rows = [r for r in odd_rows if r[0] is not None] + [(i, t) for i, t, _ in fakes(80, 2)][20:] + [(900, "a <|endoftext|> b")]
    found = packing.pack_documents(docs_of(rows)).collect()
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for doc_id, text in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted((r for r in found if r.doc_id == doc_id), key=lambda r: r.start)
        assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
        assert sum(r.length for r in own) == len(ids) == own[0].doc_tokens
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in own)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
        assert sum(r.length for r in own) <= 1024 and len(own) <= 64
    assert packing.pack_documents(docs_of([])).collect() == []
    assert len(packing.pack_documents(docs_of([(1, "x"), (1, "x"), (None, "y")])).collect()) == 3


def test_packing_keeps_ids_that_no_double_holds(docs_of):
    rows = [(2**60 + 1, "big"), (None, "nothing"), (5, "x"), (-(2**61) - 3, "minus")]
    found = packing.pack_documents(docs_of(rows)).collect()
    assert sorted((str(r.doc_id) for r in found)) == sorted(str(i) for i, _ in rows)


def test_no_id_makes_a_packing_block_large(docs_of):
    """A third of the rows share the null id, and another third are one row."""
    rows = [(None, f"null {i}") for i in range(1200)] + [(7, "the same row")] * 1200 + [(100 + i, f"other {i}") for i in range(1200)]
    found = packing.pack_documents(docs_of(rows).repartition(3), block_documents=300).collect()
    assert len(found) == len(rows)
    blocks = {}
    for r in found:
        blocks[r.sequence_id >> 32] = blocks.get(r.sequence_id >> 32, 0) + 1
    assert max(blocks.values()) <= 2 * len(rows) / 13 and len(blocks) == 13


def test_bins_keep_all_limits():
    rng = np.random.default_rng(1)
    tokens = rng.integers(1, 100, 500)
    loss = (tokens * rng.random(500)).astype(int)
    limits = packing.Limits(100, 4, 60)
    fits = loss <= 60
    bins = packing.dot_product_bins(tokens[fits], loss[fits], limits)
    assert sorted(i for b in bins for i in b) == list(range(fits.sum()))
    for b in bins:
        assert tokens[fits][b].sum() <= 100 and len(b) <= 4 and loss[fits][b].sum() <= 60
    with pytest.raises(ValueError):
        packing.dot_product_bins(np.array([101]), np.array([0]), limits)


def test_licences(docs_of, odd_rows):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use"
    rows = odd_rows + [
        (100, "x MIT License; Apache License. GNU general public License mit license"), (101, "mit the license"), (102, "Licensed under CC BY-NC 4.0."),
        (103, notice), (104, "Released under the MIT License."), (105, "license " * 500 + "mit license"),
    ]
    found = {r.doc_id: r for r in license_scan.scan_licenses(docs_of(rows)).collect()}
    for doc_id, text in rows:
        words = word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        places, labels = [], set()
        for label, phrase in (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")):
            wanted = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
            places += at
            labels |= {label} if at else set()
        r = found[doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(places), min(places, default=None), max(places, default=None))
        assert r.base_labels == sorted(labels) and labels <= set(r.labels) and 0 <= r.score <= 1
    assert found[102].labels == ["cc-by-nc-4.0"] and found[103].labels == ["mit"] and found[101].labels == []
    assert license_scan.scan_licenses(docs_of([])).collect() == []


def test_licence_labels_against_the_rule_at_every_start(docs_of):
    """Notices with up to 40 % of their words outside the key phrases replaced: what the rule grants, at any start, is found."""
    from harvestlens.llm.license_texts import TEMPLATES

    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words_of = lambda t: word.findall(t.lower())
    holds = lambda w, k, low, high: any(w[i : i + len(k)] == k for i in range(max(low, 0), min(high, len(w)) - len(k) + 1))
    rnd, rows = random.Random(12), []
    for doc_id in range(20 * len(TEMPLATES)):
        _, text, keys = TEMPLATES[doc_id % len(TEMPLATES)]
        words = words_of(text)
        fixed = {i + k for key in map(words_of, keys) for i in range(len(words)) if words[i : i + len(key)] == key for k in range(len(key))}
        share = rnd.choice([0, 0.1, 0.2, 0.3, 0.4])
        own = [w if i in fixed or rnd.random() >= share else rnd.choice(["the", "license", "software", "zzz"]) for i, w in enumerate(words)]
        around = [rnd.choice(["the", "of", "a", "word", "license", "free"]) for _ in range(20)]
        rows.append((doc_id, " ".join(around[:10] + own + around[10:])))
    found = {r.doc_id: set(r.labels) - set(r.base_labels) for r in license_scan.scan_licenses(docs_of(rows)).collect()}
    granted = missed = 0
    for doc_id, text in rows:
        words, truth = words_of(text), set()
        for label, notice, keys in TEMPLATES:
            own = words_of(notice)
            for start in range(-len(own), len(words)):
                same = sum(0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(own))
                if same >= 0.6 * len(own) and all(holds(words, words_of(k), start - len(own), start + 2 * len(own)) for k in keys):
                    truth.add(label)
                    break
        base = {label for label, phrase in license_scan.BASE if holds(words, phrase.split(), 0, len(words))}
        assert found[doc_id] <= truth
        granted, missed = granted + len(truth - base), missed + len(truth - base - found[doc_id])
    assert granted > 300 and missed <= 0.01 * granted


def test_benchmark_passages_with_substitutions(spark, docs_of, odd_rows):
    rnd = random.Random(9)
    fresh = lambda n: [f"t{rnd.randrange(10**5)}" for _ in range(n)]
    items = [(i, " ".join(fresh(30))) for i in range(6)] + [(6, None), (7, ""), (8, "too short")]
    rows, truth = list(odd_rows), set()
    for i in range(30):
        words = fresh(40)
        if i % 2:
            item = items[i % 6][1].split()
            for at in rnd.sample(range(30), 3):
                item[at] = "changed"
            words[20:20] = item
            truth.add((100 + i, i % 6))
        rows.append((100 + i, " ".join(words).upper()))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for block in (2 << 20, 100):
        found = decontamination.contaminated(docs_of(rows), benchmark, block_bytes=block).collect()
        assert {(r.doc_id, r.item_id) for r in found} == truth
        assert all(r.n_words >= 13 and 100 * r.n_equal >= 80 * r.n_words and r.doc_start - r.item_start == 20 for r in found)
    assert decontamination.contaminated(docs_of([]), benchmark).collect() == []
    assert decontamination.contaminated(docs_of(rows), benchmark.limit(0)).collect() == []


def test_texts_that_share_an_item_id_do_not_depend_on_blocks(spark, docs_of):
    texts = [" ".join(f"s{i}x{k}" for k in range(20 + i)) for i in range(8)]
    benchmark = spark.createDataFrame([(7, t) for t in texts[:5]] + [(None, t) for t in texts[5:]], "item_id long, text string")
    docs = docs_of([(1, " ".join(texts)), (1, " ".join(texts)), (2, texts[0]), (None, texts[6])])
    found = [sorted(map(str, decontamination.contaminated(docs, benchmark, block_bytes=b).collect())) for b in (2 << 20, 40, 300)]
    assert found[0] == found[1] == found[2] and len(found[0]) == 18


def longest_run(equal, words, percent):
    """Words and equal words of the longest run that is valid, by trying all."""
    n = len(equal)
    runs = [(j - i, sum(equal[i:j])) for i in range(n) for j in range(i + words, n + 1) if 100 * sum(equal[i:j]) >= percent * (j - i)]
    return max(runs, default=None)


def test_every_substitution_pattern_that_is_alike_enough_is_an_overlap():
    overlap = decontamination.Overlap()
    for n in range(13, 21):
        for changed in range(n // 5 + 1):
            for at in itertools.combinations(range(n), changed):
                equal = np.ones(n, bool)
                equal[list(at)] = False
                assert decontamination.best_overlap(equal, overlap) == (0, n, n - changed)
    rnd = random.Random(10)
    for _ in range(500):
        equal = np.array([rnd.random() < 0.75 for _ in range(rnd.randrange(1, 30))])
        got, truth = decontamination.best_overlap(equal, overlap), longest_run(equal.tolist(), 13, 80)
        assert (got and got[1:]) == truth
        assert got is None or sum(equal[got[0] : got[0] + got[1]]) == got[2]


def test_documents_with_any_pattern_that_shares_a_seed_are_found(spark, docs_of):
    masks, item = decontamination.Overlap().masks, [f"i{k}" for k in range(13)]
    rows, truth = [], set()
    for changed in range(3):
        for at in itertools.combinations(range(13), changed):
            doc_id, words = len(rows), [f"x{k}" if k in at else w for k, w in enumerate(item)]
            rows.append((doc_id, " ".join(["before", *words, "after"])))
            fits = ((m, p) for m in masks for p in range(13 - len(m) + 1))
            if any(all(bit == "0" or p + k not in at for k, bit in enumerate(m)) for m, p in fits):
                truth.add((doc_id, 1, 0, 13, 13 - changed))
    found = decontamination.contaminated(docs_of(rows), spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")).collect()
    assert {(r.doc_id, r.doc_start, r.item_start, r.n_words, r.n_equal) for r in found} == truth
    assert (len(rows), len(truth)) == (92, 90)


def test_repeated_items_are_sent_once(spark, docs_of, monkeypatch):
    sent, index = [], decontamination.seed_index
    monkeypatch.setattr(decontamination, "seed_index", lambda ids, *rest: sent.append(len(ids)) or index(ids, *rest))
    texts = [" ".join(f"d{i}x{k}" for k in range(20)) for i in range(20)]
    rows = [(i, "a b " + t) for i, t in enumerate(texts)]
    once = [(i, t) for i, t in enumerate(texts)]
    found = []
    for items in (once, once + [(0, texts[0])] * 200):
        benchmark = spark.createDataFrame(items, "item_id long, text string")
        found.append(sorted(decontamination.contaminated(docs_of(rows), benchmark, block_bytes=1 << 14).collect()))
    assert sent == [20, 20] and found[0] == found[1]
    assert [(r.doc_id, r.item_id, r.n_words) for r in found[0]] == [(i, i, 20) for i in range(20)]


def test_token_counts(docs_of, odd_rows):
    import sentencepiece
    from tokenizers import Tokenizer, models

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    vocabulary = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]
    unigram = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    count = lambda t: len(unigram.encode("▁" + t.replace(" ", "▁"), add_special_tokens=False).ids) if t else 0
    rows = odd_rows + [(50, "日本語 ó̈x\n\n  z"), (51, "x" * 300), (52, "▁a▁ ▁"), (53, "<0x0A> <unk>")] + [(200 + i, t) for i, t, _ in fakes(20)]
    found = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs_of(rows)).collect()}
    assert found == {d: count(t) for d, t in rows}
    assert token_counts.count_tokens(docs_of([])).collect() == []


def test_ties_go_to_the_earliest_start():
    auto = token_counts.automaton([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0)])
    for text, n in ((b"ab", 1), (b"aba", 1), (b"abab", 2), (b"x", 1), (b"xa", 2)):
        assert token_counts.best_count(auto, text) == n
        data = np.frombuffer(text, np.uint8)
        assert token_counts.best_counts(auto, data, np.array([0]), np.array([len(text)])).tolist() == [n]


def test_fingerprints(docs_of, odd_rows):
    rows = [(i, t) for i, t, _ in fakes(40, 4)] + [(300, "y"), (301, "y"), *((d + 400 if d else d, t) for d, t in odd_rows)]
    found = {r.doc_id: r for r in fingerprints.fingerprint_documents(docs_of(rows)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for (doc_id, text), (after, following) in zip(order, order[1:] + order[:1]):
        text, following, r = text or "", following or "", found[doc_id]
        cut = len(text) // 4
        assert (r.n_chars, r.edited) == (len(text), text[: len(text) - cut] + following[:cut])
        shingles = lambda t: {tuple(w[i : i + 5]) for w in [t.split()] for i in range(max(1, len(w) - 4))} if t.split() else set()
        one, two, three = shingles(text), shingles(r.edited), shingles(following)
        likeness = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        assert r.near_edited == pytest.approx(likeness(one, two)) and r.near_next == pytest.approx(likeness(one, three))
        assert len(r.sketch) == r.shingles == len(one)
    assert found[300].sketch == found[301].sketch
    assert fingerprints.fingerprint_documents(docs_of([])).collect() == []
    assert len(fingerprints.fingerprint_documents(docs_of([(1, "a b"), (1, "a b"), (1, "c"), (None, "d")])).collect()) == 4


def test_sketches_merge_across_parts(spark):
    parts = spark.createDataFrame([(1, [1, 3, 5]), (1, [2, 3]), (2, []), (1, None)], "g int, s array<long>")
    merged = {r.g: r.s for r in fingerprints.merged_over(parts, ["g"], "s", 3).collect()}
    assert merged == {1: [1, 2, 3], 2: []}
