"""Removal of repeated byte strings against brute force."""

import ast
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.fixtures import documents, sample
from tracklore.llm.suffix_array import multikey_order, remove_repeats


def _brute(rows, width):
    docs = list(dict.fromkeys(rows))
    seen, result = set(), {}
    for doc in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0)):
        text = (doc[1] or "").encode()
        cover = np.zeros(len(text), bool)
        for s in range(len(text) - width + 1):
            if text[s : s + width] in seen:
                cover[s : s + width] = True
            seen.add(text[s : s + width])
        edges = np.diff(np.concatenate(([0], cover.astype(int), [0])))
        result[doc] = (len(text), int(cover.sum()), int((edges == 1).sum()), bytes(np.frombuffer(text, np.uint8)[~cover]))
    return sorted(repr((x[0], *result[x])) for x in rows)


def _got(docs, width, gram):
    out = remove_repeats(docs, width, gram=gram).collect()
    return sorted(repr((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes))) for r in out)


@pytest.mark.parametrize(("width", "gram"), [(20, 8), (40, 16), (100, 32)])
def test_equals_brute_force(spark, width, gram):
    rng = random.Random(width)
    letters = "abcdé "
    passages = ["".join(rng.choice(letters) for _ in range(rng.randrange(width - 3, 3 * width))) for _ in range(5)]
    rows = []
    for i in range(50):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(3 * width)))
        for _ in range(rng.randrange(3)):
            k = rng.randrange(len(text) + 1)
            text = text[:k] + rng.choice(passages) + text[k:]
        rows.append((i, text))
    rows += [(60, None), (61, ""), (62, "a" * 400), (63, "ab" * 300), (64, "漢" * 150), (None, rows[3][1]), (5, rows[5][1]), (65, rows[7][1]), (66, rows[7][1])]
    rows += [(1000 + k, t[:3000]) for k, t in sample()[:30]]
    assert _got(documents(spark, rows), width, gram) == _brute(rows, width)


def test_a_token_over_many_buckets(spark, monkeypatch):
    from tracklore.llm import suffix_array

    monkeypatch.setattr(suffix_array, "BUCKET", 5_000)
    rng = random.Random(1)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(150))
    rows = [(i, "".join(rng.choice("ijklmn ") for _ in range(i % 90)) + passage + "".join(rng.choice("opq ") for _ in range(i % 70))) for i in range(120)]
    assert _got(documents(spark, rows), 100, 32) == _brute(rows, 100)


def _shared_left(rng, width):
    """Copies of a passage in two groups: those of a group have the same bytes left of it, so other tokens are chosen there."""
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, lefts = word(2 * width), [word(width) for _ in range(2)]
    return [(i, word(rng.randrange(20)) + lefts[i % 8 // 4] + passage[rng.randrange(20) :] + word(rng.randrange(20))) for i in range(16)]


def test_groups_that_share_left_contexts_at_every_cut():
    from tracklore.llm.suffix_array import _bucket, _sampled

    width, gram = 40, 16
    for seed in range(30):
        rows = _shared_left(random.Random(seed), width)
        texts = [t.encode() for _, t in rows]
        owner, place, _ = _sampled(texts, width, gram)
        found = [(texts[d][p : p + gram], d, p) for d, p in zip(owner.tolist(), place.tolist())]
        many = Counter(x[0] for x in found)
        found = sorted(x for x in found if many[x[0]] > 1)
        want = [x[2] for x in sorted(map(ast.literal_eval, _brute(rows, width)))]
        for cut in range(1, len(found), 3):
            cover, firsts = [np.zeros(len(t), bool) for t in texts], {}
            for part in (found[:cut], found[cut:]):
                ids, places = (np.array([x[k] for x in part], np.int64) for k in (1, 2))
                left = [texts[d][max(0, p - width + gram) : p] for _, d, p in part]
                whole = [x + texts[d][p : p + width] for x, (_, d, p) in zip(left, part)]
                offsets = np.append(0, np.cumsum([len(x) for x in whole]))
                data = np.frombuffer(b"".join(whole), np.uint8)
                tables = _bucket(ids, np.zeros(len(part), np.int64), places, data, offsets, np.array([len(x) for x in left]), width, gram, 1)
                for r in [r for table in tables for r in table.to_pylist()]:
                    if r["strings"] is not None:
                        for string, (d, _, start) in zip(np.frombuffer(r["strings"], np.uint64).tolist(), np.frombuffer(r["firsts"], np.int64).reshape(-1, 3).tolist()):
                            firsts.setdefault(string, []).append((d, start))
                        continue
                    counts = np.frombuffer(r["counts"], np.uint32)
                    for d, (a, k) in zip(np.repeat(np.frombuffer(r["ids"], np.int64), counts), np.frombuffer(r["values"], np.uint32).reshape(-1, 2)):
                        cover[d][a : a + k - 1 + width] = True
            for places in firsts.values():
                for d, a in set(places) - {min(places)}:
                    cover[d][a : a + width] = True
            assert [int(x.sum()) for x in cover] == want, (seed, cut)


@pytest.mark.parametrize("size", [2_000, 4_000])
def test_groups_that_share_left_contexts_in_small_buckets(spark, monkeypatch, size):
    from tracklore.llm import suffix_array

    monkeypatch.setattr(suffix_array, "BUCKET", size)
    rng = random.Random(size)
    rows = [(100 * k + i, t) for k in range(6) for i, t in _shared_left(rng, 100)]
    assert _got(documents(spark, rows), 100, 32) == _brute(rows, 100)


def test_long_texts_in_stretches(spark, monkeypatch):
    from tracklore.llm import suffix_array

    monkeypatch.setattr(suffix_array, "STRETCH", 150)
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(170))
    rows = [(i, "".join(rng.choice("ijk ") for _ in range(rng.randrange(400))) + passage + "".join(rng.choice("ijk ") for _ in range(rng.randrange(400)))) for i in range(12)]
    assert _got(documents(spark, [*rows, (99, "ab" * 300)]), 40, 16) == _brute([*rows, (99, "ab" * 300)], 40)


def test_kept_text_has_whole_characters(spark):
    rows = [(1, "x" + "é" * 60 + "y"), (2, "ü" + "é" * 60 + "z")]
    for r in remove_repeats(documents(spark, rows), 100).collect():
        r.kept_text.encode()


@pytest.mark.parametrize(("width", "gram"), [(16, 8), (24, 8)])
def test_strings_that_end_in_zero_bytes(spark, width, gram):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice("a\0\0\0") for _ in range(rng.randrange(60)))) for i in range(80)]
    assert _got(documents(spark, rows), width, gram) == _brute(rows, width)


def test_rows_that_repeat_all(spark):
    rows = [(3, "x " * 50)] * 2
    assert _got(documents(spark, rows), 100, 32) == _brute(rows, 100)


def test_empty_table_and_clashing_names(spark):
    docs = documents(spark, [(1, "a b"), (2, "a b")]).withColumnRenamed("source", "n_spans").withColumnRenamed("lang", "lead")
    assert remove_repeats(docs.limit(0)).count() == 0
    assert {(r.n_bytes, r.n_spans, r.lead) for r in remove_repeats(docs).collect()} == {(3, 0, "en")}


def test_multikey_order_is_lexicographic():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 3, (500, 4)).astype(np.uint64)
    order = multikey_order(rows)
    assert [tuple(x) for x in rows[order]] == sorted(map(tuple, rows))
    groups = rng.integers(0, 5, 500)
    order = multikey_order(rows, groups)
    assert [(g, *x) for g, x in zip(groups[order], rows[order])] == sorted((g, *x) for g, x in zip(groups, rows))
