"""The n-gram join against all pairs."""

import random
import re

import pytest

from tests.llm.fixtures import documents, sample
from tracklore.llm import ngram_join
from tracklore.llm.ngram_join import ngram_jaccard_join


def _brute_in_order(rows, n, percent):
    """(id, size, root) of each row; rows of one class have one root, and rows without words are classes of their own."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    return [(key, len(sets[i]), root(i)) for i, (key, _) in enumerate(rows)]


def _brute(rows, n, percent):
    found, least = _brute_in_order(rows, n, percent), {}
    for key, _, r in found:
        least[r] = min((x for x in (least.get(r), key) if x is not None), default=None)
    return sorted((repr(key), size, repr(least[r])) for key, size, r in found)


def _rows():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(120)]
    passage = [rng.choice(words) for _ in range(40)]
    rows = []
    for i in range(60):  # a chain of edits: neighbours are linked, ends are not
        if i % 2:
            base[rng.randrange(120)] = rng.choice(words)
        rows.append((i, " ".join(base)))
    for i in range(60, 90):  # a shared passage among other words
        rows.append((i, " ".join([rng.choice(words) for _ in range(rng.randrange(60))] + passage + [rng.choice(words) for _ in range(10)])))
    rows += [(90, rows[3][1].upper()), (91, None), (92, ""), (93, " \n"), (94, "one Two"), (95, "ONE two"), (96, "one two"), (90, "twice the same id"), (97, "a " * 500), (98, "a " * 3000), (None, rows[0][1]), (None, "alone here")]
    return rows + sample()[:80]


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_equals_all_pairs(spark, n, percent):
    rows = [(k if i < 102 or k is None else k + 1000, t) for i, (k, t) in enumerate(_rows())]
    out = ngram_jaccard_join(documents(spark, rows), n, percent).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in out) == _brute(rows, n, percent)


@pytest.mark.parametrize("block", [150, 1_000_000])
def test_near_copies_apart_from_their_leader(spark, monkeypatch, block):
    """Many edits of one text, most too far from it and from each other to be linked, some in pairs that are; in one block and in many."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "FRAGMENT", 20_000)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(900)]
    base = [rng.choice(words) for _ in range(100)]
    rows = [(0, " ".join(base))]
    for i in range(1, 90):
        if i % 3 == 2:  # an edit of the row before
            text = rows[-1][1].split()
            text[rng.randrange(100)] = rng.choice(words)
        else:
            text = list(base)
            for _ in range(rng.choice([1, 3, 5, 7])):
                text[rng.randrange(100)] = rng.choice(words[:40])
        rows.append((i, " ".join(text)))
    line = "this one line is common to all of these"
    rows += [(100 + i, f"{line} {' '.join(rng.choice(words) for _ in range(12))}") for i in range(40)]
    out = ngram_jaccard_join(documents(spark, rows), 4, 85).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in out) == _brute(rows, 4, 85)


def test_buffers_of_the_same_documents_in_another_order(spark, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(30)) for _ in range(3)]
    near = texts[0].split()
    near[3] = "other"
    orders = [(0, 1, 2), (2, 1, 0), (1, 0, 2)]
    packed = [list(ngram_join._pack([texts[i].encode() for i in order], 4, 2)) for order in orders]
    assert len({rows[0][2] for rows in packed}) == 3
    rows = [(10 * k + i, texts[j]) for k, order in enumerate(orders) for i, j in enumerate(order)] + [(99, " ".join(near))]
    docs = documents(spark, rows[:3]).union(documents(spark, rows[3:6])).union(documents(spark, rows[6:]))
    out = ngram_jaccard_join(docs, 4, 70).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in out) == _brute(rows, 4, 70)


def test_empty_table_and_clashing_names(spark):
    docs = documents(spark, [(2, "a b c d e f"), (1, "a b c d e f")]).withColumnRenamed("source", "component_id").withColumnRenamed("lang", "set_id")
    assert ngram_jaccard_join(docs.limit(0)).count() == 0
    assert {r.component_id for r in ngram_jaccard_join(docs).collect()} == {1}
