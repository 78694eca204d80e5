"""Mixing against a queue in plain Python."""

import hashlib
import random

from tests.llm.fixtures import documents
from tracklore.llm.mixing import mix, mixed_documents, targets


def _targets(sizes, weights=(5, 2, 1), repeats=3):
    """Sharing again and again, until no target is above its most."""
    names = sorted((s for s in sizes if s is not None), key=lambda x: x.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, stopped, total = {}, set(), sum(sizes.values())
    while True:
        rest = total - sum(repeats * sizes[s] for s in stopped)
        open_ = [s for s in names if s not in stopped]
        level = rest / sum(weight[s] for s in open_) if open_ else 0
        target = {s: repeats * sizes[s] if s in stopped else level * weight[s] for s in names}
        above = [s for s in open_ if target[s] > repeats * sizes[s]]
        if not above:
            return target
        stopped.update(above)


def _taken(rows, target, sizes, repeats=3):
    place = {s: i for i, s in enumerate(sorted((s for s in sizes if s is not None), key=lambda x: x.encode()) + ([None] if None in sizes else []))}
    copies = []
    for s in sizes:
        ahead = 0
        own = sorted((hashlib.md5(str("null" if k is None else k).encode()).hexdigest(), i) for i, (k, _, src, n) in enumerate(rows) if src == s and n)
        for r in range(repeats):
            for digest, i in own:
                ahead += rows[i][3]
                copies.append((ahead / target[s], place[s], r, digest, i))
    left, taken = sum(sizes.values()), [0] * len(rows)
    for *_, i in sorted(copies):
        step = min(left, rows[i][3])
        taken[i] += step
        left -= step
    return taken


def _rows(seed, sources):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        n = rng.choice([0, 1, 3, 10, 50])
        rows.append((i, " ".join(["w"] * n) if n or i % 2 else None, rng.choice(sources), n))
    return rows


def test_equals_plain_queue(spark):
    for seed, sources in ((1, ["a", "b", "é", None]), (2, ["x"]), (3, ["a"] * 30 + ["b", "c", "d"]), (4, [None] * 9 + ["z"])):
        rows = _rows(seed, sources)
        sizes = {s: sum(r[3] for r in rows if r[2] == s) for s in {r[2] for r in rows}}
        target = _targets(sizes)
        want = _taken(rows, target, sizes)
        got = {r.doc_id: r for r in mix(documents(spark, [r[:3] for r in rows])).collect()}
        assert len(got) == len(rows)
        for (k, _, s, n), t in zip(rows, want):
            r = got[k]
            assert (r["size"], r.source_size) == (n, sizes[s])
            assert abs(r.target - target[s]) < 1e-6 * max(1, target[s])
            assert r.taken == t <= 3 * n


def test_mixture_has_the_words_taken(spark):
    docs = documents(spark, [r[:3] for r in _rows(5, ["a", "b", "c"])])
    taken = mix(docs).agg({"taken": "sum"}).first()[0]
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    assert sum(len(r.text.split()) for r in out.collect()) == taken


def test_repeated_rows_nulls_and_empty_tables(spark):
    docs = documents(spark, [(1, "a b", "s"), (1, "a b", "s"), (1, "a b c", "s"), (None, "d", "s"), (None, "d", None), (2, None, None)])
    rows = mix(docs.withColumnRenamed("lang", "target")).collect()
    assert len(rows) == 6
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    assert mix(docs.limit(0)).count() == 0
    assert [r.taken for r in mix(documents(spark, [(1, None), (2, "")])).collect()] == [0, 0]
    assert targets(docs.limit(0).selectExpr("source", "1L as size")).count() == 0
