"""Neighbours against brute force: recall, and exact order and scores of what is found."""

import random

import numpy as np

from tracklore.llm.neighbours import nearest
from tracklore.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def _brute(rows, every=20, k=20):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, a in good:
        if q % every == 0:
            scored = []
            for i, b in good:
                if i != q:
                    total = 0.0
                    for x, y in zip(a, b):
                        total += float(np.float32(x)) * float(np.float32(y))
                    scored.append((-total, i))
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def _got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def test_whole_table(spark):
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.001/embeddings.parquet")
    want = _brute(list(zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist())))
    got = _got(QUERIES["op5_nearest_neighbours"](spark, "/root/testdata/sf0.001"))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    for q in want:
        exact = dict(want[q])
        assert all(s == exact[i] for i, s in got[q] if i in exact)


def test_unfit_vectors_ties_and_repeats(spark, monkeypatch):
    from tracklore.llm import neighbours

    monkeypatch.setattr(neighbours, "ROWS", 40)
    monkeypatch.setattr(neighbours, "QUERIES", 3)
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(150)]
    rows += [(200 + i, list(rows[7][1])) for i in range(60)] + [(20, list(rows[20][1]))]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    odd = [(300, None), (320, [0.0] * 8), (340, [float("nan")] * 8), (360, [float("inf")] + [1.0] * 7), (380, [None] + [1.0] * 7), (None, [1.0] * 8), (400, [1.0] * 3), (420, [])]
    df = spark.createDataFrame([(*r, 0) for r in rows + odd], SCHEMA)
    want, got = _brute(rows), _got(nearest(df))
    assert got.keys() == want.keys()
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))


def test_recall_over_many_blocks(spark):
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    ids, v = t["vec_id"].to_numpy(), np.array(t["embedding"].to_pylist(), np.float32).astype(float)
    got = _got(QUERIES["op5_nearest_neighbours"](spark, "/root/testdata/sf0.1"))
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = v @ v[i]
        score[i] = -np.inf
        best = set(ids[np.lexsort((ids, -score))[:20]].tolist())
        hits, total = hits + len(best & {x for x, _ in got[ids[i]]}), total + 20
    assert len(got) == total // 20 and hits >= 0.95 * total


def test_estimates_from_bits():
    from tracklore.llm import neighbours

    rng = np.random.default_rng(5)
    v, q = rng.standard_normal((300, 70)), rng.standard_normal((9, 70))
    turn, centre = neighbours.rotation(70), v.mean(0)
    bits, norm, agree = neighbours.encode(v, centre, turn)
    upper = neighbours._upper(neighbours._words(bits), norm, agree, 70, q @ turn, np.sqrt((q**2).sum(1)))
    assert (upper >= q @ (v - centre).T).mean() > 0.9
    signs = np.unpackbits(bits, axis=1, count=70) * 2.0 - 1
    error = neighbours.ERRORS * norm * np.sqrt((1 / agree**2 - 1) / 69)
    plain = (q @ turn) @ signs.T * norm / (agree * np.sqrt(70)) + np.sqrt((q**2).sum(1))[:, None] * error
    assert np.abs(upper - plain).max() < 0.15 * np.abs(plain).max()


def test_few_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], 0), (1, [2.0, 1.0], 0)], SCHEMA)
    assert _got(nearest(df)) == {0: [(1, 4.0)]}
    assert nearest(df.limit(0)).count() == 0
    assert nearest(df.filter("vec_id = 1")).count() == 0
    assert nearest(df.filter("vec_id = 0")).count() == 0
