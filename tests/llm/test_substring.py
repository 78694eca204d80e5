"""Removal of repeated word passages against brute force."""

import random
import re
from collections import defaultdict

import pytest

from tests.llm.fixtures import documents, sample
from tracklore.llm import queries
from tracklore.llm.substring import remove_repeats


def _brute(rows, window):
    docs = list(dict.fromkeys(rows))
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    at = defaultdict(list)
    for d, ws in enumerate(words):
        for i in range(len(ws) - window + 1):
            at[tuple(ws[i : i + window])].append((d, i))
    gone = defaultdict(set)
    for places in at.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + window))
    result = {x: (len(ws), len(gone[d]), " ".join(w for i, w in enumerate(ws) if i not in gone[d])) for d, (x, ws) in enumerate(zip(docs, words))}
    return sorted(map(repr, ((x[0], *result[x]) for x in rows)))


@pytest.mark.parametrize("window", [5, 8, 35])
def test_equals_brute_force(spark, window):
    rng = random.Random(window)
    words = [f"w{i}" for i in range(3000)]
    passages = [[rng.choice(words) for _ in range(rng.randrange(window - 2, 3 * window))] for _ in range(6)]
    rows = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            k = rng.randrange(len(text) + 1)
            text[k:k] = rng.choice(passages)
        rows.append((i, " ".join(text)))
    rows += [(60, None), (61, ""), (62, "a " * 200), (63, "a\nb " * 100), (None, rows[3][1]), (5, rows[5][1]), (5, rows[6][1] + " more"), (64, rows[7][1])]
    rows += [(1000 + k, t) for k, t in sample()[:60]]
    out = remove_repeats(documents(spark, rows), window).collect()
    assert sorted(repr((r.doc_id, r.n_words, r.n_removed, r.kept_text)) for r in out) == _brute(rows, window)


def test_empty_table_and_clashing_names(spark):
    docs = documents(spark, [(1, "a b"), (2, "a b")]).withColumnRenamed("source", "n_words").withColumnRenamed("lang", "fragment")
    assert remove_repeats(docs.limit(0)).count() == 0
    assert {(r.n_words, r.n_removed, r.fragment) for r in remove_repeats(docs).collect()} == {(2, 0, "en")}


def test_repeated_rows_of_the_query_equal_its_sql(spark, tmp_path):
    import duckdb

    a, b, c = (" ".join(f"{x}{i}" for i in range(n)) for x, n in (("a", 80), ("b", 35), ("c", 34)))
    rows = [(3, a), (3, a), (5, b), (5, b), (5, b), (7, c), (7, c), (8, "x " + a + " y"), (9, None), (9, None), (10, "z " * 30)]
    docs = documents(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = [tuple(r) for r in queries.QUERIES["op2_substring_dedup"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(duck.sql(queries.ORACLES["op2_substring_dedup"]).fetchall())
    out = remove_repeats(documents(spark, [(None, a), (None, a), (1, c)]), 35, apart=True).collect()
    assert sorted((r.n_words, r.n_removed, r.kept_text) for r in out) == [(34, 0, c), (80, 80, ""), (80, 80, "")]
