"""Word-piece counts against greedy matching, and held-out accuracy of the toxicity chain."""

import math
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tests.llm.fixtures import documents, sample
from tracklore.llm import toxicity
from tracklore.llm.wordpiece import Automaton, count_tokens, pieces_of

PATH = public_tokenizers.path("piece_bpe_32k.model")


def _greedy(word, starts, insides):
    at, n, pieces = 0, 0, starts
    while at < len(word) or pieces is starts:
        end = next((e for e in range(len(word), at - 1, -1) if word[at:e] in pieces and (e > at or pieces is starts)), None)
        if end is None:
            return 0
        at, n, pieces = end, n + 1, insides
        if at == len(word):
            break
    return n


def test_automaton_equals_greedy_matching():
    rng = random.Random(1)
    for _ in range(300):
        make = lambda k: {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 5))) for _ in range(k)}
        starts, insides = make(4), make(5)
        if rng.random() < 0.5:
            starts.add("")
        automaton = Automaton(starts, insides)
        for _ in range(30):
            word = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 9)))
            assert automaton.count(word) == _greedy(word, starts, insides), (starts, insides, word)


def test_counts_of_documents(spark):
    starts, insides = map(set, pieces_of(PATH))
    rows = [(i, t[:2000]) for i, t in sample()[:40]] + [(900, None), (901, ""), (902, "\U0001f600 漢字 ok"), (903, "a" * 5000), (904, "x y"), (904, "x y")]
    out = count_tokens(documents(spark, rows).withColumnRenamed("source", "n_tokens"), PATH).collect()
    want = []
    for i, t in rows:
        each = [_greedy(w, starts, insides) for w in (t or "").encode().split() for w in [w.decode()]]
        want.append((i, len(each), sum(max(1, n) for n in each), sum(n == 0 for n in each)))
    assert sorted((r.doc_id, r.n_words, r.n_tokens, r.n_unknown) for r in out) == sorted(want)
    assert count_tokens(documents(spark, []), PATH).count() == 0


def _plain_features(text):
    words = (text or "").encode().lower().split()
    return {(0, w) for w in words} | {(k, w[:k]) for w in words for k in (4, 5, 7) if len(w) > k}


def _plain_fit(sets, labels, earlier):
    """Names, weights of names and of earlier categories, and bias: one feature and one text at a time."""
    n, positive = len(labels), sum(labels)
    bias = math.log((positive + 0.5) / (n - positive + 0.5))
    if positive in (0, n):
        return [], np.zeros(0), np.zeros(earlier.shape[1]), bias
    names = []
    for name in sorted({x for s in sets for x in s}):
        df, hits = sum(name in s for s in sets), sum(y for s, y in zip(sets, labels) if name in s)
        if df >= 4:
            rate, base = min(max(hits / df, 1e-9), 1 - 1e-9), positive / n
            if hits * math.log(rate / base) + (df - hits) * math.log((1 - rate) / (1 - base)) > 3:
                names.append(name)
    x = np.array([[float(name in s) for name in names] + list(e) + [1.0] for s, e in zip(sets, earlier)], np.float32)
    penalty = np.array([0.3] * (x.shape[1] - 1) + [0], np.float32)
    step = 1 / (float(x.sum(1).max() * x.sum(0).max()) ** 0.5 + 0.3)
    last = at = np.array([0.0] * (x.shape[1] - 1) + [bias], np.float32)
    y = np.array(labels, np.float32)
    for k in range(150):
        new = at - step * (x.T @ (1 / (1 + np.exp(-np.clip(x @ at, -30, 30))) - y) + penalty * at)
        at, last = new + k / (k + 3) * (new - last), new
    return names, last[: len(names)], last[len(names) : -1], last[-1]


def _plain_score(model, sets, earlier):
    names, weights, before, bias = model
    margin = [bias + sum(w for name, w in zip(names, weights) if name in s) + float(np.dot(before, e)) for s, e in zip(sets, earlier)]
    return np.array([1 / (1 + math.exp(-min(max(m, -30), 30))) for m in margin])


def test_chain_equals_plain_python(spark):
    """Features, folds, out-of-fold probabilities as inputs of the later link, thresholds and scores."""
    rng = random.Random(3)
    good, bad, rest = ([f"{p}{i}word" for i in range(12)] for p in ("good", "bad", "rest"))
    rows = []
    for i in range(160):
        poor, toxic = int(rng.random() < 0.4), int(rng.random() < 0.3)
        words = [rng.choice(rest) for _ in range(12)] + [rng.choice(bad if toxic else good) for _ in range(3)] + ([rng.choice(rest).upper() + "###"] * 4 if poor else [])
        rows.append((i, " ".join(words), poor, toxic if rng.random() < 0.95 else 1 - toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, poor int, toxic int")
    order = [r.doc_id for r in docs.orderBy(F.xxhash64("doc_id"), F.xxhash64("text"), "poor", "toxic").collect()]
    sets, labels = [_plain_features(rows[i][1]) for i in order], [[rows[i][2] for i in order], [rows[i][3] for i in order]]
    earlier, models, cuts = np.zeros((160, 0)), [], []
    for y in labels:
        out = np.zeros(160)
        for fold in range(5):
            train = [i for i in range(160) if i % 5 != fold]
            model = _plain_fit([sets[i] for i in train], [y[i] for i in train], earlier[train])
            test = [i for i in range(160) if i % 5 == fold]
            out[test] = _plain_score(model, [sets[i] for i in test], earlier[test])
        models.append(_plain_fit(sets, y, earlier))
        points = sorted(set(out))
        tried = [(a + b) / 2 for a, b in zip(points, points[1:])] + [0.5]
        cuts.append(min(tried, key=lambda c: (sum((p >= c) != t for p, t in zip(out, y)), abs(c - 0.5))))
        earlier = np.column_stack([earlier, out])
    chain = toxicity.fit_chain(docs, ["poor", "toxic"])
    assert [len(x.features) for x in chain] == [len(m[0]) for m in models]
    got = {r.doc_id: r for r in toxicity.score(docs, chain, ["poor", "toxic"]).collect()}
    first = _plain_score(models[0], sets, np.zeros((160, 0)))
    second = _plain_score(models[1], sets, first[:, None])
    for k, i in enumerate(order):
        assert abs(got[i].p_poor - first[k]) < 2e-3 and abs(got[i].p_toxic - second[k]) < 2e-3
    for link, cut in zip(chain, cuts):
        assert abs(link.threshold - cut) < 5e-3


def test_chain_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").selectExpr("doc_id", "1 - quality AS poor", "toxic")
    train = docs.join(labels, "doc_id").filter("doc_id % 4 != 0")
    chain = toxicity.fit_chain(train, ["poor", "toxic"])
    out = toxicity.score(docs.filter("doc_id % 4 = 0"), chain, ["poor", "toxic"]).toPandas()
    truth = pq.read_table(f"{folder}/labels.parquet").to_pandas().set_index("doc_id").toxic
    out = out[out.doc_id.isin(truth.index)]
    toxic = out.doc_id.map(truth) == 1
    assert (out.is_toxic == toxic).mean() > 0.97
    assert out.is_toxic[toxic].mean() > 0.85
    assert out.is_toxic[~toxic].mean() < 0.01


def test_chain_bears_odd_tables(spark):
    docs = documents(spark, [(1, None), (2, ""), (None, "a b"), (4, "a b")])
    chain = toxicity.fit_chain(docs.selectExpr("doc_id", "text", "1 AS toxic"), ["toxic"])
    rows = toxicity.score(docs.withColumnRenamed("lang", "p_toxic"), chain, ["toxic"]).collect()
    assert len(rows) == 4 and all(r.is_toxic for r in rows)
    assert toxicity.fit_chain(docs.limit(0).selectExpr("doc_id", "text", "1 AS toxic"), ["toxic"])[0].bias < 0
    assert toxicity.fit_chain(docs.selectExpr("doc_id", "text", "cast(NULL AS int) AS toxic"), ["toxic"])[0].bias < 0
    assert toxicity.score(docs.limit(0), chain, ["toxic"]).count() == 0
