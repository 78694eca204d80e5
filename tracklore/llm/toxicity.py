"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other. A category's model is a logistic regression on which of its chosen features a
text has, and on the probabilities of the categories before it; for the training of later models these come from FOLDS
models that have not seen the text. Features are words, and their beginnings of PREFIXES bytes, in lower case; each model
chooses the CHOSEN features with the largest likelihood ratios among those of LEAST texts or more.

The chain is fitted on at most SAMPLE labelled rows, those with the smallest hashes of their ids: a bounded sample, and the
only one. A category's threshold is the one with the fewest errors in the out-of-fold probabilities. Scores are computed for
all rows, over whole texts.

Null text has no features and the probability of a text without any. Rows with a null label in any category are not used
for training; where a category has one label only, its probability is that label's share. Repeated rows are scored alike;
other columns pass unchanged, those named like results are replaced. An empty table gives an empty table."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklore.llm._hash import Words, byte_values, mix, prefix, span
from tracklore.llm import _work
from tracklore.llm._work import aside, bounded_batches, groups_of, held, restored, texts_of

SAMPLE = 8192
FOLDS = 5
CHOSEN = 1024
LEAST = 4
PREFIXES = (4, 5, 7)
ROUNDS = 150
PENALTY = 0.3


@dataclass
class Link:
    """One model of the chain: sorted feature hashes, weights (of features, of earlier categories), bias, threshold."""

    features: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float
    threshold: float


def _features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every feature, with repeats."""
    words = Words(texts, lower=True)
    if not len(words.hash):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums, owner = prefix(byte_values(words.buffer)), words.owner()
    owners, hashes = [owner], [words.hash]
    for k in PREFIXES:
        longer = words.end - words.start > k
        at = words.start[longer]
        owners.append(owner[longer])
        hashes.append(mix(span(sums, at, at + k) + np.uint64(k)))
    return np.concatenate(owners), np.concatenate(hashes)


def _present(texts: list[bytes], features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, place in the sorted features) pairs."""
    owner, hashes = _features(texts)
    if not len(hashes) or not len(features):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mask = np.uint64(2**20 - 1)
    maybe = np.zeros(2**20, bool)
    maybe[(features & mask).astype(np.int64)] = True
    some = maybe[(hashes & mask).astype(np.int64)]
    owner, hashes = owner[some], hashes[some]
    place = np.minimum(np.searchsorted(features, hashes), len(features) - 1)
    hit = features[place] == hashes
    pair = np.unique(owner[hit] * len(features) + place[hit])
    return pair // len(features), pair % len(features)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _fit(rows: np.ndarray, columns: np.ndarray, count: int, names: np.ndarray, labels: np.ndarray, earlier: np.ndarray) -> Link:
    """A logistic regression on the training texts: features chosen by likelihood ratio, then accelerated descent."""
    n, positive = len(labels), int(labels.sum())
    none = Link(np.zeros(0, np.uint64), np.zeros(0), np.zeros(earlier.shape[1]), float(np.log((positive + 0.5) / (n - positive + 0.5))), 0.5)
    if positive in (0, n):
        return none
    df = np.bincount(columns, minlength=count).astype(float)
    hits = np.bincount(columns, weights=labels[rows].astype(float), minlength=count)
    base = positive / n
    rate = np.clip(hits / np.maximum(df, 1), 1e-9, 1 - 1e-9)
    gain = hits * np.log(rate / base) + (df - hits) * np.log((1 - rate) / (1 - base))
    gain[df < LEAST] = -1
    best = np.sort(np.argsort(-gain, kind="stable")[:CHOSEN])
    best = best[gain[best] > 3]
    place = np.full(count, -1)
    place[best] = np.arange(len(best))
    use = place[columns] >= 0
    x = np.zeros((n, len(best) + earlier.shape[1] + 1), np.float32)
    x[rows[use], place[columns[use]]] = 1
    x[:, len(best) : -1] = earlier
    x[:, -1] = 1
    w = np.zeros(x.shape[1], np.float32)
    w[-1] = none.bias
    penalty = np.full(len(w), PENALTY, np.float32)
    penalty[-1] = 0
    step = 1 / (0.25 * float((x.sum(1) ** 1).max() * x.sum(0).max()) ** 0.5 * 4 + PENALTY)
    at, last = w.copy(), w.copy()
    for k in range(ROUNDS):
        slope = x.T @ (_sigmoid(x @ at) - labels) + penalty * at
        w = at - step * slope
        at = w + (k / (k + 3)) * (w - last)
        last = w
    return Link(names[best], w[: len(best)].astype(float), w[len(best) : -1].astype(float), float(w[-1]), 0.5)


def _margin(link: Link, rows: np.ndarray, hashes: np.ndarray, n: int, earlier: np.ndarray) -> np.ndarray:
    out = np.full(n, link.bias) + earlier @ link.earlier
    if len(link.features):
        place = np.minimum(np.searchsorted(link.features, hashes), len(link.features) - 1)
        hit = link.features[place] == hashes
        out += np.bincount(rows[hit], weights=link.weights[place[hit]], minlength=n)
    return out


def bounded(labels: DataFrame, categories: list[str], key: str = "doc_id") -> DataFrame:
    """At most SAMPLE labelled rows, so small that they may be broadcast to their documents."""
    good = labels.filter(F.forall(F.array(*(F.col(c).isNotNull() for c in categories)), lambda x: x))
    return good.orderBy(F.xxhash64(key), *categories).limit(SAMPLE)


def fit_chain(labelled: DataFrame, categories: list[str], key: str = "doc_id", text: str = "text") -> list[Link]:
    """The chain, in the order of the categories (columns of 0 and 1)."""
    bounded_batches(labelled.sparkSession)
    good = labelled.filter(F.forall(F.array(*(F.col(c).isNotNull() for c in categories)), lambda x: x))
    sample = good.orderBy(F.xxhash64(key), F.xxhash64(text), *categories).limit(SAMPLE).select(F.coalesce(text, F.lit("")).alias("text"), *(F.col(c).cast("int").alias(f"c{i}") for i, c in enumerate(categories)))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(_features([t])[1]).tobytes() for t in texts_of(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), *batch.columns[1:]], ["features", *batch.schema.names[1:]])

    table = sample.mapInArrow(features, T.StructType([T.StructField("features", T.BinaryType()), *(T.StructField(f"c{i}", T.IntegerType()) for i in range(len(categories)))])).toArrow()
    n = table.num_rows
    if not n:
        return [Link(np.zeros(0, np.uint64), np.zeros(0), np.zeros(i), -30.0, 0.5) for i in range(len(categories))]
    sets = [np.frombuffer(x, np.uint64) for x in table.column(0).to_pylist()]
    rows, hashes = np.repeat(np.arange(n), [len(x) for x in sets]), np.concatenate(sets)
    names, columns, df = np.unique(hashes, return_inverse=True, return_counts=True)
    often = df >= LEAST
    place = np.cumsum(often) - 1
    use = often[columns]
    rows, columns, names = rows[use], place[columns[use]], names[often]
    fold = np.arange(n) % FOLDS
    earlier, chain = np.zeros((n, 0)), []
    for i in range(len(categories)):
        labels = table.column(i + 1).to_numpy().astype(np.float32)
        out = np.zeros(n)
        for k in range(FOLDS):
            train, test = fold != k, fold == k
            new = np.cumsum(train) - 1
            inside = train[rows]
            link = _fit(new[rows[inside]], columns[inside], len(names), names, labels[train], earlier[train])
            out[test] = _sigmoid(_margin(link, rows, names[columns], n, earlier))[test]
        link = _fit(rows, columns, len(names), names, labels, earlier)
        order = np.sort(np.unique(out))
        cuts = np.append((order[1:] + order[:-1]) / 2, 0.5)
        sorted_out, at = np.sort(out), np.argsort(out)
        ones = np.append(0, np.cumsum(labels[at]))
        below = np.searchsorted(sorted_out, cuts)
        errors = ones[below] + (n - below) - (ones[-1] - ones[below])
        link.threshold = float(cuts[np.lexsort((np.abs(cuts - 0.5), errors))[0]])
        chain.append(link)
        earlier = np.column_stack([earlier, out])
    return chain


def score(docs: DataFrame, chain: list[Link], categories: list[str], text: str = "text") -> DataFrame:
    """docs, without the text, with p_<category> and is_<category> for each category."""
    results = [*(f"p_{c}" for c in categories), *(f"is_{c}" for c in categories)]
    kept = [c for c in docs.columns if c not in (*results, text)]
    own = docs.select(aside(kept), F.col(text).alias("_text"))
    schema = T.StructType([own.schema["_kept"], *(T.StructField(r, T.DoubleType() if r.startswith("p_") else T.BooleanType()) for r in results)])
    every = np.unique(np.concatenate([x.features for x in chain]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("toxicity", object)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for a, b in groups_of(texts, 1_000_000):
                rows, place = _present(texts[a:b], every)
                earlier = np.zeros((b - a, 0))
                for link in chain:
                    p = _sigmoid(_margin(link, rows, every[place], b - a, earlier))
                    earlier = np.column_stack([earlier, p])
                made = [*(pa.array(earlier[:, i]) for i in range(len(chain))), *(pa.array(earlier[:, i] >= x.threshold) for i, x in enumerate(chain))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *made], schema.names)

    return _work.bounded(own, run, schema).select(*restored(kept), *results)
