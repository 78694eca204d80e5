"""Each stage of the pipeline on its own input, against plain Python."""

import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from tests.llm.fixtures import documents
from tests.llm.test_maps import _tiktoken, verdict
from tests.llm.test_mixing import _taken, _targets
from tests.llm.test_ngram_join import _brute_in_order

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    from tracklore.llm._work import Work

    work, docs = Work(spark, "test"), spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = work.cut(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_rows_of_every_stage(stages):
    """Each stage's rows, whole, from those of the stage before, in plain Python."""
    columns = stages[0].columns
    assert all(x.columns == columns for x in stages[:-1])
    at = {c: i for i, c in enumerate(columns)}
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    given = _rows(stages[0])
    kept = [r for r in given if verdict(model, r[at["text"]] or "", r[at["lang"]])]
    assert _rows(stages[1]) == kept and len(kept) < len(given)

    class_of = [c for _, _, c in _brute_in_order([(r[at["doc_id"]], r[at["text"]]) for r in kept], 5, 80)]
    least = {}
    for r, c in zip(kept, class_of):
        least[c] = min(least.get(c, r), r, key=lambda x: x[at["doc_id"]])
    assert _rows(stages[2]) == sorted(least.values(), key=repr) and len(least) < len(kept)

    seen, left = set(), []
    for r in sorted(least.values(), key=lambda x: x[at["doc_id"]]):
        data = r[at["text"]].encode()
        cover = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            if data[i : i + 100] in seen:
                cover[i : i + 100] = True
            seen.add(data[i : i + 100])
        text, k = "", 0
        for c in r[at["text"]]:
            size = len(c.encode())
            text += "" if cover[k : k + size].all() else c
            k += size
        if not cover.any() or text.strip(" "):
            row = list(r)
            row[at["text"]], row[at["n_chars"]] = text, len(text)
            left.append(tuple(row))
    assert _rows(stages[3]) == sorted(left, key=repr)
    assert any(a[at["text"]] != b[at["text"]] for a, b in zip(sorted(left, key=repr), sorted(least.values(), key=repr)))

    word = re.compile(r"[^\x20\x09-\x0D]+")
    queue = [(r[at["doc_id"]], r[at["text"]], r[at["source"]], len(word.findall(r[at["text"]]))) for r in left]
    sizes = {s: sum(x[3] for x in queue if x[2] == s) for s in {x[2] for x in queue}}
    mixed = []
    for r, (_, text, _, size), taken in zip(left, queue, _taken(queue, _targets(sizes), sizes)):
        texts = [text] * (taken // size if size else 0) + ([" ".join(word.findall(text)[: taken % size])] if size and taken % size else [])
        for t in texts:
            row = list(r)
            row[at["text"]], row[at["n_chars"]] = t, len(t)
            mixed.append(tuple(row))
    assert _rows(stages[4]) == sorted(mixed, key=repr)

    encoder = _tiktoken()
    want = [(r[at["doc_id"]], r[at["source"]], np.array(encoder.encode_ordinary(r[at["text"]]), "<u4").tobytes(), True) for r in mixed]
    assert sorted((r.doc_id, r.source, bytes(r.ids), r.round_trip) for r in stages[5].collect()) == sorted(want)


def test_odd_documents(spark):
    docs = documents(spark, [(1, None), (2, ""), (None, "a b"), (3, "x " * 50), (3, "x " * 50)])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() >= 0
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_one_row_of_each_group_stays(spark):
    t, u = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    near, other = t + " end", " ".join(f"z{i}" for i in range(60))

    def stay(*rows):
        out = corpus_pipeline.near_duplicates(spark, documents(spark, rows), SF)
        assert out.columns == documents(spark, []).columns
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)

    assert stay((3, t), (3, t)) == [(3, t)]
    assert stay((None, t), (None, t), (5, t)) == [(5, t)]
    assert stay((3, t), (7, t), (7, u)) == [(3, t), (7, u)]
    assert stay((None, t), (None, near), (None, u)) in ([(None, u), (None, t)], [(None, u), (None, near)])
    assert stay((4, t, "a"), (4, t, "b"), (4, t, "a"), (4, near), (2, other), (2, other)) in ([(2, other), (4, t)], [(2, other), (4, near)])
    assert stay((1, None), (1, None), (None, ""), (None, ""), (2, " ")) == sorted([(1, None), (1, None), (None, ""), (None, ""), (2, " ")], key=repr)


def test_a_repeated_row_is_mixed_once(spark):
    t = " ".join(f"w{i}" for i in range(60))
    docs = documents(spark, [(3, t), (3, t), (None, t), (None, t), (9, t)])
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.repeated_passages, corpus_pipeline.source_mixing):
        docs = stage(spark, docs, SF)
    assert [(r.doc_id, r.text) for r in docs.collect()] == [(3, t)]
