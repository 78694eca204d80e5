"""Every operator on clashing and odd columns, repeated and null rows, long texts and empty tables."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import documents
from tracklore.llm import bpe, chat, mixing, neighbours, ngram_join, quality, substring, suffix_array, toxicity, wordpiece

PIECES, RANKS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Working names of the operators, and a map, which can't be hashed or compared.
NAMES = ("_id", "_tie", "_text", "_marks", "_kept", "_key", "_set", "_n", "_comp", "_least", "node", "comp", "set_id", "key", "range", "digest", "row", "place", "ahead", "round", "bucket", "fragment", "source_size", "script", "_source", "part", "index", "query")

OPERATORS = {
    "ngram_join": lambda d: ngram_join.ngram_jaccard_join(d),
    "substring": lambda d: substring.remove_repeats(d, window=5, apart=True),
    "bpe": lambda d: bpe.round_trip(d, RANKS, bpe.PATTERN),
    "mixing": lambda d: mixing.mix(d),
    "mixed": lambda d: mixing.mixed_documents(d),
    "suffix_array": lambda d: suffix_array.remove_repeats(d),
    "wordpiece": lambda d: wordpiece.count_tokens(d, PIECES),
    "quality": lambda d: quality.judge(quality.measure(d, PIECES)),
    "toxicity": lambda d: toxicity.score(d, toxicity.fit_chain(d.withColumns({"poor": F.col("doc_id") % 2, "toxic": F.col("doc_id") % 3 % 2}), ["poor", "toxic"]), ["poor", "toxic"]),
}


def _odd(docs):
    extra = {n: F.concat(F.lit(f"{n} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for n in NAMES}
    return docs.withColumns(extra | {"odd map": F.create_map(F.lit("a"), F.col("doc_id")), "odd.list": F.array("doc_id", F.lit(None))})


ROWS = [(1, "one two three four five six seven"), (1, "one two three four five six seven"), (2, None), (None, "x"), (None, "x"), (3, ""), (4, " \n"), (5, "é漢 " * 40), (6, None, None)]


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_names_and_kinds(spark, name):
    docs = documents(spark, ROWS)
    want, got = OPERATORS[name](docs), OPERATORS[name](_odd(docs))
    new = [c for c in want.columns if c not in docs.columns]
    assert sorted(map(str, want.select("doc_id", *new).collect())) == sorted(map(str, got.select("doc_id", *new).collect()))
    through = [n for n in NAMES if n not in want.columns]
    for r in got.collect():
        for n in through:
            assert r[n] == f"{n} of {'none' if r.doc_id is None else r.doc_id}"
        assert r["odd map"] == {"a": r.doc_id}
    assert OPERATORS[name](_odd(docs).limit(0)).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_a_long_text(spark, name):
    text = " ".join(f"word{i % 9973} of{i % 7}" for i in range(600_000))
    out = OPERATORS[name](documents(spark, [(1, text), (2, "short text of a few words"), (3, None)]))
    assert out.select("doc_id").distinct().count() == (2 if name == "mixed" else 3)


def test_vectors_and_conversations(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (20, [0.5, 0.5]), (40, [0.0, 1.0]), (None, [1.0, 1.0]), (60, None), (80, [0.0, 0.0]), (100, [float("nan"), 1.0]), (120, [None, 1.0]), (140, [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    odd = table.withColumns({n: F.lit(n) for n in NAMES} | {"m": F.create_map(F.lit("a"), F.lit(1))})
    plain = sorted(map(tuple, neighbours.nearest(table).collect()))
    assert sorted(map(tuple, neighbours.nearest(odd).collect())) == plain
    assert {r[0] for r in plain} == {20, 40} and {r[2] for r in plain} == {1, 20, 40}
    turns = spark.createDataFrame([(1, 0, "user", "a"), (None, 0, "user", None)], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(turns.withColumns({n: F.lit(n) for n in NAMES}))).count() == 2
