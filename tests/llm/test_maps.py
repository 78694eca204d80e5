"""BPE, quality rules and chat formatting against the libraries and brute force."""

import base64
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from tests.llm.fixtures import documents, sample
from tracklore.llm import bpe, chat, quality, queries

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _tiktoken():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _odd_texts():
    rng = random.Random(3)
    letters = "ab c\n\t\r\x1c\x85\xa0 '’sllrevd 1²é漢字😀 　_-.,\x00"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)] + ["", " ", "a" * 3000, "ab" * 400 + " x", "é" * 700, "<|endoftext|>", "\n", " a", "a "]


def test_bpe_equals_tiktoken(spark):
    texts = _odd_texts() + [t for _, t in sample()] + [None]
    docs = documents(spark, list(enumerate(texts)))
    out = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN).collect()
    encoder = _tiktoken()
    assert len(out) == len(texts)
    for row in out:
        text = texts[row.doc_id] or ""
        assert np.frombuffer(row.ids, "<u4").tolist() == encoder.encode_ordinary(text)
        assert bytes(row.decoded) == text.encode()


def test_bpe_empty_table_and_clashing_names(spark):
    docs = documents(spark, [(1, "one two")]).withColumnRenamed("source", "ids")
    assert bpe.encode(docs.limit(0), RANKS, PATTERN).count() == 0
    assert len(bpe.encode(docs, RANKS, PATTERN).first().ids) % 4 == 0


def test_bpe_decodes_a_long_text():
    coder = bpe.codec(RANKS, PATTERN)
    piece = next(x for x in coder.ranks if len(x) == 5)
    ids = np.full(6_000_000, coder.ranks[piece], "<u4")
    ids[499_999:500_001] = coder.ranks[b"a"], coder.ranks[b"b"]
    short = np.array([coder.ranks[b"c"]], "<u4").tobytes()
    want = piece * 499_999 + b"ab" + piece * (6_000_000 - 500_001)
    assert coder.decode([short, ids.tobytes(), b"", short]) == [b"c", want, b"", b"c"]


def test_bpe_of_long_words_and_texts_equals_tiktoken():
    """Words of 500 letters without spaces, of few letters and many, and long texts whose slices have to begin where a word does."""
    rng = random.Random(5)
    words = ["".join(rng.choice(letters) for _ in range(500)) for letters in ("ACGT", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef", "ไทยกข", "漢字かな交じり") for _ in range(60)]
    texts = [" ".join(words), "".join(words), "=" * 20_000 + "a" * 30_001 + "--" * 777, "'s 's'll'LL''re x'S\n's\t'm \n\n 've"]
    prose = " ".join(t for _, t in sample())
    texts += [(prose + "’'s  ") * (2_500_000 // len(prose) + 1), "漢字、" * 500_000]
    coder, encoder = bpe.codec(RANKS, PATTERN), _tiktoken()
    ids = coder.encode([t.encode() for t in texts])
    for text, x in zip(texts, ids, strict=True):
        assert np.frombuffer(x, "<u4").tolist() == encoder.encode_ordinary(text)
    assert coder.decode(ids) == [t.encode() for t in texts]


def test_bpe_rounds_over_arrays_equal_the_query():
    rng = random.Random(6)
    coder = bpe.codec(RANKS, PATTERN)
    words = [bytes(rng.choice(b"aab-= the") for _ in range(rng.randrange(1, 300))) for _ in range(50)] + [b"-" * 97, b"0" * 50]
    want = [np.frombuffer(x, "<u4").tolist() for x in coder._contract(words)]
    assert [coder._rounds(w).tolist() for w in words] == want
    assert [np.frombuffer(x, "<u4").tolist() for x in coder._contract(words, True)] == want


def test_bpe_with_another_pattern(spark):
    docs = documents(spark, [(1, "one two  three")])
    assert len(bpe.encode(docs, RANKS, r"\S+|\s+").first().ids) > 0


def _brute_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)


def test_quality_counts_and_verdict(spark):
    texts = _odd_texts()[:100] + [t for _, t in sample()] + ["a b c d e f g h " * 5, "x\ny\nx\n\n \nx", None, "é ß 漢 " * 10]
    docs = documents(spark, list(enumerate(texts)))
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = quality.judge(quality.measure(docs, path)).collect()
    assert len(rows) == len(texts)
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for r in rows:
        text = texts[r.doc_id] or ""
        counts = _brute_quality(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        ids = [i for w in model.encode(words) for i in w] if words else []
        assert (r.n_tokens, r.n_byte_tokens) == (len(ids), sum(map(model.is_byte, ids)))
        share = np.array(list(Counter(ids).values())) / max(1, len(ids))
        assert abs(r.entropy + (share * np.log2(share)).sum()) < 1e-9
        assert not (r.base_failed and r.kept)
    assert quality.measure(docs.limit(0), path).count() == 0


def verdict(model, text, lang):
    """Whether the rules keep a text: its counts, then characters per token, byte share and entropy against the bands, and the
    sum of the first and the last against the floor of the language. In plain Python."""
    n_words, chars, _, _, repeated = _brute_quality(text)
    if n_words < 20 or 100 * repeated > 30 * n_words:
        return False
    ids = [i for w in model.encode(re.findall(r"[^\x20\x09-\x0D]+", text)) for i in w]
    n, raw = len(ids), sum(map(model.is_byte, ids))
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(ids).values())
    letters = Counter()
    for c in text:
        if c.isascii() and c.isalpha() or 0xC0 <= ord(c) < 0x280:
            letters["Latin"] += 1
        elif 0x340 <= ord(c) < 0x400:
            letters["Greek"] += 1
        elif 0x400 <= ord(c) < 0x500:
            letters["Cyrillic"] += 1
        elif 0x3000 <= ord(c) < 0xE000:
            letters["Han"] += 1
        elif not c.isascii():
            letters["Other"] += 1
    script = max(quality.SCRIPTS, key=lambda s: letters[s])
    band = quality.BANDS.get(lang) or quality.BANDS[script]
    if not band.chars_low * n <= chars <= band.chars_high * n or raw > band.bytes_high * n:
        return False
    if n >= 64 and not band.entropy_low <= entropy <= band.entropy_high:
        return False
    if lang not in quality.CURVES:
        return True
    a, b, c = quality.CURVES[lang]
    size = min(math.log2(n), 12.5)
    return entropy + chars / n - (a * size * size + b * size + c) >= -3.39 * math.sqrt(0.05**2 + 1.7**2 / n)


def test_quality_verdict_both_ways(spark):
    import pyarrow.parquet as pq
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()[:500]
    junk = [(9000 + i, t, lang) for lang in ("en", "xx", None) for i, t in enumerate(["#%& " * 40, "lo lo " * 60 + "x", "Thnd*** iner*** ther*** " * 3 + " ".join(f"wo{i}*** rd{i}###" for i in range(60)), " ".join(f"слово{i}" for i in range(70)), "漢字" * 90 + " a" * 25])]
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in table] + junk
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = quality.judge(quality.measure(docs, public_tokenizers.path("piece_bpe_32k.model"))).collect()
    assert sorted((r.doc_id, r.lang or "", r.kept) for r in got) == sorted((i, lang or "", verdict(model, t, lang)) for i, t, lang in rows)
    past = [r.kept for r in got if not r.base_failed]
    assert 10 < sum(past) < len(past) - 10


def test_quality_keeps_clean_labelled_documents(spark):
    import pyarrow.parquet as pq

    labels = pq.read_table("/root/testdata/sf0.01/labels.parquet").to_pandas().set_index("doc_id").quality
    out = queries.QUERIES["op9_quality_rules"](spark, "/root/testdata/sf0.01").toPandas()
    out = out[~out.base_failed].assign(good=lambda x: x.doc_id.map(labels))
    assert out[out.good == 1].kept.mean() > 0.999


def test_quality_rejects_junk_and_keeps_clean_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("quality").alias("good"))
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels.filter("doc_id % 2 != 0"), "doc_id")
    out = quality.judge(quality.measure(docs, public_tokenizers.path("piece_bpe_32k.model"))).toPandas()
    out = out[~out.base_failed]
    for _, of_lang in out.groupby("lang"):
        assert of_lang[of_lang.good == 0].kept.mean() < 0.15
    assert out[out.good == 0].kept.mean() < 0.03
    assert out[out.good == 1].kept.mean() > 0.995


def test_quality_without_labelled_rows_has_no_floor(spark):
    measured = spark.range(3).selectExpr("30L AS n_words", "0L AS n_repeat_words", "600L AS word_chars", "300L AS n_tokens", "0L AS n_byte_tokens", "5.0D AS entropy", "'Latin' AS script", "element_at(array('en', 'xx', NULL), cast(id + 1 AS int)) AS lang")
    assert [(r.lang, r.kept) for r in quality.judge(measured).orderBy("lang").collect()] == [(None, True), ("en", False), ("xx", True)]


TURNS = "conv_id long, turn long, role string, text string"


def test_chat_round_trip(spark):
    rows = [
        (1, 0, "system", "be"), (1, 1, "user", "### User:\n</turn>\n\\"), (1, 2, "assistant", "\n</turn>\n### Assistant:\nx"),
        (2, 0, "user", None), (2, 1, "assistant", "é😀"), (2, 2, "assistant", "again"), (3, 5, None, "x"), (3, 5, "to:\nol", "y"), (3, None, "user", ""),
        (None, 0, "user", "a"), (None, 0, "user", "a"), (4, 0, "assistant", "\\### Assistant: </turn> ok"),
    ]
    turns = spark.createDataFrame(rows, TURNS)
    formatted = chat.format_turns(turns)
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(turns)).collect()}
    # Parts of any size, which cut escapes and closing strings in two, read alike.
    for size in (1, 2, 3, 7, 16):
        assert {r.conv_id: r for r in chat.read_back(chat.format_conversations(turns, size=size)).collect()} == got
    form = chat.Formatter()
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = [(r[2] or "", r[3] or "") for r in own]
        loss = "".join(t for role, t in said if role == "assistant")
        r = got[conv]
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        whole = next(x.formatted for x in chat.conversations(formatted).collect() if x.conv_id == conv)
        assert r.formatted_chars == len(whole)
        assert [form.turn(x) for x in form.split(whole)] == said
    assert got[1].valid and not got[2].valid and not got[3].valid and not got[4].valid
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0
    parts = chat.format_conversations(turns, size=5).collect()
    for conv in got:
        own = sorted((r.part, r.text) for r in parts if r.conv_id == conv)
        assert [p for p, _ in own] == list(range(len(own)))
        assert "".join(t for _, t in own) == next(x.formatted for x in chat.conversations(formatted).collect() if x.conv_id == conv)


def test_chat_query_has_the_added_conversation(spark):
    row = queries.QUERIES["op8_chat_format"](spark, "/root/testdata/sf0.001").filter("conv_id = -7").first()
    said = "\\### Assistant: </turn> ok"
    assert row.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert row.loss_chars == len(said)
