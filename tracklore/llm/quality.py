"""Quality rules on whole texts: cheap counts first, then tokeniser fertility.

Words are runs of bytes without ASCII white space. The base counts of measure() need no model: letters in words, symbol
characters, repeated lines, and words inside windows of eight words that occur at least twice in the text. For the
fertility a public vocabulary with byte fallback encodes each distinct word of a batch once:

- characters per token;
- the share of tokens that are raw bytes, for characters outside the vocabulary;
- the entropy, in bits, of the text's distribution of tokens.

A text is rejected when a measure leaves the band of its language, or else of its script (BANDS). Entropy is bounded by
the logarithm of the number of tokens, so its band counts only for texts of at least MIN_TOKENS tokens.

Languages with labelled rows also have a floor for both measures together: the sum of entropy and characters per token
may fall FLOOR spreads below what clean texts of as many tokens have (CURVES). Symbols after words, tables of navigation
and words said many times over lower both, each by less than clean texts differ. Other languages have no such floor.

Null text has no words: all counts are zero, base_failed is true. Repeated rows are judged alike; an unknown or null
language takes the band of the script that most letters of the text have. Input columns with the names of results are
replaced. An empty table gives an empty table."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklore.llm._hash import IS_SPACE, Words, windows
from tracklore.llm._work import aside, bounded, groups_of, held, restored, texts_of

WINDOW = 8
MIN_WORDS = 20
MIN_TOKENS = 64
WORDS_KEPT = 150_000
#: Byte values of the symbol characters.
SYMBOLS = b"#*$%&|<>"


class Band(NamedTuple):
    """Least and most characters per token, most byte fallback, least and most entropy."""

    chars_low: float
    chars_high: float
    bytes_high: float
    entropy_low: float
    entropy_high: float


#: By language, and by script for other languages. Prose has two to five characters a token in these vocabularies and 5
#: to 9 bits of entropy; symbol runs and encoded data have fewer characters, chants and filler less entropy.
BANDS = {
    "en": Band(1.75, 7.0, 0.10, 4.5, 11.5),
    "de": Band(1.80, 7.0, 0.10, 4.5, 11.5),
    "fr": Band(1.60, 7.0, 0.10, 4.5, 11.5),
    "es": Band(1.65, 7.0, 0.10, 4.5, 11.5),
    "Latin": Band(1.30, 8.0, 0.15, 4.0, 12.0),
    "Cyrillic": Band(0.90, 6.0, 0.20, 4.0, 12.0),
    "Greek": Band(0.60, 6.0, 0.30, 4.0, 12.0),
    "Han": Band(0.30, 3.0, 0.80, 4.0, 12.5),
    "Other": Band(0.20, 8.0, 1.00, 3.0, 12.5),
}

#: By language: the sum of entropy and characters per token of clean texts, as a polynomial of the logarithm of the number of
#: tokens (up to LOG_TOKENS). Fitted on the documents of sf0.1 with an even id and quality 1 that pass the base rules.
CURVES = {
    "en": (-0.0350, 0.8679, 3.7843),
    "de": (-0.0305, 0.7513, 4.3526),
    "fr": (-0.0293, 0.7220, 4.2049),
    "es": (-0.0362, 0.8758, 3.4333),
}
LOG_TOKENS = 12.5
#: Variance around the curve: SPREAD[0] ** 2 + SPREAD[1] ** 2 / tokens, as in these rows by length.
SPREAD = (0.05, 1.7)
#: The quantile of 0.1 % of these rows.
FLOOR = -3.39

RESULTS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_byte_tokens")]
    + [T.StructField("entropy", T.DoubleType()), T.StructField("script", T.StringType())]
)


class Fertility:
    """Tokens of words; distinct words of a worker are kept."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.vocab_size())])
        self.known: dict[bytes, bytes] = {}

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For distinct words: ids end to end, and how many of each word."""
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        found = list(map(self.known.get, words))
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            ids = self.model.encode([words[i].decode("utf-8", "replace") for i in new], num_threads=1)
            for i, x in zip(new, ids, strict=True):
                self.known[words[i]] = found[i] = array("H", x).tobytes()
        return np.frombuffer(b"".join(found), np.uint16), np.fromiter(map(len, found), np.int64, len(found)) // 2


def _sums(values: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Sum of values[cut[i]:cut[i + 1]] for each i."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[cut[1:]] - total[cut[:-1]]


def _repeats(words: Words) -> np.ndarray:
    """Words of each text inside windows that occur at least twice in it."""
    n = len(words.hash)
    out = np.zeros(len(words.count), np.int64)
    if n < WINDOW:
        return out
    hashes, owner = windows(words.hash, WINDOW), words.owner()
    inside = owner[: len(hashes)] == owner[WINDOW - 1 :]
    # A window's owner goes into its key: equal keys are repeats within one text.
    key = (hashes + owner[: len(hashes)].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))[inside]
    at = np.flatnonzero(inside)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.bincount(at[twice], minlength=n + 1) - np.bincount(at[twice] + WINDOW, minlength=n + 1)
    return _sums((np.cumsum(change[:-1]) > 0).astype(np.int64), words.first)


def _dup_lines(texts: list[bytes]) -> list[int]:
    """Lines with a word that equal an earlier line of the same text."""
    out = []
    for text in texts:
        lines = [x for x in text.split(b"\n") if not x.isspace() and x] if b"\n" in text else []
        out.append(len(lines) - len(set(lines)))
    return out


#: Lead bytes of UTF-8 by script, for texts of unknown language.
_SCRIPT = np.full(256, -1, np.int8)
_SCRIPT[[*range(65, 91), *range(97, 123), *range(0xC3, 0xCA)]] = 0
_SCRIPT[[0xCD, 0xCE, 0xCF]] = 2
_SCRIPT[range(0xD0, 0xD4)] = 1
_SCRIPT[range(0xE3, 0xEE)] = 3
_SCRIPT[[*range(0xD4, 0xE3), *range(0xEE, 0xF8)]] = 4
SCRIPTS = ["Latin", "Cyrillic", "Greek", "Han", "Other"]


def _measures(texts: list[bytes], fertility: Fertility) -> list:
    words = Words(texts)
    data = np.frombuffer(words.buffer, np.uint8)
    cut = np.append(words.text_start, len(data)) if len(texts) else np.zeros(1, np.int64)
    chars = _sums(((data & 0xC0) != 0x80) & ~IS_SPACE[data], cut)
    symbol = np.zeros(256, bool)
    symbol[np.frombuffer(SYMBOLS, np.uint8)] = True
    symbols = _sums(symbol[data], cut)
    kind = _SCRIPT[data]
    by_script = np.stack([_sums(kind == k, cut) for k in range(len(SCRIPTS))])
    scripts = [SCRIPTS[k] for k in by_script.argmax(0)]
    n = len(texts)
    tokens, raw, entropy = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
    if len(words.hash):
        _, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
        flat, length = fertility([words.buffer[a:b] for a, b in zip(words.start[first].tolist(), words.end[first].tolist(), strict=True)])
        many = length[which]
        stop = np.cumsum(many)
        ids = flat[np.arange(stop[-1]) + np.repeat((np.cumsum(length) - length)[which] - (stop - many), many)]
        at = np.append(0, stop)[words.first]
        tokens, raw = _sums(many, words.first), _sums(fertility.is_byte[ids], at)
        key = np.sort((np.repeat(np.arange(n, dtype=np.uint64), tokens) << np.uint64(16)) | ids)
        run = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        count = np.diff(np.append(run, len(key))).astype(np.float64)
        text = (key[run] >> np.uint64(16)).astype(np.int64)
        total = np.bincount(text, count * np.log2(count), n)
        some = tokens > 0
        entropy[some] = np.log2(tokens[some]) - total[some] / tokens[some]
    return [words.count, chars, symbols, _dup_lines(texts), _repeats(words), tokens, raw, entropy, scripts]


def measure(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """docs with the columns of RESULTS."""
    names = RESULTS.fieldNames()
    kept = [c for c in docs.columns if c not in names]
    own = docs.select(aside(kept)) if text in kept else docs.select(aside(kept), F.col(text).alias("_text"))
    schema = T.StructType([own.schema["_kept"], *RESULTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fertility = held(("fertility", vocabulary), lambda: Fertility(vocabulary))
        for batch in batches:
            rows = batch.column(0)
            texts = texts_of(rows.field(kept.index(text)) if text in kept else batch.column(1))
            for start, stop in groups_of(texts, 1_000_000):
                found = _measures(texts[start:stop], fertility)
                types = [pa.int64()] * 7 + [pa.float64(), pa.string()]
                yield pa.RecordBatch.from_arrays([rows.slice(start, stop - start), *map(pa.array, found, types)], schema.names)

    return bounded(own, run, schema).select(*restored(kept), *names)


def _above_floor(lang: str):
    """Whether entropy and characters per token together are what texts of the language have; true for other languages."""
    tokens = F.greatest(F.col("n_tokens"), F.lit(1))
    size = F.least(F.log2(tokens), F.lit(LOG_TOKENS))
    name = F.coalesce(F.col(lang).cast("string"), F.lit(""))
    a, b, c = (F.try_element_at(F.create_map(*(x for key, curve in CURVES.items() for x in (F.lit(key), F.lit(curve[k])))), name) for k in range(3))
    found = F.col("entropy") + F.col("word_chars") / tokens - ((a * size + b) * size + c)
    return F.coalesce(found >= FLOOR * F.sqrt(SPREAD[0] ** 2 + SPREAD[1] ** 2 / tokens), F.lit(True))


def judge(measured: DataFrame, lang: str = "lang", max_repeat: int = 30) -> DataFrame:
    """measured with base_failed and kept."""
    per = {}
    for k, name in enumerate(Band._fields):
        table = F.create_map(*(x for key, band in BANDS.items() for x in (F.lit(key), F.lit(band[k]))))
        known = F.try_element_at(table, F.coalesce(F.col(lang).cast("string"), F.lit(""))) if lang in measured.columns else F.lit(None)
        per[name] = F.coalesce(known, F.try_element_at(table, F.col("script")))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    spread = (F.col("entropy") >= per["entropy_low"]) & (F.col("entropy") <= per["entropy_high"])
    good = (
        (F.col("word_chars") >= per["chars_low"] * F.col("n_tokens"))
        & (F.col("word_chars") <= per["chars_high"] * F.col("n_tokens"))
        & (F.col("n_byte_tokens") <= per["bytes_high"] * F.col("n_tokens"))
        & ((F.col("n_tokens") < MIN_TOKENS) | spread)
    )
    if lang in measured.columns:
        good = good & _above_floor(lang)
    return measured.withColumns({"base_failed": base, "kept": ~base & good})
