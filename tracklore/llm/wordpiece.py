"""Counts of greedy word pieces by a linear longest-match automaton.

The pieces of a vocabulary make one trie with two roots, for the start of a word and for its continuation. A node's failure
link leads to where matching goes on once the longest pieces of the node's string are taken off, and the number of these is
computed beforehand; so a word is counted in one pass over its characters, and no piece is ever built. A word that the
pieces cannot spell is one unknown token.

Each distinct word of a worker is counted once. Words are runs without ASCII white space. Null and empty texts have no
tokens; repeated rows are counted alike. Other columns pass unchanged, those named like results are replaced. An empty
table gives an empty table."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklore.llm._hash import Words
from tracklore.llm._work import aside, bounded, groups_of, held, restored, texts_of

KEPT = 150_000
START, INSIDE = 0, 1


class Automaton:
    """starts: pieces at the start of a word; insides: pieces after it. An empty start piece may stand for the mark of a
    word's start alone."""

    def __init__(self, starts: Iterable[str], insides: Iterable[str]):
        self.next: list[dict[str, int]] = [{}, {}]
        whole: set[int] = set()
        parent: list[tuple[int, str]] = [(-1, ""), (-1, "")]
        for root, pieces in ((START, starts), (INSIDE, insides)):
            for piece in pieces:
                node = root
                for c in piece:
                    if (to := self.next[node].get(c)) is None:
                        to = self.next[node][c] = len(self.next)
                        self.next.append({})
                        parent.append((node, c))
                    node = to
                whole.add(node)
        whole.discard(INSIDE)
        self.fail, self.popped = [-1] * len(self.next), [0] * len(self.next)
        if START in whole:
            self.fail[START], self.popped[START] = INSIDE, 1
        # Failure links of shorter strings come first; both roots are the shortest.
        queue = deque([*self.next[START].values(), *self.next[INSIDE].values()])
        while queue:
            node = queue.popleft()
            queue.extend(self.next[node].values())
            if node in whole:
                self.fail[node], self.popped[node] = INSIDE, 1
                continue
            above, c = parent[node]
            at, taken = self.fail[above], self.popped[above]
            while at >= 0 and c not in self.next[at]:
                taken += self.popped[at]
                at = self.fail[at]
            if at >= 0:
                self.fail[node], self.popped[node] = self.next[at][c], taken

    def count(self, word: str) -> int:
        """Number of pieces; 0 if the word can't be spelt."""
        node, taken = START, 0
        for c in word:
            while (to := self.next[node].get(c)) is None:
                if self.fail[node] < 0:
                    return 0
                taken += self.popped[node]
                node = self.fail[node]
            node = to
        while node != INSIDE:
            if self.fail[node] < 0:
                return 0
            taken += self.popped[node]
            node = self.fail[node]
        return taken


def pieces_of(path: str, mark: str = "▁") -> tuple[list[str], list[str]]:
    """Start and inside pieces of a vocabulary that marks the starts of words; control and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [model.id_to_piece(i) for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    return [p[1:] for p in plain if p.startswith(mark) and mark not in p[1:]], [p for p in plain if mark not in p]


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """docs, without the text, with n_words, n_tokens (an unknown word is one) and n_unknown."""
    results = ("n_words", "n_tokens", "n_unknown")
    kept = [c for c in docs.columns if c not in (*results, text)]
    own = docs.select(aside(kept), F.col(text).alias("_text"))
    schema = T.StructType([own.schema["_kept"], *(T.StructField(r, T.LongType()) for r in results)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = held(("pieces", path), lambda: (Automaton(*pieces_of(path)), {}))
        for batch in batches:
            texts = texts_of(batch.column(1))
            for a, b in groups_of(texts, 1_000_000):
                if len(known) > KEPT:
                    known.clear()
                words = Words(texts[a:b])
                _, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
                counts = np.zeros(len(first), np.int64)
                for k, (s, e) in enumerate(zip(words.start[first].tolist(), words.end[first].tolist(), strict=True)):
                    word = words.buffer[s:e]
                    if (n := known.get(word)) is None:
                        n = known[word] = automaton.count(word.decode("utf-8", "replace"))
                    counts[k] = n
                each = counts[which]
                total, unknown = (np.concatenate(([0], np.cumsum(x))) for x in (np.maximum(each, 1), each == 0))
                made = [words.count, *(x[words.first[1:]] - x[words.first[:-1]] for x in (total, unknown))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(x, pa.int64()) for x in made)], schema.names)

    return bounded(own, run, schema).select(*restored(kept), *results)
