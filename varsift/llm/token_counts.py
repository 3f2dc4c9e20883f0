"""Token counts by the whole-token shortcut.

Offline, once for a vocabulary, each of its strings that can end a word is put through all merges; those that come out
as one token are proven whole. A pre-token that is such a string counts one, by a look-up. Only the rest is merged: the
pair of least rank first, leftmost of equal ones, from a heap over a linked list of symbols.

The proven strings (at most the vocabulary's size) go with the task; documents are read once and never shuffled. Texts
are normalised and split as the vocabulary file says (``words_of``).

Defined cases: null, empty and white-space texts have no tokens; special tokens' strings in a text are one token each;
repeated rows give repeated results; a null id stays; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from heapq import heapify, heappop, heappush

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varsift.llm.arrow_jobs import report, strings
from varsift.llm.bpe_automaton import Vocabulary, _byte_symbols, words_of

LIMIT = 2048
#: Merged words that a task remembers, and the longest of them; the memory starts anew when it is full.
KNOWN_WORDS, KNOWN_LENGTH = 300_000, 64


class Merges:
    """The merges of a vocabulary as ranks of symbol pairs."""

    def __init__(self, vocabulary: Vocabulary):
        ids = {label: k for k, label in enumerate(vocabulary.labels)}
        symbols = _byte_symbols()
        self.inside = [ids[x] for x in symbols]
        self.ending = [ids[x + vocabulary.end] for x in symbols]
        self.rank = {(a, b): (k, w) for k, (a, b, w) in enumerate(vocabulary.merges)}

    def tokens(self, word: bytes) -> list[int]:
        """The tokens of a word that is not empty."""
        token = [self.inside[b] for b in word[:-1]] + [self.ending[word[-1]]]
        after = [*range(1, len(token)), -1]
        before = [*range(-1, len(token) - 1)]
        rank = self.rank
        heap = [(*rank[pair], k) for k, pair in enumerate(zip(token, token[1:])) if pair in rank]
        heapify(heap)
        while heap:
            order, made, k = heappop(heap)
            n = after[k]
            if token[k] < 0 or n < 0 or rank.get((token[k], token[n]), (-1,))[0] != order:
                continue  # one of the two has been merged since
            token[k], token[n], after[k] = made, -1, after[n]
            if after[n] >= 0:
                before[after[n]] = k
            for left, right in ((before[k], k), (k, after[k])):
                if left >= 0 and right >= 0 and (found := rank.get((token[left], token[right]))):
                    heappush(heap, (*found, left))
        return [t for t in token if t >= 0]


def whole_strings(vocabulary: Vocabulary) -> list[str]:
    """The strings proven to encode alone as one token: every one is merged from its bytes."""
    merges, value = Merges(vocabulary), {x: b for b, x in enumerate(_byte_symbols())}
    proven = []
    for token, label in enumerate(vocabulary.labels):
        if label in vocabulary.special or not label.endswith(vocabulary.end):
            continue
        spelled = bytes(value[c] for c in label[: len(label) - len(vocabulary.end)])
        if spelled and merges.tokens(spelled) == [token]:
            try:
                proven.append(spelled.decode("utf-8"))
            except UnicodeDecodeError:  # part of a character: never a pre-token
                continue
    return proven


class Counts(dict):
    """Tokens of a pre-token: the proven strings from the start, others once they have been merged."""

    def __init__(self, vocabulary: Vocabulary, proven: Iterable[str]):
        super().__init__(dict.fromkeys(proven, 1))
        self.proven = len(self)
        self.merges = Merges(vocabulary)
        self.special = re.compile("|".join(map(re.escape, vocabulary.special))) if vocabulary.special else None

    def __missing__(self, word: str) -> int:
        n = len(self.merges.tokens(word.encode("utf-8", "surrogatepass")))
        if len(word) <= KNOWN_LENGTH:
            if len(self) >= self.proven + KNOWN_WORDS:
                for old in list(self)[self.proven:]:
                    del self[old]
            self[word] = n
        return n

    def text(self, text: str) -> tuple[int, int]:
        """(tokens, tokens that are whole pre-tokens) of a text."""
        pieces, n = [text], 0
        if self.special and self.special.search(text):
            pieces = self.special.split(text)
            n = len(pieces) - 1
        whole = 0
        for piece in pieces:
            own = list(map(self.__getitem__, words_of(piece)))
            n += sum(own)
            whole += own.count(1)
        return n, whole


def counted(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``n_whole`` (pre-tokens of one token)."""
    proven = whole_strings(vocabulary)

    def scorer():
        counts = Counts(vocabulary, proven)

        def score(data: np.ndarray, at: np.ndarray) -> list:
            both = np.array([counts.text(t) for t in strings(data, at)], np.int64).reshape(-1, 2)
            return [np.diff(at).astype(np.int64), both[:, 0], both[:, 1]]

        return score

    return report(docs, scorer, "n_bytes long, n_tokens long, n_whole long", id_col, text_col)


def contract(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The columns of op11."""
    return counted(docs, vocabulary).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"),
                                            "n_whole")
