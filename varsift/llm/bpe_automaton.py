"""Byte-pair encoding and decoding by a deterministic automaton over tokens.

The merges are compiled one after the other. The automaton begins with an arc for every symbol out of every state; a
state is named by the token on the arc that led to it. The gadget of the merge u v -> w

* adds an arc w wherever an arc u leads to a state with an arc v; the state behind it begins as a copy of the state
  behind v as it stands at that moment, and
* removes the arc v from the state behind u, so that only w spells the two.

A copy is kept as a pointer to its source with the time of copying, so 49 thousand gadgets take one table entry
each. After all merges exactly one path spells a word and its arcs are the word's tokens. Encoding follows the table:
every prefix of a word ends in one state, and from a state only the tokens on its arcs may follow. Whether an arc
exists is found from the gadgets once and then looked up. Decoding emits the labels of the arcs.

Words are split and normalised as the vocabulary file says (NFC, white space, lower case, pattern, byte symbols).

Defined cases: null and empty texts and texts of white space have no tokens and decode to the empty text; special
tokens' strings in a text are those tokens; other columns are not read; one row for each row.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from varsift.llm.arrow_jobs import report, strings

#: Words kept in a task with their tokens; the table starts anew when it is full.
KNOWN_WORDS = 300_000
NEVER = 1 << 60
#: White space of the vocabulary's pattern (fixed values: Unicode White_Space).
SPACE = "\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters and digits of Unicode 16, which the vocabulary's library knows and Python's tables lack.
NEW_LETTERS = ((0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
               (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x113B7), (0x113D1, 0x113D3), (0x11BC0, 0x11BE0),
               (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x1E5D0, 0x1E5F0))
NEW_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
               (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
NEW_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
             **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, 0x3A3: 0x3C3}
SPLIT = "{letter}+|{number}|'(?:s|t|re|ve|m|ll|d)|[^{space}{not_letter}{not_number}]+"
#: For texts below U+0530, on whose classes all Unicode versions agree.
WORD = regex.compile(SPLIT.format(letter=r"\p{L}", number=r"\p{N}", space=SPACE, not_letter=r"\p{L}", not_number=r"\p{N}"))
LATER = re.compile("[\u0530-\U0010ffff]")


@lru_cache(1)
def any_word() -> re.Pattern:
    """The pattern for all other texts, with letters and numbers as explicit ranges."""
    def ranges(kind: str, new: tuple) -> str:
        own = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == kind]
        edges = [k for k in range(len(own)) if not k or own[k] != own[k - 1] + 1] + [len(own)]
        spans = [(own[a], own[b - 1]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in (*spans, *new))

    letters, numbers = ranges("L", NEW_LETTERS), ranges("N", NEW_NUMBERS)
    return re.compile(SPLIT.format(letter=f"[{letters}]", number=f"[{numbers}]", space=SPACE, not_letter=letters, not_number=numbers))


def words_of(text: str) -> list[str]:
    """The normalised text's pieces."""
    text = unicodedata.normalize("NFC", text)
    if LATER.search(text):
        return any_word().findall(text.translate(NEW_LOWER).lower())
    return WORD.findall(text.replace("\u03a3", "\u03c3").lower())


def _byte_symbols() -> list[str]:
    """The printable stand-ins of the 256 bytes: printable Latin-1 as it is, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """What the encoder needs of a vocabulary file."""

    labels: list[str]
    merges: list[tuple[int, int, int]]
    special: dict[str, int]
    end: str

    @staticmethod
    def read(path: str) -> Vocabulary:
        """Read on the driver; the contents go to the tasks, so executors need no such file."""
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        ids, special = whole["model"]["vocab"], {x["content"]: x["id"] for x in whole["added_tokens"]}
        labels = [""] * (max([*ids.values(), *special.values()]) + 1)
        for label, k in (ids | special).items():
            labels[k] = label
        merges = [(ids[a], ids[b], ids[a + b]) for a, b in
                  (m if isinstance(m, list) else m.split(" ", 1) for m in whole["model"]["merges"])]
        return Vocabulary(labels, merges, special, whole["model"]["end_of_word_suffix"] or "")


class Automaton:
    """States, gadgets and the table of arcs."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.labels = vocabulary.labels
        n = len(self.labels)
        self.made, self.left, self.right = [-1] * n, [-1] * n, [-1] * n
        self.removed: dict[int, int] = {}
        self.n = n
        for when, (u, v, w) in enumerate(vocabulary.merges):
            self._gadget(when, u, v, w)
        ids = {label: k for k, label in enumerate(self.labels)}
        self.arcs: dict[int, bool] = {}
        # spellings, a character for each byte: tokens within a word, and tokens that end one
        symbols = _byte_symbols()
        self.inside = {chr(b): ids[x] for b, x in enumerate(symbols)}
        self.ending = {chr(b): ids[x + vocabulary.end] for b, x in enumerate(symbols)}
        spelling = {t: x for table in (self.inside, self.ending) for x, t in table.items()}
        ends = set(self.ending.values())
        for u, v, w in vocabulary.merges:
            spelling[w] = spelling[u] + spelling[v]
            (self.ending if v in ends else self.inside)[spelling[w]] = w
            if v in ends:
                ends.add(w)
        self.longest = max(map(len, spelling.values()))
        self.words: dict[str, tuple[bytes, str]] = {}

    def _gadget(self, when: int, u: int, v: int, w: int) -> None:
        self.made[w], self.left[w], self.right[w] = when, u, v
        self.removed[u * self.n + v] = when

    def _arc(self, state: int, token: int) -> bool:
        """Whether the finished automaton has this arc, by the gadgets that made and removed it."""
        until = NEVER
        while True:
            if self.removed.get(state * self.n + token, NEVER) < until:
                return False
            born, made = self.made[state], self.made[token]
            if born < 0 and made < 0:
                return True
            if born > made:  # the state is a copy of the state behind its right part, as it stood before that gadget
                state, until = self.right[state], born
            else:  # the arc was added where an arc of the token's left part stood; its own removal counts
                token, until = self.left[token], made + 1

    def path(self, word: str) -> list[int]:
        """The arcs of the one path that spells the word (a character for each byte), longest arcs tried first.

        A place that was left once is not tried again: only one path spells a prefix.
        """
        size, n, arcs, inside = len(word), self.n, self.arcs, self.inside
        path: list[int] = []
        places, ends = [0], [size]  # of each open step: where it begins, the next end to try
        dead = set()
        while places[-1] < size:
            at, end = places[-1], min(ends[-1], places[-1] + self.longest)
            while end > at:
                token = self.ending.get(word[at:]) if end == size else inside.get(word[at:end])
                if token is not None and end not in dead:
                    if not path:
                        break
                    key = path[-1] * n + token
                    has = arcs.get(key)
                    if has is None:
                        has = arcs[key] = self._arc(path[-1], token)
                    if has:
                        break
                end -= 1
            if end > at:
                ends[-1] = end - 1
                path.append(token)
                places.append(end)
                ends.append(size)
            else:
                dead.add(at)
                path.pop()
                places.pop()
                ends.pop()
        return path

    def word(self, word: str) -> tuple[bytes, str]:
        """Ids (little-endian, 32 bits) and labels of a word."""
        arcs = self.path(word.encode("utf-8", "surrogatepass").decode("latin-1"))
        if len(self.words) >= KNOWN_WORDS:
            self.words.clear()
        if len(self.arcs) >= 8 * KNOWN_WORDS:
            self.arcs.clear()
        found = self.words[word] = np.array(arcs, "<u4").tobytes(), " ".join(self.labels[t] for t in arcs)
        return found

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids and labels of a text."""
        ids, labels = [], []
        for piece in self._pieces(text):
            if piece in self.vocabulary.special:
                ids.append(np.array([self.vocabulary.special[piece]], "<u4").tobytes())
                labels.append(piece)
                continue
            known = self.words
            for word in words_of(piece):
                a, b = known.get(word) or self.word(word)
                ids.append(a)
                labels.append(b)
        return b"".join(ids), " ".join(labels)

    def _pieces(self, text: str) -> list[str]:
        if any(x in text for x in self.vocabulary.special):
            cut = "|".join(regex.escape(x) for x in self.vocabulary.special)
            return regex.split(f"({cut})", text)
        return [text]


_COMPILED: dict[str, Automaton] = {}


def compiled(vocabulary: Vocabulary) -> Automaton:
    """The automaton of a vocabulary, compiled once in a Python worker."""
    key = hashlib.sha256(repr((vocabulary.merges, vocabulary.special)).encode()).hexdigest()
    if key not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[key] = Automaton(vocabulary)
    return _COMPILED[key]


def _tokens(vocabulary: Vocabulary):
    def scorer():
        automaton = compiled(vocabulary)

        def score(data: np.ndarray, at: np.ndarray) -> list:
            rows = [automaton.encode(t) for t in strings(data, at)]
            size = np.array([len(a) // 4 for a, _ in rows], np.int64)
            ids = pa.array(np.frombuffer(b"".join(a for a, _ in rows), "<u4").astype(np.int32))
            bounds = pa.array(np.append(0, np.cumsum(size)), pa.int32())
            return [size, pa.ListArray.from_arrays(bounds, ids), [b for _, b in rows]]

        return score

    return scorer


def _digests(vocabulary: Vocabulary):
    def scorer():
        automaton = compiled(vocabulary)

        def score(data: np.ndarray, at: np.ndarray) -> list:
            rows = [automaton.encode(t) for t in strings(data, at)]
            return [[len(a) // 4 for a, _ in rows], [hashlib.sha256(a).hexdigest() for a, _ in rows],
                    [hashlib.sha256(b.encode()).hexdigest() for _, b in rows]]

        return score

    return scorer


def encoded(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_tokens``, ``ids`` and ``decoded`` text."""
    return report(docs, _tokens(vocabulary), "n_tokens long, ids array<int>, decoded string", id_col, text_col)


def contract(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The columns of op4: the digests of ids and decoded text, without sending either out of the task."""
    return report(docs, _digests(vocabulary), "n_tokens long, ids_sha256 string, decoded_sha256 string")
