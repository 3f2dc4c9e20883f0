"""Weak-label quality classifier.

Overlapping heuristic labellers vote good, bad or nothing on each document. Spark counts the vote patterns of the whole
corpus (at most 3 to the number of labellers); expectation-maximisation on these counts estimates each labeller's
accuracy in either class without any true label, and so the posterior of every pattern. The posteriors of a bounded sample (``TRAIN_DOCS``
documents of least hash) are the soft labels of a linear scorer over hashed features (words, shapes of words, character
trigrams and text statistics), which then scores every whole text.

A document is kept unless the scorer and its votes' posterior both call it bad.

Defined cases: null, empty and wordless texts get a bad vote for length and nothing else, which makes them bad (posterior and
score 0, not kept), also in the estimation; a share of nothing is no vote; without documents no model;
repeated rows give repeated results; only id and text are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varsift.llm import text_arrays as ta
from varsift.llm.arrow_jobs import report
from varsift.llm.perplexity_rules import base_stats

FEATURES = 1 << 15
TRAIN_DOCS, TRAIN_BYTES = 3000, 32_768
ROUNDS = 60
BLOCK = 64
GOOD, BAD, NONE = 1, 0, 2
ENOUGH = 10

#: Labellers: statistic, bad from this value on, good up to this value (otherwise no vote; below 0: never good).
LABELLERS = (
    ("repeated_words", 0.30, -1.0),
    ("repeated_lines", 0.40, -1.0),
    ("few_kinds", 0.60, -1.0),
    ("symbols_per_word", 0.30, -1.0),
    ("marks_per_word", 0.35, -1.0),
    ("odd_words", 0.25, -1.0),
    ("upper_share", 0.45, 0.12),
    ("not_letters", 0.20, 0.09),
    ("short_text", 0.60, -1.0),
    ("worst", 1.0, 0.5),
)
NAMES = [x[0] for x in LABELLERS]
SHORT = NAMES.index("short_text")


def statistics(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(row, labeller) values, larger for worse texts."""
    n = len(at) - 1
    words, _, symbols, dup, repeat = base_stats(data, at)
    start, end, row = ta.word_spans(data, at, ta.NON_SPACE)
    row_of = np.arange(n).repeat(np.diff(at))
    some = np.maximum(words, 1)

    def share(mask: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.bincount(row_of[mask], minlength=n) / np.maximum(np.bincount(row_of[of], minlength=n), 1)

    upper, lower = (data >= 0x41) & (data <= 0x5A), (data >= 0x61) & (data <= 0x7A)
    marks = np.zeros(256, bool)
    marks[list(b"!?#*$%&|<>{}[]=~^")] = True
    hashes = ta.span_hashes(ta.prefix_sums(data), start, end)
    kinds = np.bincount(row[np.unique(ta.mix(hashes + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]], minlength=n)
    lines = np.bincount(row_of[data == 0x0A], minlength=n) + 1
    repeated = np.where(words > 0, 1 - kinds / some - 0.15 * np.log10(np.maximum(some / 100, 1)), 0)
    with_mark = np.add.reduceat(np.append(marks[data], False), start) > 0 if len(start) else np.zeros(0, bool)
    odd = np.bincount(row[with_mark], minlength=n) / some
    visible = ta.NON_SPACE[data]
    letter = upper | lower | (data >= 0x80) | (data >= 0x30) & (data <= 0x39)
    out = np.stack([repeat / some, np.where(lines > 3, dup / lines, 0), repeated, symbols / some,
                    np.bincount(row_of[marks[data]], minlength=n) / some, odd, share(upper, upper | lower),
                    share(visible & ~letter, visible), 1 - np.minimum(words, ENOUGH) / ENOUGH], 1)
    worst = (out / np.array([x[1] for x in LABELLERS[:-1]])).max(1)
    out = np.concatenate([out, worst[:, None]], 1)
    for name, of in (("upper_share", upper | lower), ("not_letters", visible), ("worst", visible)):
        k = NAMES.index(name)
        out[np.bincount(row_of[of], minlength=n) == 0, k] = (LABELLERS[k][1] + LABELLERS[k][2]) / 2
    return out


def votes(values: np.ndarray) -> np.ndarray:
    """(row, labeller): GOOD, BAD or NONE."""
    bad, good = (np.array([x[k] for x in LABELLERS]) for k in (1, 2))
    return np.where(values >= bad, BAD, np.where(values <= good, GOOD, NONE))


def pattern(vote: np.ndarray) -> np.ndarray:
    return vote @ (3 ** np.arange(vote.shape[1]))


class LabelModel:
    """Class prior and each labeller's vote probabilities given the class, by expectation-maximisation."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS):
        k = len(LABELLERS)
        vote = patterns[:, None] // 3 ** np.arange(k) % 3
        one_hot = (vote[:, :, None] == np.arange(3)).astype(float)
        bad, good = (vote == BAD).sum(1), (vote == GOOD).sum(1)
        post = np.clip(0.5 + (good - bad) / 4, 0.05, 0.95)
        for _ in range(rounds):
            w = np.stack([(1 - post) * counts, post * counts])
            self.prior = (w.sum(1) + 1) / (counts.sum() + 2)
            self.vote_p = (np.einsum("cp,pkv->ckv", w, one_hot) + 1) / (w.sum(1)[:, None, None] + 3)
            post = self._posterior(vote)
        self.patterns, self.posteriors = patterns, post

    def _posterior(self, vote: np.ndarray) -> np.ndarray:
        # an abstention carries no evidence
        logs = np.where(vote[None] == NONE, 0.0, np.log(np.take_along_axis(
            np.broadcast_to(self.vote_p[:, None], (2, len(vote), *self.vote_p.shape[1:])), vote[None, :, :, None], 3)[..., 0]))
        total = np.log(self.prior)[:, None] + logs.sum(2)
        # a bad vote for length alone is a wordless text: one labeller's votes cannot tell its accuracy
        wordless = (vote[:, SHORT] == BAD) & ((vote != NONE).sum(1) == 1)
        return np.where(wordless, 0.0, 1 / (1 + np.exp(np.clip(total[0] - total[1], -50, 50))))

    def posterior(self, vote: np.ndarray) -> np.ndarray:
        """Probability of a good document."""
        return self._posterior(vote)

    def accuracies(self) -> dict[str, tuple[float, float]]:
        """By labeller: P(bad vote | bad), P(good vote | good), of the votes cast."""
        return {name: (self.vote_p[0, k, BAD] / self.vote_p[0, k, :2].sum(), self.vote_p[1, k, GOOD] / self.vote_p[1, k, :2].sum())
                for k, (name, *_) in enumerate(LABELLERS)}


def features(data: np.ndarray, at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hashed feature, value): word shapes and byte trigrams by share, and statistics in steps."""
    n = len(at) - 1
    row_of = np.arange(n).repeat(np.diff(at))
    kind = np.full(256, 4, np.uint64)
    kind[0x41:0x5B], kind[0x61:0x7B], kind[0x30:0x3A], kind[0x80:] = 1, 2, 3, 2
    kind[[0x20, *range(9, 14)]] = 0
    shape = kind[data]
    grams = []
    for width, base in ((3, ta.LOWER[data].astype(np.uint64)), (6, shape)):
        m = len(data) - width + 1
        if m > 0:
            code = np.zeros(m, np.uint64)
            for j in range(width):
                code = code * np.uint64(257) + base[j : j + m]
            own = np.flatnonzero(row_of[:m] == row_of[width - 1 :])
            slot = (ta.mix(code[own] + np.uint64(width << 56)) & np.uint64(FEATURES - 1)).astype(np.int64)
            key, count = np.unique(row_of[own] * FEATURES + slot, return_counts=True)
            grams.append((key // FEATURES, key % FEATURES, count))
    size = np.maximum(np.diff(at), 1)
    step = np.minimum(np.floor(np.clip(values, 0, 1) * 20), 19).astype(np.uint64)
    slot = (ta.mix(step + np.arange(values.shape[1], dtype=np.uint64) * np.uint64(64) + np.uint64(7 << 56)) & np.uint64(FEATURES - 1)).astype(np.int64)
    rows = [np.arange(n).repeat(values.shape[1])]
    cols, vals = [slot.reshape(-1)], [np.full(slot.size, 0.5)]
    for r, c, v in grams:
        rows.append(r)
        cols.append(c)
        vals.append(np.sqrt(v / size[r]))
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(vals)


def train(texts: list[str], model: LabelModel, rounds: int = 80) -> np.ndarray:
    """Weights of the linear scorer (the last one is the bias), fitted to posterior labels by full-batch Adam."""
    weights = np.zeros(FEATURES + 1)
    if not texts:
        return weights
    targets, entries = [], []
    for low in range(0, len(texts), BLOCK):  # only the entries of the sample are kept, not its texts' arrays
        raw = [t.encode() for t in texts[low : low + BLOCK]]
        data, at = np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(x) for x in raw]))
        values = statistics(data, at)
        targets.append(model.posterior(votes(values)))
        r, c, v = features(data, at, values)
        entries.append(((r + low).astype(np.int32), c.astype(np.int32), v.astype(np.float32)))
    target = np.concatenate(targets)
    row, col, val = (np.concatenate(x) for x in zip(*entries, strict=True))
    sure = np.abs(target - 0.5) * 2
    balance = np.where(target > 0.5, sure / max(1e-9, sure[target > 0.5].sum()), sure / max(1e-9, sure[target <= 0.5].sum()))
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights[col] * val, len(texts)) + weights[-1], -30, 30)))
        error = (p - target) * balance
        g = np.append(np.bincount(col, error[row] * val, FEATURES), error.sum()) + 1e-5 * weights
        mean += 0.1 * (g - mean)
        square += 0.01 * (g * g - square)
        weights -= 0.1 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
    return weights


def _pattern_scorer():
    return lambda data, at: [pattern(votes(statistics(data, at)))]


def _final_scorer(model: LabelModel, weights: np.ndarray):
    def make():
        def score(data: np.ndarray, at: np.ndarray) -> list:
            values = statistics(data, at)
            row, col, val = features(data, at, values)
            total = np.bincount(row, weights[col] * val, len(at) - 1) + weights[-1]
            score = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            return [model.posterior(votes(values)), np.where(values[:, SHORT] == 1, 0.0, score)]

        return score

    return make


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``posterior`` (of the votes), ``score`` (of the scorer), ``kept``."""
    patterns = report(docs, _pattern_scorer, "pattern long", id_col, text_col).groupBy("pattern").count().toPandas()
    patterns = patterns.sort_values("pattern")
    model = LabelModel(patterns["pattern"].to_numpy(np.int64), patterns["count"].to_numpy(float))
    size = F.octet_length(F.col(text_col).cast("string"))
    ids = docs.where(size.between(1, TRAIN_BYTES)).select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("h")).distinct()
    edge = ids.orderBy("h").limit(TRAIN_DOCS).agg(F.max("h")).first()[0]
    texts = docs.where(size.between(1, TRAIN_BYTES)).select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"), F.col(text_col).alias("t"))
    rows = texts.where(F.col("h") <= F.lit(edge)).dropDuplicates(["h"]).orderBy("h").collect() if edge is not None else []
    weights = train([r.t for r in rows], model)
    scored = report(docs, _final_scorer(model, weights), "posterior double, score double", id_col, text_col)
    return scored.withColumn("kept", (F.col("posterior") >= 0.5) | (F.col("score") >= 0.5))


def contract(docs: DataFrame) -> DataFrame:
    """The columns of op1."""
    return judged(docs).select("doc_id", "posterior", "score", "kept")
