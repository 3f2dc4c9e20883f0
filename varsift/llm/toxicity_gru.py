"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as its hashed word vector next to the mean of its parts' vectors: hashed character trigrams and
beginnings. Windows of ``LENGTH``
words, one every ``STEP`` words, run through a GRU in both directions; attention pools the states and a logistic unit
scores the window. A document's score is that of its highest window, so every word of every text is scored, and a
passage of up to ``LENGTH - STEP + 1`` words lies whole in some window wherever it stands.

Training is plain numpy in one task, on a bounded sample: at most ``TRAIN_DOCS`` labelled rows of each class with
texts of at most ``TRAIN_BYTES``, by the least hash of their ids, never from the held-out fold. As a label belongs to a
document, each round trains on the document's highest window (and, for clean documents, on others too). The vectors' first
component starts as the log odds of the word or part in the sample.

Scoring is one pass over the documents without a shuffle; the network (about 1 MB) goes with the task.

Defined cases: null, empty and wordless texts score 0; without labelled rows of both classes every score is 0; repeated
label rows count once, toxic if any is; only id and text are read, and labels only in training.
"""

from __future__ import annotations

from collections.abc import Iterator
from io import BytesIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varsift.llm import text_arrays as ta
from varsift.llm.arrow_jobs import keep_rows, report

LENGTH, STEP = 32, 8
HIDDEN = 8
WORD_DIM, CHAR_DIM = 6, 6
WORDS, PARTS = 1 << 14, 1 << 16
#: Lengths in bytes of the word beginnings among a word's parts.
BEGINNINGS = range(4, 11)
TRAIN_DOCS, TRAIN_BYTES = 1200, 12_288
ROUNDS = 5
FOLDS = 5
_MARKS = frozenset(b".,;:!?\"'()[]{}*#$%&|<>-_/")
_WORD = np.array([ta.NON_SPACE[b] and b not in _MARKS for b in range(256)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Words:
    """The words of a chunk as numbers of distinct words, with their hashed inputs."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        data = ta.LOWER[data]
        start, end, self.row = ta.word_spans(data, at, _WORD)
        sums = ta.prefix_sums(data)
        hashes = ta.span_hashes(sums, start, end)
        distinct, first, self.number = np.unique(hashes, return_index=True, return_inverse=True)
        self.word = (distinct & np.uint64(WORDS - 1)).astype(np.int64)
        # trigrams of bytes, with a mark before and after the word, and beginnings of the word
        a, size = start[first], (end - start)[first]
        low = np.cumsum(size) - size
        owner = np.arange(len(a)).repeat(size)
        place = np.arange(len(owner)) - low.repeat(size)
        here = data[a[owner] + place].astype(np.uint64)
        before = np.where(place > 0, data[np.maximum(a[owner] + place - 1, 0)], 0).astype(np.uint64)
        after = np.where(place + 1 < size[owner], data[np.minimum(a[owner] + place + 1, max(0, len(data) - 1))], 0).astype(np.uint64)
        owners, parts = [owner], [ta.mix(before << np.uint64(16) | here << np.uint64(8) | after)]
        for n in BEGINNINGS:
            long = np.flatnonzero(size >= n)
            owners.append(long)
            parts.append(ta.span_hashes(sums, a[long], a[long] + n))
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        self.part = (np.concatenate(parts)[order] & np.uint64(PARTS - 1)).astype(np.int64)
        self.bounds = np.append(0, np.cumsum(np.bincount(owner, minlength=len(a)))).astype(np.int64)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, first word, size) of the windows of n rows: overlapping, the last one ends with the text."""
        count = ta.counts_by_row(self.row, n)
        low = np.cumsum(count) - count
        many = np.where(count > 0, 1 + np.maximum(0, -(-(count - LENGTH) // STEP)), 0)
        row = np.arange(n).repeat(many)
        k = np.arange(many.sum()) - (np.cumsum(many) - many).repeat(many)
        first = np.minimum(k * STEP, np.maximum(count[row] - LENGTH, 0)) + low[row]
        return row, first, np.minimum(count[row], LENGTH)


class Network:
    """Parameters, forward pass and gradients."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        f = np.float32
        self.p = {"word": rng.normal(0, 0.05, (WORDS, WORD_DIM)).astype(f), "char": rng.normal(0, 0.05, (PARTS, CHAR_DIM)).astype(f)}
        for side in ("f", "b"):
            self.p |= {f"w{side}": rng.normal(0, d**-0.5, (d, 3 * h)).astype(f), f"u{side}": rng.normal(0, 0.5 * h**-0.5, (h, 3 * h)).astype(f),
                       f"c{side}": np.zeros(3 * h, f)}
        self.p |= {"att": rng.normal(0, 0.3, 2 * h).astype(f), "out": rng.normal(0, 0.3, 2 * h).astype(f), "bias": np.zeros(1, f)}
        self.trained = False

    def inputs(self, words: Words, which: np.ndarray | None = None) -> np.ndarray:
        """The vector of each distinct word."""
        p = self.p
        sums = np.add.reduceat(p["char"][words.part], words.bounds[:-1]) if len(words.word) else np.zeros((0, CHAR_DIM), np.float32)
        return np.concatenate([p["word"][words.word], sums / np.diff(words.bounds)[:, None].astype(np.float32)], 1)

    def _run(self, side: str, x: np.ndarray, alive: np.ndarray, keep: list | None) -> np.ndarray:
        """States (step, window, HIDDEN) of one direction; x: inputs already through the input weights, by step."""
        h, u = HIDDEN, self.p[f"u{side}"]
        state = np.zeros((x.shape[1], h), np.float32)
        out = np.empty((len(x), x.shape[1], h), np.float32)
        for t in range(len(x)) if side == "f" else range(len(x) - 1, -1, -1):
            own = x[t]
            gate = _sigmoid(own[:, : 2 * h] + state @ u[:, : 2 * h])
            z, r = gate[:, :h], gate[:, h:]
            new = np.tanh(own[:, 2 * h :] + (r * state) @ u[:, 2 * h :])
            move = z * alive[t][:, None]
            if keep is not None:
                keep.append((t, state, z, r, new))
            state = state + move * (new - state)
            out[t] = state
        return out

    def score(self, words: Words, first: np.ndarray, size: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each window."""
        p = self.p
        vector = self.inputs(words)
        steps = np.arange(LENGTH)[:, None]
        alive = (steps < size).astype(np.float32)
        token = words.number[np.minimum(first + steps, len(words.number) - 1)]
        states = []
        for side in ("f", "b"):
            through = vector @ p[f"w{side}"] + p[f"c{side}"]
            log = [] if keep is not None else None
            states.append(self._run(side, through[token], alive, log))
            if keep is not None:
                keep[side] = log
        both = np.concatenate(states, 2)
        strength = both @ p["att"] + (alive - 1) * 1e9
        share = np.exp(strength - strength.max(0))
        share /= share.sum(0)
        pooled = np.einsum("tb,tbh->bh", share, both)
        if keep is not None:
            keep.update(vector=vector, token=token, alive=alive, both=both, share=share, pooled=pooled)
        return pooled @ p["out"] + p["bias"][0]

    def gradients(self, words: Words, first: np.ndarray, size: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict:
        """Of the mean weighted log loss."""
        keep: dict = {}
        p, h = self.p, HIDDEN
        logit = self.score(words, first, size, keep)
        error = ((_sigmoid(logit) - target) * weight / len(target)).astype(np.float32)
        both, share = keep["both"], keep["share"]
        g = {"out": keep["pooled"].T @ error, "bias": error.sum()[None]}
        d_pooled = error[:, None] * p["out"]
        d_share = np.einsum("tbh,bh->tb", both, d_pooled)
        d_strength = share * (d_share - (share * d_share).sum(0))
        g["att"] = np.einsum("tb,tbh->h", d_strength, both)
        d_both = share[:, :, None] * d_pooled + d_strength[:, :, None] * p["att"]
        d_vector = np.zeros_like(keep["vector"])
        for k, side in enumerate(("f", "b")):
            u, d_state = p[f"u{side}"], np.zeros((len(first), h), np.float32)
            g_u = np.zeros_like(u)
            d_through = np.zeros((len(keep["vector"]), 3 * h), np.float32)
            for t, state, z, r, new in reversed(keep[side]):
                d_state = d_state + d_both[t][:, k * h : (k + 1) * h]
                alive = keep["alive"][t][:, None]
                d_z = d_state * alive * (new - state) * z * (1 - z)
                d_new = d_state * alive * z * (1 - new * new)
                back = d_new @ u[:, 2 * h :].T
                d_r = back * state * r * (1 - r)
                own = np.concatenate([d_z, d_r, d_new], 1)
                g_u[:, : 2 * h] += state.T @ own[:, : 2 * h]
                g_u[:, 2 * h :] += (r * state).T @ d_new
                np.add.at(d_through, keep["token"][t], own)
                d_state = d_state * (1 - alive * z) + back * r + own[:, : 2 * h] @ u[:, : 2 * h].T
            g |= {f"u{side}": g_u, f"w{side}": keep["vector"].T @ d_through, f"c{side}": d_through.sum(0)}
            d_vector += d_through @ p[f"w{side}"].T
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], words.word, d_vector[:, :WORD_DIM])
        own = d_vector[:, WORD_DIM:] / np.diff(words.bounds)[:, None]
        np.add.at(g["char"], words.part, own.repeat(np.diff(words.bounds), 0))
        return g


def _log_odds(words: Words, toxic: np.ndarray, block: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of the documents that hold a hashed word or part, toxic against clean, shrunk towards 0.

    Counted for a few documents at a time, so that the sample's parts are never all laid out.
    """
    found = np.zeros((2, WORDS)), np.zeros((2, PARTS))
    spread, many = np.diff(words.bounds), len(words.word)
    cuts = np.searchsorted(words.row, np.arange(0, len(toxic) + block, block))
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        pair = np.unique(words.row[low:high] * many + words.number[low:high])
        row, number = pair // many, pair % many
        size = spread[number]
        inner = np.arange(size.sum()) - (np.cumsum(size) - size).repeat(size)
        part = words.part[words.bounds[:-1][number].repeat(size) + inner]
        for count, owner, kind in ((found[0], row, words.word[number]), (found[1], row.repeat(size), part)):
            own = np.unique(owner * count.shape[1] + kind)
            np.add.at(count, (toxic[own // count.shape[1]], own % count.shape[1]), 1)
    all_ = np.maximum(np.bincount(toxic, minlength=2), 1)[:, None]
    odds = [np.log((x[1] + 0.01) / (x[0] + 0.01)) for x in (count / all_ for count in found)]
    return np.clip(odds[0], -3, 3) / 3, np.clip(odds[1], -3, 3) / 3


def train(texts: list[str], labels: list[int], seed: int = 7) -> Network:
    """A network fitted to documents and their labels (numpy only)."""
    net = Network(seed)
    toxic = np.array(labels)
    if not (toxic == 1).any() or not (toxic == 0).any():
        return net
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    words = Words(data, np.append(0, np.cumsum([len(x) for x in raw])))
    row, first, size = words.windows(len(texts))
    net.p["word"][:, 0], net.p["char"][:, 0] = _log_odds(words, toxic)
    rng = np.random.default_rng(seed)
    mean, square = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2))
    step, block = 0, 256
    starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    for epoch in range(ROUNDS):
        if epoch:
            logit = np.concatenate([net.score(words, first[k : k + 4096], size[k : k + 4096]) for k in range(0, len(first), 4096)])
            order = np.lexsort((-logit, row))
        else:  # nothing is known yet: the window with the most telling words
            told = (net.inputs(words) @ np.eye(WORD_DIM + CHAR_DIM, dtype=np.float32)[[0, WORD_DIM]].sum(0))[words.number]
            best = np.array([told[a : a + s].max() for a, s in zip(first, size, strict=True)])
            order = np.lexsort((-best, row))
        chosen = order[starts]
        others = rng.choice(np.flatnonzero(toxic[row] == 0), len(chosen) // 2)
        chosen = rng.permutation(np.concatenate([chosen, others]))
        for k in range(0, len(chosen), block):
            own = chosen[k : k + block]
            part = _subset(words, first[own], size[own])
            target = toxic[row[own]].astype(np.float32)
            g = net.gradients(*part, target, np.ones(len(own), np.float32))
            step += 1
            for name, value in g.items():
                mean[name] += 0.1 * (value - mean[name])
                square[name] += 0.01 * (value * value - square[name])
                net.p[name] -= (0.02 * (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    net.trained = True
    return net


def _subset(words: Words, first: np.ndarray, size: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray]:
    """The distinct words of some windows only, so that gradients stay small."""
    token = words.number[np.minimum(first[:, None] + np.arange(LENGTH), len(words.number) - 1)]
    used, number = np.unique(token, return_inverse=True)
    out = object.__new__(Words)
    out.number, out.row = number.reshape(-1), None
    out.word = words.word[used]
    spread = np.diff(words.bounds)[used]
    out.bounds = np.append(0, np.cumsum(spread))
    place = np.arange(out.bounds[-1]) - out.bounds[:-1].repeat(spread)
    out.part = words.part[words.bounds[:-1][used].repeat(spread) + place]
    return out, np.arange(len(first)) * LENGTH, size


def _scores(net: Network, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The highest window's probability of each row; 0 without words."""
    n = len(at) - 1
    best = np.full(n, -np.inf)
    if net.trained and len(data):
        words = Words(data, at)
        row, first, size = words.windows(n)
        if len(row):
            logit = np.concatenate([net.score(words, first[k : k + 4096], size[k : k + 4096]) for k in range(0, len(row), 4096)])
            np.maximum.at(best, row, logit)
    return _sigmoid(best)


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, toxic, text) of the bounded sample of labelled documents outside the held-out fold; of several texts
    with one id the least."""
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.where(F.crc32(F.col("doc_id").cast("string")) % FOLDS != 0)
    text = F.col(text_col).cast("string")
    own = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).where(f"octet_length(text) between 1 and {TRAIN_BYTES}")
    marked = marked.join(own.select("doc_id").distinct(), "doc_id")
    chosen = [marked.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS) for k in (0, 1)]
    wanted = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most twice TRAIN_DOCS
    return own.join(wanted, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Network:
    """A network trained on the sample in one task (the sample is bounded); only its parameters reach the driver."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(r["text"], r["toxic"]) for batch in batches for r in batch.to_pylist()]
        net = train([t for t, _ in rows], [int(x) for _, x in rows])
        ta.forget_powers()
        parameters = BytesIO()
        np.savez(parameters, trained=net.trained, **net.p)
        yield pa.RecordBatch.from_arrays([pa.array([parameters.getvalue()], pa.binary())], names=["parameters"])

    sample = training_sample(docs, labels, id_col, text_col).repartition(1).sortWithinPartitions("doc_id")
    found = sample.select("text", "toxic").mapInArrow(fit, "parameters binary").first()
    net = Network()
    if found is not None:
        with np.load(BytesIO(found.parameters)) as read:
            net.trained = bool(read["trained"])
            net.p = {k: read[k] for k in net.p}
    return net


def scored(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id and ``score``."""
    return report(docs, lambda: lambda data, at: [pa.array(_scores(net, data, at), pa.float64())], "score double", id_col, text_col)


def without_toxic(docs: DataFrame, net: Network, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, all columns as they are."""
    return keep_rows(docs, lambda: lambda data, at: _scores(net, data, at) < threshold, text_col)


def contract(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of op6."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    return scored(docs, fitted(docs, labels)).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
