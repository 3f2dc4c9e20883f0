"""Quality rules with n-gram perplexity bands.

Two language models judge a document, each with a band around the median of its language. ``symbol_model`` judges spelling:
5-grams of symbols of the whole corpus, a model for every language, a document left out of what it is judged by; they grow with
the corpus. The one here judges shape (tables, marks among the words): a modified Kneser-Ney model of order 4 over bytes in 32 classes (letters without case, white
space, digits, punctuation, parts of other characters), one for each of the most frequent languages and one for all
others. Spark counts the 4-grams of the whole corpus: each task adds up its own and sends the distinct ones. With
32 classes a language has at most 2**20 4-grams, which bounds what the driver smooths and the executors hold (about
16 MB a language at the very worst), however large the corpus. The model is stored as sorted arrays of 64-bit n-gram
hashes with log probabilities and back-off weights; tasks look up each distinct 4-gram once by binary search.

A document's log perplexity is compared with its language's median over the corpus; it is rejected below the lower and
above the upper edge of either band. The medians come from exact histograms. Short texts vary more, so the band is
wider for them, by ``SPREAD`` standard errors.

Defined cases: null, empty and wordless texts have no words and fail the base rules; a null or rare language
belongs to the pooled model of shapes, and rows without a language are a language of their own in spelling; repeated rows give repeated results; only id, text and language are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varsift.llm import symbol_model
from varsift.llm import text_arrays as ta
from varsift.llm.storage import written

ORDER = 4
BITS = 5
GRAMS = 1 << (ORDER * BITS)
LANGUAGES = 8
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Half-widths of the band in log perplexity, for long texts, and standard errors added for short ones.
LOWER, UPPER, SPREAD = 0.06, 0.45, 3.0
#: The same for the symbols' model.
SYMBOL_LOWER, SYMBOL_UPPER, SYMBOL_SPREAD = 0.25, 0.6, 4.0
BIN = 0.001

_CLASS = np.full(256, 28, np.int32)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 26
_CLASS[0x30:0x3A] = 27
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = np.arange(26)
_CLASS[0x80:0xC0] = 30 + (np.arange(0x80, 0xC0) >> 1 & 1)
_CLASS[0xC0:] = 29
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

STATS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_bytes long, "
         "log_perplexity double, deviation double")


def gram_codes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(4-gram code, row) ending at every byte; a row begins as if after white space."""
    size = np.diff(at)
    row = np.arange(len(size)).repeat(size)
    code = symbol = _CLASS[data]
    for k in range(1, ORDER):
        before = np.full(len(data), 26, np.int32)
        before[k:] = symbol[:-k]
        for j in range(k):  # the first bytes of a row
            first = at[:-1][size > j] + j
            before[first] = 26
        code = code | before << (BITS * k)
    return code, row


def base_stats(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The first five columns of STATS for each row."""
    n = len(at) - 1
    start, end, row = ta.word_spans(data, at, ta.NON_SPACE)
    points = ta.code_points(data)
    chars = np.bincount(row, points[end] - points[start], n).astype(np.int64)
    every = np.concatenate(([0], np.cumsum(_SYMBOL[data])))
    sums = ta.prefix_sums(data)
    # lines with a word: the lines that words lie in
    newline = data == 0x0A
    cut = np.unique(np.concatenate((at, np.flatnonzero(newline) + 1)))
    line = np.unique(np.searchsorted(cut, start, "right") - 1)
    low, high = cut[line], cut[np.minimum(line + 1, len(cut) - 1)] if len(line) else cut[line]
    high = np.where((high > low) & newline[np.maximum(high - 1, 0)], high - 1, high) if len(line) else high
    line_row = np.searchsorted(at, low, "right") - 1
    keys = ta.mix(ta.span_hashes(sums, low, high) + line_row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(keys, return_index=True)
    again = np.ones(len(keys), bool)
    again[first] = False
    words = ta.span_hashes(sums, start, end)
    grams = ta.shingle_hashes(words, WINDOW)
    inside = np.flatnonzero(row[: len(grams)] == row[WINDOW - 1 :]) if len(grams) else np.zeros(0, np.int64)
    own = ta.mix(grams[inside] + row[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    twice = np.zeros(len(own), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int64)
    cover[inside[twice]] += 1
    cover[inside[twice] + WINDOW] -= 1
    repeat = np.bincount(row[np.cumsum(cover)[:-1] > 0], minlength=n)
    return [ta.counts_by_row(row, n), chars, every[at[1:]] - every[at[:-1]], np.bincount(line_row[again], minlength=n), repeat]


# -- the model ---------------------------------------------------------------------------------------------------


def _key(language: int, order: int, code: np.ndarray) -> np.ndarray:
    return ta.mix(code.astype(np.uint64) + np.uint64((language * 8 + order + 1) << 32))


def _smoothed(counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order from one up: (n-gram codes, log probability, log back-off weight of the n-gram as a context)."""
    tables = [counts]
    for order in range(ORDER - 1, 0, -1):  # lower orders count the kinds of symbols before
        kinds = np.flatnonzero(tables[0]) & ((1 << BITS * order) - 1)
        tables.insert(0, np.bincount(kinds, minlength=1 << BITS * order))
    lower, p, left = np.full(1, 1 / 32), [], []
    for count in tables:
        many = [max(1, int((count == k).sum())) for k in range(1, 5)]
        y = many[0] / (many[0] + 2 * many[1])
        discounts = [0.0, *(min(max(k - (k + 1) * y * many[k] / many[k - 1], 0.05), k - 0.05) for k in (1, 2, 3))]
        taken = np.array(discounts)[np.minimum(count, 3)]
        total = np.maximum(count.reshape(-1, 32).sum(1), 1)
        weight = np.where(count.reshape(-1, 32).any(1), taken.reshape(-1, 32).sum(1) / total, 1.0)
        lower = (count - taken) / total.repeat(32) + weight.repeat(32) * np.tile(lower, 32)
        p.append(np.log(lower))
        left.append(np.log(weight))
    out = []
    for k, count in enumerate(tables):
        used = count > 0
        if k + 1 < ORDER:  # contexts of the next order have an entry in any case
            used |= tables[k + 1].reshape(-1, 32).any(1)
        codes = np.flatnonzero(used)
        out.append((codes, p[k][codes], left[k + 1][codes] if k + 1 < ORDER else np.zeros(len(codes))))
    return out


class Model:
    """All languages' n-grams in sorted hash arrays."""

    def __init__(self, counts: dict[int, tuple[np.ndarray, np.ndarray]]):
        keys, p, weight = [], [], []
        for language, (code, n) in counts.items():
            table = np.zeros(GRAMS, np.int64)
            table[code] = n
            for order, (codes, log_p, back) in enumerate(_smoothed(table), 1):
                keys.append(_key(language, order, codes))
                p.append(log_p)
                weight.append(back)
        keys = np.concatenate([np.zeros(0, np.uint64), *keys])
        order = np.argsort(keys)
        self.keys = keys[order]
        self.p = np.concatenate([np.zeros(0), *p])[order].astype(np.float32)
        self.weight = np.concatenate([np.zeros(0), *weight])[order].astype(np.float32)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        return place, self.keys[place] == keys if len(self.keys) else np.zeros(len(keys), bool)

    def log_p(self, language: int, code: np.ndarray) -> np.ndarray:
        """Log probability of each 4-gram's last symbol after the others, backing off while it is unseen."""
        out = np.zeros(len(code))
        open_ = np.arange(len(code))
        for order in range(ORDER, 0, -1):
            own = code[open_] & ((1 << BITS * order) - 1)
            place, found = self._find(_key(language, order, own))
            out[open_[found]] += self.p[place[found]]
            open_, own = open_[~found], own[~found]
            if order > 1:
                place, found = self._find(_key(language, order - 1, own >> BITS))
                out[open_[found]] += self.weight[place[found]]
        out[open_] += np.log(1 / 32)
        return out


def languages(docs: DataFrame, lang_col: str = "lang") -> list[str]:
    """The most frequent languages, each with a model of its own."""
    top = docs.where(F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).alias("lang")).count()
    return [r.lang for r in top.orderBy(F.desc("count"), "lang").limit(LANGUAGES - 1).collect()]


def count_grams(texts: DataFrame, n_languages: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By language: distinct 4-grams of the whole corpus and their counts. ``texts``: _text, _lang (a number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            lang = batch.column(1).to_numpy()
            for rows, data, at in ta.chunks(batch, "_text"):
                code, row = gram_codes(data, at)
                own = lang[rows][row]
                for k in np.unique(own).tolist():
                    here = code[own == k]
                    if k not in total:
                        total[k] = np.zeros(GRAMS, np.int64)
                    if len(here) > GRAMS // 8:
                        total[k] += np.bincount(here, minlength=GRAMS)
                    else:
                        np.add.at(total[k], here, 1)
        for k, t in total.items():
            code = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), k, np.int32)), pa.array(code.astype(np.int32)), pa.array(t[code])],
                                             ["lang", "code", "n"])

    counted = texts.mapInArrow(run, "lang int, code int, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas()
    return {int(k): (g["code"].to_numpy(np.int64), g["n"].to_numpy(np.int64)) for k, g in counted.groupby("lang")}


def _scorer(model: Model):
    def make():
        seen = np.zeros((LANGUAGES, GRAMS), bool)
        value = np.zeros((LANGUAGES, GRAMS), np.float32)

        def score(data: np.ndarray, at: np.ndarray, rows: pa.RecordBatch) -> list:
            tag = rows.column("number").to_numpy().astype(np.int64)
            code, row = gram_codes(data, at)
            lang = tag[row]
            for k in np.unique(tag).tolist():
                here = code[lang == k]
                fresh = np.unique(here[~seen[k, here]])
                value[k, fresh] = model.log_p(k, fresh)
                seen[k, fresh] = True
            p = value[lang, code].astype(np.float64)
            n = len(at) - 1
            many = np.maximum(np.diff(at), 1)
            mean = np.bincount(row, p, n) / many
            square = np.bincount(row, p * p, n) / many
            return [*base_stats(data, at), np.diff(at), -mean, np.sqrt(np.maximum(square - mean * mean, 0))]

        return score

    return make


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row of ``docs``: id, language, STATS, those of ``symbol_model``, ``lower``/``upper`` edges of both, ``base_failed``, ``kept``."""
    names = languages(docs, lang_col)
    number = F.coalesce(*[F.when(F.col(lang_col) == name, F.lit(k)) for k, name in enumerate(names)], F.lit(LANGUAGES - 1))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    model = Model(count_grams(docs.select(text.alias("_text"), number.alias("_lang")), len(names)))
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), text.alias("text"), number.alias("number"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    found = written(symbol_model.scored(rows, STATS, _scorer(model)).withColumn("base_failed", failed), "scored")
    kept = ~F.col("base_failed")
    for by, name, n, lower, upper, spread in (("number", "", "n_bytes", LOWER, UPPER, SPREAD),
                                              ("lang", "symbol_", "n_grams", SYMBOL_LOWER, SYMBOL_UPPER, SYMBOL_SPREAD)):
        found = found.join(_medians(found, by, f"{name}log_perplexity"), F.col(by).eqNullSafe(F.col("_of")), "left").drop("_of")
        slack = spread * F.col(f"{name}deviation") / F.sqrt(F.greatest(F.col(n), F.lit(1)))
        found = found.withColumn(f"{name}lower", F.col("_middle") - lower - slack).withColumn(f"{name}upper", F.col("_middle") + upper + slack)
        inside = F.col(f"{name}log_perplexity").between(F.col(f"{name}lower"), F.col(f"{name}upper"))
        found, kept = found.drop("_middle"), kept & F.coalesce(inside, F.lit(True))
    return found.withColumn("kept", kept).select(F.col("id").alias(id_col), *[c for c in found.columns if c != "id"], "kept")


def _medians(found: DataFrame, by: str, value: str) -> DataFrame:
    """(_of, _middle): the median of a value over the documents that pass the base rules, from an exact histogram."""
    bins = found.where("not base_failed").groupBy(by, F.floor(F.col(value) / BIN).alias("bin")).agg(F.count("*").alias("n"))
    upto = bins.withColumn("upto", F.sum("n").over(Window.partitionBy(by).orderBy("bin")))
    upto = upto.withColumn("all", F.sum("n").over(Window.partitionBy(by)))
    return upto.where("2 * upto >= all").groupBy(F.col(by).alias("_of")).agg(((F.min("bin") + 0.5) * BIN).alias("_middle"))


def contract(docs: DataFrame) -> DataFrame:
    """The columns of op5."""
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                               "kept", "log_perplexity", "lower", "upper", "symbol_log_perplexity", "symbol_lower", "symbol_upper")
