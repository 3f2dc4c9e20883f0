"""Benchmark decontamination: prefix-filtered set join of documents against benchmark windows.

A window is 10 consecutive words of an item (a shorter item is one window). Containment of a window in a
document asks for all of its shingles, so one of them, any one, is a necessary prefix token: the shingles of
every window are ordered by rarity over the corpus (Spark counts them first) and the rarest is joined. A
candidate must then pass the positional bound (the window, laid so that the tokens meet, lies inside the
document's words) and the length bound, and its words are compared one by one.

The documents are never shuffled. The index holds benchmark words only; it is built for blocks of items of at
most ``block_bytes`` of text (the bound on what is collected and sent to the executors), one pass over the
documents for each block, so a benchmark of any size runs in bounded memory.

Defined cases: null or wordless texts have no words and no hits; items with a null id or without words are
ignored; rows of one item_id are one item; repeated documents, and rows with equal or null ids, give a row each, whatever
the benchmark's size (beyond one block of items ids and texts are written once with a row key, by which passes are merged);
an empty table on either side gives no hits. Only the id and text columns are read, others may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varsift.llm import text_arrays as ta
from varsift.llm.arrow_jobs import keep_rows, report
from varsift.llm.storage import written

WINDOW = 10
SHINGLE = 3
BLOCK_BYTES = 4 << 20
FIELDS = "n_words long, hits array<int>, items array<string>"


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = ta.LOWER[data]
    start, end, row = ta.word_spans(data, at, ta.ALNUM)
    return ta.span_hashes(ta.prefix_sums(data), start, end), row


class WindowIndex:
    """Windows of a block of items; ``choose`` fixes each one's prefix token from the corpus counts."""

    def __init__(self, items: list[tuple[str, str]]):
        self.names = sorted({i for i, _ in items})
        number = {name: k for k, name in enumerate(self.names)}
        seen: dict[tuple[int, bytes], None] = {}
        for name, text in items:
            data = np.frombuffer((text or "").encode(), np.uint8)
            words, _ = _words(data, np.array([0, len(data)]))
            size = min(WINDOW, len(words))
            for s in range(len(words) - size + 1 if size else 0):
                seen[number[name], words[s : s + size].tobytes()] = None
        self.item = np.array([k for k, _ in seen], np.int64)
        self.size = np.array([len(w) // 8 for _, w in seen], np.int64)
        self.words = np.zeros((len(seen), WINDOW), np.uint64)
        for k, (_, w) in enumerate(seen):
            self.words[k, : len(w) // 8] = np.frombuffer(w, np.uint64)
        self.tokens: dict[int, tuple] = {}

    def lengths(self) -> list[int]:
        """Shingle lengths in use: SHINGLE words, or the whole of a shorter item."""
        return sorted(set(np.minimum(self.size, SHINGLE).tolist()))

    def shingles(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, offset, hash) of the shingles of the windows that use this length."""
        own = np.flatnonzero(np.minimum(self.size, SHINGLE) == length)
        out = []
        for offset in range(WINDOW - length + 1):
            has = own[self.size[own] >= offset + length]
            block = self.words[has, offset : offset + length]
            hashes = ta.shingle_hashes(block.reshape(-1), length)[::length] if len(has) else np.zeros(0, np.uint64)
            out.append((has, np.full(len(has), offset), hashes))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def vocabulary(self) -> dict[int, np.ndarray]:
        return {n: np.unique(self.shingles(n)[2]) for n in self.lengths()}

    def choose(self, count: dict[int, int]) -> WindowIndex:
        """Keep of each window its rarest shingle (ties: smaller hash, then first) and index them."""
        for n in self.lengths():
            window, offset, token = self.shingles(n)
            rarity = np.array([count.get(int(t), 0) for t in token.view(np.int64)], np.int64)
            order = np.lexsort((offset, token, rarity, window))
            first = order[np.unique(window[order], return_index=True)[1]]
            first = first[np.argsort(token[first], kind="stable")]
            keys, at = np.unique(token[first], return_index=True)
            self.tokens[n] = keys, np.append(at, len(first)), window[first], offset[first]
        return self

    def scorer(self):
        """Per chunk: word count, flat (start, end) code point runs of hit words, names of the items found."""

        def score(data: np.ndarray, at: np.ndarray) -> list:
            n = len(at) - 1
            lower = ta.LOWER[data]
            start, end, row = ta.word_spans(lower, at, ta.ALNUM)
            words = ta.span_hashes(ta.prefix_sums(lower), start, end)
            found, where = self.matches(words, row)
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, where, 1)
            np.add.at(cover, where + self.size[found], -1)
            hit = np.cumsum(cover)[:-1] > 0
            pair = np.unique(row[where] * len(self.names) + self.item[found]) if len(found) else np.zeros(0, np.int64)
            item_row = pair // max(1, len(self.names))
            names = pa.array([self.names[k] for k in (pair % max(1, len(self.names))).tolist()], pa.string())
            points = ta.code_points(data)
            low = points[at[row]] if len(row) else row
            flat = np.stack([points[start] - low, points[end] - low], 1)[hit].reshape(-1)
            return [ta.counts_by_row(row, n), _lists(pa.array(flat, pa.int32()), row[hit].repeat(2), n),
                    _lists(names, item_row, n)]

        return score

    def matches(self, words: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, first word) of every occurrence."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for n, (keys, at, window, offset) in self.tokens.items():
            shingles = ta.shingle_hashes(words, n)
            place = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
            p = np.flatnonzero(keys[place] == shingles)
            k = place[p]
            many = at[k + 1] - at[k]
            p = p.repeat(many)
            j = at[k].repeat(many) + np.arange(len(p)) - (np.cumsum(many) - many).repeat(many)
            w, s = window[j], p - offset[j]
            inside = (s >= 0) & (s + self.size[w] <= len(words))
            w, s = w[inside], s[inside]
            inside = row[s] == row[s + self.size[w] - 1] if len(s) else np.zeros(0, bool)
            w, s = w[inside], s[inside]
            same = np.ones(len(w), bool)
            for d in range(WINDOW):
                live = np.flatnonzero(same & (self.size[w] > d))
                same[live] = words[s[live] + d] == self.words[w[live], d]
            out.append((w[same], s[same]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _lists(values: pa.Array, row: np.ndarray, n: int) -> pa.Array:
    """A list column from values sorted by row."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()), values)


def _count_shingles(docs: DataFrame, vocabulary: dict[int, np.ndarray], text_col: str) -> dict[int, int]:
    """Corpus counts of the index's shingles: summed in each task, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {n: np.zeros(len(v), np.int64) for n, v in vocabulary.items()}
        for batch in batches:
            for _, data, at in ta.chunks(batch, "_text"):
                words, row = _words(data, at)
                for n, keys in vocabulary.items():
                    shingles = ta.shingle_hashes(words, n)
                    shingles = shingles[row[: len(shingles)] == row[n - 1 :]]
                    place = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
                    total[n] += np.bincount(place[keys[place] == shingles], minlength=len(keys))
        for n, keys in vocabulary.items():
            some = total[n] > 0
            yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(total[n][some])],
                                             ["token", "n"])

    counted = docs.select(F.col(text_col).cast("string").alias("_text")).mapInArrow(run, "token long, n long")
    return {r.token: r.n for r in counted.groupBy("token").agg(F.sum("n").alias("n")).toLocalIterator()}


def window_indexes(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                   item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> list[WindowIndex]:
    """One index for each block of items, with prefix tokens chosen by the counts over ``docs``."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"),
                             F.col(item_text).cast("string").alias("text")).where("item is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    out = []
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).collect()
        index = WindowIndex([(r.item, r.text) for r in rows])
        if len(index.item):
            out.append(index.choose(_count_shingles(docs, index.vocabulary(), text_col)))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document row: id, ``n_words``, ``hits`` (flat code point starts and ends of the hit words), ``items``."""
    indexes = window_indexes(docs, benchmark, text_col, item_col, item_text, block_bytes) or [WindowIndex([])]
    if len(indexes) == 1:
        return report(docs, indexes[0].scorer, FIELDS, id_col, text_col)
    key = F.struct(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"))
    keyed = written(docs.select(key.alias("_key"), F.col(text_col).cast("string").alias("_text")), "keyed")
    scan = [report(keyed, index.scorer, FIELDS, "_key", "_text") for index in indexes]
    pairs = "transform(sequence(0, size(hits) - 1, 2), i -> array(hits[i], hits[i + 1]))"
    rows = reduce(DataFrame.unionByName, scan).withColumn(
        "pairs", F.when(F.size("hits") > 0, F.expr(pairs)).otherwise(F.expr("cast(array() as array<array<int>>)")))
    merged = rows.groupBy("_key.row").agg(
        F.first("_key.id").alias(id_col),
        F.first("n_words").alias("n_words"),
        F.expr("flatten(array_sort(array_distinct(flatten(collect_list(pairs)))))").alias("hits"),
        F.expr("array_sort(array_distinct(flatten(collect_list(items))))").alias("items"))
    return merged.select(id_col, "n_words", "hits", "items")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents in which no window of any item occurs; all columns as they are."""
    for index in window_indexes(docs, benchmark, text_col):
        def decide(index=index):
            score = index.scorer()
            return lambda data, at: np.diff(score(data, at)[2].offsets.to_numpy()) == 0

        docs = keep_rows(docs, decide, text_col)
    return docs


def contract(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The columns of op9."""
    n_hit = F.size("hits") / 2
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", n_hit.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


_SQL_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

#: The same rows in DuckDB: every run of words of a window's length is joined to the windows as text.
SQL = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_SQL_WORDS} AS words FROM documents),
items AS MATERIALIZED (SELECT row_number() OVER () AS r, item_id, {_SQL_WORDS} AS words FROM benchmark WHERE item_id IS NOT NULL),
ahead AS (SELECT r, i, list(w) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS next
  FROM (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM docs)),
item_ahead AS (SELECT item_id, n, i, list(w) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS next
  FROM (SELECT r, item_id, len(words) AS n, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM items)),
windows AS (SELECT DISTINCT item_id, len(next) AS k, array_to_string(next, ' ') AS run FROM item_ahead
  WHERE i <= greatest(n - {WINDOW} + 1, 1)),
lengths AS (SELECT DISTINCT k FROM windows),
runs AS (SELECT r, i, k, array_to_string(next[1:k], ' ') AS run FROM ahead JOIN lengths ON len(next) >= k),
found AS (SELECT r, i, k, item_id FROM runs JOIN windows USING (k, run)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
