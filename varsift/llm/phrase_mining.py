"""Phrase collocation mining by dynamic itemset counting.

The corpus is written once in ``SHARDS`` shards and scanned in a cycle, one shard a step. All lengths are counted in the
same scans: words from the first step on, a longer phrase from the step after both its subphrases (without the last and
without the first word) have reached the threshold. Every phrase is counted for one full cycle, so its count is exact.

What the tasks need to know is one bounded table (``SLOTS`` bytes): for each hash slot the step from which the phrases
in it count as frequent. A phrase begins where both its subphrases' slots have begun. Two phrases in one slot can only
begin a phrase early or in vain; it still gets its full cycle, and its exact count decides. Slots never close, so no
frequent phrase is missed: its subphrases are at least as frequent.

A task numbers the words and phrases of a chunk exactly (dictionaries, no hashes) and sends each distinct phrase once
with its count; Spark adds them up. Phrases in their cycle are written to the shared folder after each step, with those
that finish; nothing but newly begun slots reaches the driver.

Scores follow by joins of the frequent phrases with their parts, in exact decimals (counts below 10**15). A phrase goes if
one that is a word longer has the same count (any longer one with the same count implies that). Tops are taken per
language in salted groups first.

Defined cases: a null text is empty, a null language ``und``; an empty language is its own; repeated rows count again;
ids and other columns are not read; empty tables and languages without candidates give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varsift.llm import text_arrays as ta
from varsift.llm.storage import shared_path, shuffles_dropped

SHARDS = 2
LONGEST = 5
LEAST = 100
TOP = 2000
SLOTS = 1 << 22
CHUNK = 1 << 21
SALTS = 64
_NEVER = 255
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False
#: A counted phrase: ``name`` is the phrase, a line break and the language (words hold no line break).
COUNTS = "name binary, since int, n long"
_LINE = pa.scalar(b"\n", pa.large_binary())
_GAP = pa.scalar(b" ", pa.large_binary())


def _language_hashes(names: list[str]) -> np.ndarray:
    raw = [x.encode() for x in names]
    data = np.frombuffer(b"".join(raw) + b" ", np.uint8)
    ends = np.cumsum([len(x) for x in raw], dtype=np.int64)
    return ta.span_hashes(ta.prefix_sums(data), np.append(0, ends)[:-1], ends)


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, language: np.ndarray) -> np.ndarray:
    """Hashes of words within their languages."""
    return ta.mix(ta.span_hashes(ta.prefix_sums(data), start, end) ^ language)


def _region(size: int, slots: int) -> slice:
    """The slots of one phrase length: a quarter of the table."""
    return slice((size - 1) * (slots // 4), size * (slots // 4))


def _slots(words: np.ndarray, size: int, slots: int) -> np.ndarray:
    """Slots of the phrases of ``size`` words that begin at each word."""
    return (ta.shingle_hashes(words, size) & np.uint64(slots // 4 - 1)).astype(np.int64) + _region(size, slots).start


class Chunk:
    """The words of a chunk of texts, and the phrases that begin at them."""

    def __init__(self, data: np.ndarray, at: np.ndarray, language: np.ndarray, names: list[str]):
        data = np.ascontiguousarray(ta.LOWER[data])
        start, end, row = ta.word_spans(data, at, _WORD)
        self.words = len(start)
        self.language = language[row]
        self.names = pa.array([x.encode() for x in names], pa.large_binary())
        # words and gaps alternate in one Arrow array without a copy; the words are its even entries
        edges = np.empty(2 * len(start), np.int64)
        edges[::2], edges[1::2] = start, end
        self.whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), max(0, len(edges) - 1),
                                                      [None, pa.py_buffer(edges), pa.py_buffer(data)])
        self.all: tuple[pa.Array, np.ndarray] | None = None
        self.hashes = _hashes(data, start, end, _language_hashes(names)[self.language]) if len(start) else np.zeros(0, np.uint64)
        # two words are apart if a break lies in their gap: mostly its first or last byte
        after, before = end[:-1], start[1:]
        apart = _BREAK[data[after]] | _BREAK[data[before - 1]] if len(start) else np.zeros(0, bool)
        wide = np.flatnonzero((before - after > 2) & ~apart)
        if len(wide):
            inner = np.column_stack([after[wide], before[wide]]).ravel()
            apart[wide] = np.logical_or.reduceat(_BREAK[data], inner)[::2]
        # how many words of its piece follow each word, itself included
        last = np.append(np.flatnonzero(apart | (row[1:] != row[:-1])), len(start) - 1)[: len(start)]
        self.left = last.repeat(np.diff(np.append(-1, last))) - np.arange(len(start)) + 1

    def _numbered(self, places: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        known = self.whole.take(pa.array(2 * places)).dictionary_encode()
        return known.dictionary, known.indices.to_numpy().astype(np.int64)

    def _spelled(self, begin: np.ndarray, size: int) -> tuple[pa.Array, list[np.ndarray]]:
        """The distinct words of some phrases and, for each place in the phrase, the words' numbers (exact, no hashes)."""
        if self.all is None and 4 * size * len(begin) < self.words:
            used = np.unique(begin[:, None] + np.arange(size))
            words, number = self._numbered(used)
            return words, [number[np.searchsorted(used, begin + k)] for k in range(size)]
        if self.all is None:
            self.all = self._numbered(np.arange(self.words))
        return self.all[0], [self.all[1][begin + k] for k in range(size)]

    def counts(self, size: int, begin: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """Each distinct phrase of ``size`` words that begins at a word of ``begin``: a place, its name, its count."""
        words, places = self._spelled(begin, size)
        number = pd.factorize(places[0] * len(self.names) + self.language[begin])[0]
        for k in range(1, size):
            number = pd.factorize(number * len(words) + places[k])[0]
        many = int(number.max()) + 1 if len(number) else 0
        first = np.empty(many, np.int64)
        first[number[::-1]] = np.arange(len(begin))[::-1]
        own = [words.take(pa.array(k[first])) for k in places]
        phrase = own[0] if size == 1 else pc.binary_join_element_wise(*own, _GAP)
        first = begin[first]
        name = pc.binary_join_element_wise(phrase, self.names.take(pa.array(self.language[first])), _LINE)
        return first, name, np.bincount(number, minlength=many)

    def totals(self) -> tuple[pa.Array, np.ndarray]:
        """The number of words of each language, under the empty phrase."""
        n = np.bincount(self.language, minlength=len(self.names))
        used = np.flatnonzero(n)
        own = self.names.take(pa.array(used))
        return pc.binary_join_element_wise(pa.array([b""] * len(used), pa.large_binary()), own, _LINE), n[used]


def _counter(step: int, begun: np.ndarray, shards: int):
    """A task's counting of one shard: phrases within their cycle, and in the first cycle the words."""

    def rows(name: pa.Array, since: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([name.cast(pa.binary()), pa.array(since.astype(np.int32)), pa.array(n.astype(np.int64))],
                                          names=["name", "since", "n"])

    oldest = max(0, step - shards + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a phrase within its cycle has a part that began in these steps; sizes without any are not looked at
        parts = {size: begun[_region(size, len(begun))] for size in range(1, LONGEST)}
        open_sizes = {size + 1: bool(((x >= oldest) & (x <= step)).any()) for size, x in parts.items()}
        for batch in batches:
            coded = batch.column(batch.schema.get_field_index("lang")).dictionary_encode()
            names, language = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            for own, data, at in ta.chunks(batch, "text", CHUNK):
                chunk = Chunk(data, at, language[own], names)
                if not chunk.words:
                    continue
                if step < shards:
                    _, name, n = chunk.counts(1, np.arange(chunk.words))
                    yield rows(name, np.zeros(len(n)), n)
                    name, n = chunk.totals()
                    yield rows(name, np.zeros(len(n)), n)
                for size in range(2, LONGEST + 1):
                    if not open_sizes[size]:
                        continue
                    known = begun[_slots(chunk.hashes, size - 1, len(begun))]
                    since = np.maximum(known[:-1], known[1:])
                    begin = np.flatnonzero((since >= oldest) & (since <= step))
                    begin = begin[chunk.left[begin] >= size]
                    if len(begin):
                        first, name, n = chunk.counts(size, begin)
                        yield rows(name, since[first], n)

    return run


def _new_slots(slots: int):
    """The slots of phrases (lang, phrase, size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            language = _language_hashes(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
            sizes = batch.column(2).to_numpy()
            for own, data, at in ta.chunks(batch, "phrase", CHUNK):
                start, end, row = ta.word_spans(data, at, _WORD)
                words = _hashes(data, start, end, language[own][row])
                first = np.append(0, np.cumsum(sizes[own]))[:-1]
                found = [_slots(words, int(k), slots)[first[sizes[own] == k]] for k in np.unique(sizes[own])]
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)).astype(np.int32))], names=["slot"])

    return run


def _named(counts: DataFrame) -> DataFrame:
    """(lang, phrase, size, n) of counted phrases; the empty phrase has size 0."""
    rows = counts.select(F.col("name").cast("string").alias("name"), "n")
    rows = rows.select(F.expr("substring_index(name, '\n', 1)").alias("phrase"), "name", "n")
    size = F.when(F.col("phrase") == "", 0).otherwise(
        F.char_length("phrase") - F.char_length(F.translate("phrase", " ", "")) + 1)
    return rows.select(F.expr("substring(name, char_length(phrase) + 2)").alias("lang"), "phrase", size.alias("size"), "n")


def frequent_phrases(docs: DataFrame, least: int = LEAST, shards: int = SHARDS, slots: int = SLOTS,
                     text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, phrase, size, n) of every phrase of 1 to ``LONGEST`` words found ``least`` times or more in its language;
    size 0 holds the number of all words of a language. ``slots`` is a power of two, 4 or more."""
    spark = docs.sparkSession
    corpus, states = shared_path(spark, "phrase-shards"), shared_path(spark, "phrase-counts")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    rows.where("text <> ''").withColumn("shard", (F.monotonically_increasing_id() % shards).cast("int")).write.partitionBy(
        "shard").parquet(corpus, compression="zstd")
    schema = f"{COUNTS}, finished boolean"
    open_rows = spark.createDataFrame([], COUNTS)
    begun = np.full(slots, _NEVER, np.uint8)
    step, newest = 0, 0
    total_row = F.substring("name", 1, 1) == F.lit(b"\n")
    while step < newest + shards:
        if step >= _NEVER:
            raise ValueError("too many shards")
        shard = spark.read.schema("lang string, text string, shard int").parquet(corpus).where(
            F.col("shard") == step % shards).select("lang", "text")
        path = f"{states}/step-{step:03d}"
        with shuffles_dropped(spark):
            fresh = shard.mapInArrow(_counter(step, begun, shards), COUNTS)
            total = fresh.unionByName(open_rows).groupBy("name", "since").agg(F.sum("n").alias("n"))
            total = total.withColumn("finished", F.col("since") + shards <= step + 1)
            total.where((F.col("n") >= least) | ~F.col("finished") | total_row).write.parquet(path, compression="zstd")
        state = spark.read.schema(schema).parquet(path)
        often = _named(state.where(F.col("n") >= least)).where(F.col("size").between(1, LONGEST - 1))
        found = often.select("lang", "phrase", "size").mapInArrow(_new_slots(slots), "slot int").distinct().toArrow()["slot"].to_numpy()
        found = found[begun[found] == _NEVER]
        step += 1
        if len(found):
            begun = begun.copy()
            begun[found] = newest = step
        open_rows = state.where(~F.col("finished")).drop("finished")
    paths = [f"{states}/step-{k:03d}" for k in range(step)]
    return _named(spark.read.schema(schema).parquet(*paths).where("finished"))


def collocations(found: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The best phrases of each language from ``frequent_phrases``, with their ranks and scores."""
    phrases = found.where("size between 2 and 5").select("lang", "phrase", "size", F.col("n").alias("a"))
    parts = found.where("size between 1 and 4")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("head", F.expr("substring_index(phrase, ' ', k)")).withColumn(
        "rest", F.expr("substring_index(phrase, ' ', k - size)"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    # the number of words is dealt to salts, so that one language is not one join key
    words = found.where("size = 0").groupBy("lang").agg(F.sum("n").alias("all_words")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    cuts = cuts.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")).join(words, ["lang", "salt"])
    exact = {c: f"CAST({c} AS DECIMAL(15, 0))" for c in ("a", "all_words", "l", "r")}
    score = F.expr(f"(1000 * {exact['a']} * {exact['all_words']}) div ({exact['l']} * {exact['r']})")
    low = cuts.groupBy("lang", "phrase", "size", "a", "salt", "all_words").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    inner = F.explode(F.array(F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substring_index(phrase, ' ', 1 - size)")))
    longer = phrases.where("size > 2").select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(
        F.max("a").alias("longer"))
    kept = low.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
    kept = kept.select("lang", "salt", "phrase", "a", "cut.l", "cut.r", F.col("all_words").alias("n"), "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def contract(docs: DataFrame) -> DataFrame:
    """The columns of op12."""
    return collocations(frequent_phrases(docs))


#: The same rows in DuckDB.
SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS words FROM pieces),
counted AS (
  SELECT lang, array_to_string(words[i:i + k - 1], ' ') AS phrase, k AS size, count(*) AS a
  FROM worded, range(1, {LONGEST + 1}) r(k), range(1, len(words) - k + 2) s(i) GROUP BY ALL),
totals AS (SELECT lang, sum(a) AS n FROM counted WHERE size = 1 GROUP BY lang),
f AS (SELECT * FROM counted WHERE a >= {LEAST}),
cuts AS (
  SELECT p.lang, p.phrase, p.size, p.a, k, array_to_string(p.words[1:k], ' ') AS head, array_to_string(p.words[k + 1:], ' ') AS rest
  FROM (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE size > 1) p, range(1, p.size) r(k)),
scored AS (
  SELECT c.lang, c.phrase, c.size, c.a, c.k, h.a AS l, t.a AS r, n,
    (1000::HUGEINT * c.a * n) // (h.a::HUGEINT * t.a) AS score
  FROM cuts c JOIN f h ON c.lang = h.lang AND c.head = h.phrase JOIN f t ON c.lang = t.lang AND c.rest = t.phrase
    JOIN totals ON c.lang = totals.lang),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, unnest([array_to_string(w[1:size - 1], ' '), array_to_string(w[2:], ' ')]) AS phrase, a
  FROM (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 2)),
kept AS (SELECT * FROM low WHERE NOT EXISTS (
  SELECT 1 FROM longer x WHERE x.lang = low.lang AND x.phrase = low.phrase AND x.a >= low.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= {TOP}
"""
