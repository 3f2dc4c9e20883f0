"""Suffix-array deduplication of repeated byte strings, for corpora whose full suffix array no cluster could shuffle.

Removed is every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else. The suffix array is
sparse but exact:

* Sampling. Of a window's first half of starting points the one with the least hash of its next bytes is the
  window's sample; equal windows have the same sample at the same place, so only suffixes at samples (about one
  in 100 bytes) need sorting. A suffix's leading tokens are the half window that all windows of the sample share.
* Spark counts the leading tokens by hash; only suffixes whose leading tokens occur twice go on. Those equal in
  all bytes that any of their windows covers are settled by their hash and their count.
* The others' bytes are range-partitioned by their leading tokens with Spark's sampled splitters. Each bucket sorts
  its suffixes, and likewise the reversed bytes before them, by multikey quicksort with 8-byte characters; the common
  prefix lengths of neighbours then say, for each offset of a window to its sample, which windows are equal.
* Across boundaries: splitters fall between leading tokens, so suffixes that share them meet in one bucket; a
  class too large for a bucket (a passage in very many different settings) is cut into its windows instead,
  which Spark counts across all buckets.

Only hashes, the bytes of unsettled suffixes and, at the end, the texts with their spans are shuffled.

Defined cases: null and empty texts and texts shorter than LENGTH lose nothing; equal rows are copies of each other;
null and repeated ids give one row for each row. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varsift.llm import text_arrays as ta
from varsift.llm.storage import written

LENGTH = 400
HALF = LENGTH // 2
GRAM = 16
PIECE = 4 << 20
LARGE_CLASS = 4096
BITMAP_BITS = 25
GROUP_ROWS = 1 << 14
_LOW = np.uint64((1 << 24) - 1)


def samples(data: np.ndarray, at: np.ndarray) -> Iterator[tuple]:
    """(row, sample, first window, last window, class hash, full hash) arrays, in pieces; places in the chunk."""
    for low in range(0, max(1, len(data)), PIECE):
        part = data[low : low + PIECE + LENGTH + HALF]
        n = len(part)
        starts = min(PIECE, n - LENGTH + 1)
        if starts <= 0:
            return
        sums = ta.prefix_sums(part)
        place = np.arange(n - GRAM + 1)
        least = (ta.span_hashes(sums, place, place + GRAM) & ~_LOW) | place.astype(np.uint64)
        step, wide = 1, least
        while 2 * step <= HALF:
            wide = np.minimum(wide[:-step], wide[step:])
            step *= 2
        rest = HALF - step
        wide = np.minimum(wide[: len(wide) - rest], wide[rest:])
        window = np.arange(starts)
        row = np.searchsorted(at, window + low, "right") - 1
        fits = window + low + LENGTH <= at[row + 1]
        window, row = window[fits], row[fits]
        if not len(window):
            continue
        sample = (wide[window] & _LOW).astype(np.int64)
        new = np.flatnonzero(np.append(True, (sample[1:] != sample[:-1]) | (row[1:] != row[:-1])))
        first, last = window[new], window[np.append(new[1:], len(window)) - 1]
        sample, row = sample[new], row[new]
        full = ta.mix(ta.span_hashes(sums, first, last + LENGTH)
                      + ((sample - first) * 1024 + (sample - last)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        yield row, sample + low, first + low, last + low, ta.span_hashes(sums, sample, sample + HALF), full


def _sampled(docs: DataFrame) -> DataFrame:
    """(lead, full, key, sample, first, last) of every sampled suffix; places in bytes of the text."""

    def run(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for rows, data, at in ta.chunks(batch, "_text"):
                for row, sample, first, last, lead, full in samples(data, at):
                    low = at[row]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lead.view(np.int64)), pa.array(full.view(np.int64)), pa.array(keys[rows][row]),
                         *(pa.array((x - low).astype(np.int32)) for x in (sample, first, last))],
                        ["lead", "full", "key", "sample", "first", "last"])

    return docs.select("_key", "_text").mapInArrow(run, "lead long, full long, key long, sample int, first int, last int")


def _contexts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """The bytes of the asked (lead, full): read again from the texts, each once in a task.

    A bitmap (bounded: 4 MB) of the asked hashes keeps other suffixes from being sent.
    """
    slot = F.col("full").bitwiseAND((1 << BITMAP_BITS) - 1)
    wanted = (asked.groupBy(F.shiftright(slot, 6).alias("word"))
              .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(full & 63 as int))")).alias("bits")).toArrow())
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    bitmap[wanted["word"].to_numpy()] = wanted["bits"].to_numpy().view(np.uint64)

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for _, data, at in ta.chunks(batch, "_text"):
                for _, sample, first, last, lead, full in samples(data, at):
                    place = full & np.uint64((1 << BITMAP_BITS) - 1)
                    hit = (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)
                    own = [k for k in np.flatnonzero(hit).tolist() if not (int(full[k]) in seen or seen.add(int(full[k])))]
                    if own:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(lead[own].view(np.int64)), pa.array(full[own].view(np.int64)),
                             pa.array((sample - first)[own].astype(np.int32)), pa.array((sample - last)[own].astype(np.int32)),
                             pa.array([data[first[k] : last[k] + LENGTH].tobytes() for k in own], pa.binary())],
                            ["lead", "full", "most", "least", "bytes"])

    found = docs.select("_text").mapInArrow(run, "lead long, full long, most int, least int, bytes binary")
    return found.dropDuplicates(["lead", "full"]).join(asked, ["lead", "full"])


def multikey_sort(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte rows within groups, and each one's common prefix with its predecessor (-1: other group).

    Each round sorts by the next 8-byte character, only within runs that are equal so far.
    """
    n, width = rows.shape
    words = rows.view(">u8")
    order = np.argsort(group, kind="stable")
    run = np.append(0, np.cumsum(group[order][1:] != group[order][:-1])) if n else order
    for k in range(words.shape[1]):
        tied = np.zeros(n, bool)
        same = run[1:] == run[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        active = np.flatnonzero(tied)
        if not len(active):
            break
        word = words[order[active], k]
        turn = np.lexsort((word, run[active]))
        order[active] = order[active][turn]
        word = word[turn]
        cut = np.ones(n, bool)
        cut[1:] = run[1:] != run[:-1]
        inner = np.flatnonzero(active[1:] == active[:-1] + 1) + 1
        cut[active[inner]] |= word[inner] != word[inner - 1]
        run = np.cumsum(cut)
    common = np.full(n, -1)
    differs = rows[order[1:]] != rows[order[:-1]]
    common[1:] = np.where(differs.any(1), differs.argmax(1), width)
    common[1:][group[order[1:]] != group[order[:-1]]] = -1
    return order, common


def equal_windows(group: np.ndarray, most: np.ndarray, least: np.ndarray, texts: list[bytes],
                  alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix the largest and smallest window offset that some other suffix of its group shares (-1: none)."""
    n = len(group)
    right, left = np.zeros((n, HALF), np.uint8), np.zeros((n, HALF), np.uint8)
    for k, text in enumerate(texts):
        whole = np.frombuffer(text, np.uint8)
        tail = whole[most[k] + HALF :]
        right[k, : len(tail)] = tail
        left[k, : most[k]] = whole[: most[k]][::-1]
    order_r, common_r = multikey_sort(right, group)
    order_l, common_l = multikey_sort(left, group)
    high, low = np.full(n, -1), np.full(n, -1)
    name_r, name_l = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for b in range(int(least.min()), int(most.max()) + 1):
        name_r[order_r] = np.cumsum(common_r < HALF - b)
        name_l[order_l] = np.cumsum(common_l < b)
        own = np.flatnonzero((least <= b) & (b <= most))
        _, which, many = np.unique(name_r[own] * (n + 1) + name_l[own], return_inverse=True, return_counts=True)
        twice = own[(many[which] > 1) | ~alone[own]]
        high[twice] = b
        low[twice[low[twice] < 0]] = b
    return high, low


def _settled_in_buckets(contexts: DataFrame) -> DataFrame:
    """(lead, full, high, low) of the suffixes of classes that fit into a bucket."""

    def run(batches):
        def settle(rows):
            table = pa.Table.from_batches(rows)
            lead = table["lead"].to_numpy()
            high, low = equal_windows(lead, table["most"].to_numpy().astype(np.int64), table["least"].to_numpy().astype(np.int64),
                                      table["bytes"].to_pylist(), table["n"].to_numpy() == 1)
            got = high >= 0
            return pa.RecordBatch.from_arrays([pa.array(lead[got]), pa.array(table["full"].to_numpy()[got]),
                                               pa.array(high[got].astype(np.int32)), pa.array(low[got].astype(np.int32))],
                                              ["lead", "full", "high", "low"])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= GROUP_ROWS:  # settle what lies before the last class, which may go on in the next batch
                rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                lead = rows.column(0).to_numpy()
                cut = len(lead) - int(np.argmax(lead[::-1] != lead[-1])) if lead[0] != lead[-1] else 0
                if cut:
                    yield settle([rows.slice(0, cut)])
                held, size = [rows.slice(cut)], len(lead) - cut
        if size:
            yield settle(held)

    head = F.substring("bytes", F.col("most") + 1, F.lit(16))
    return (contexts.withColumn("head", head).repartitionByRange("head", "lead").sortWithinPartitions("head", "lead")
            .select("lead", "full", "most", "least", "bytes", "n")
            .mapInArrow(run, "lead long, full long, high int, low int"))


def _settled_by_windows(contexts: DataFrame) -> DataFrame:
    """The same for classes of any size: every window of their suffixes by its hash, counted by Spark."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                whole = np.frombuffer(r["bytes"], np.uint8)
                b = np.arange(r["least"], r["most"] + 1)
                sums = ta.prefix_sums(whole)
                at = r["most"] - b
                hashes = ta.span_hashes(sums, at, at + LENGTH)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(b), r["lead"])), pa.array(np.full(len(b), r["full"])), pa.array(b.astype(np.int32)),
                     pa.array(np.full(len(b), r["n"])), pa.array(hashes.view(np.int64))], ["lead", "full", "b", "n", "window"])

    windows = contexts.select("lead", "full", "most", "least", "bytes", "n").mapInArrow(
        run, "lead long, full long, b int, n long, window long")
    twice = windows.groupBy("window").agg(F.sum("n").alias("all")).where("all > 1").select("window")
    return windows.join(twice, "window", "left_semi").groupBy("lead", "full").agg(
        F.max("b").alias("high"), F.min("b").alias("low"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(key, start, end): intervals whose union is what repeats, for texts in ``_text`` by ``_key``."""
    suffixes = _sampled(docs)
    # written, so that the join deals out both sides itself and can split leading tokens that very many texts share
    often = written(suffixes.groupBy("lead").agg(F.count("*").alias("n")).where("n > 1").select("lead"), "leads")
    shared = written(suffixes.join(often, "lead", "left_semi"), "suffixes")
    kinds = written(shared.groupBy("lead", "full").agg(F.count("*").alias("n")), "kinds")
    classes = kinds.groupBy("lead").agg(F.count("*").alias("kinds")).where("kinds > 1")
    asked = written(kinds.join(classes, "lead"), "asked")
    contexts = written(_contexts(docs, asked), "contexts")
    single = kinds.join(classes, "lead", "left_anti").select("lead", "full")
    answers = written(
        _settled_in_buckets(contexts.where(F.col("kinds") <= LARGE_CLASS)).unionByName(
            _settled_by_windows(contexts.where(F.col("kinds") > LARGE_CLASS))), "answers")
    whole = shared.join(single, ["lead", "full"], "left_semi").select(
        "key", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("end"))
    part = shared.join(answers, ["lead", "full"]).select(
        "key", (F.col("sample") - F.col("high")).alias("start"), (F.col("sample") - F.col("low") + LENGTH).alias("end"))
    return whole.unionByName(part)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_bytes``, ``spans`` (flat starts and ends of the removed runs, bytes), ``kept`` (bytes)."""
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    texts = texts.withColumn("_key", F.xxhash64("_id", "_text"))
    spans = repeated_spans(texts).groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("s"))
    spans = spans.select("key", F.expr("transform(s, x -> x.start)").alias("start"), F.expr("transform(s, x -> x.end)").alias("end"))
    rows = texts.join(spans, F.col("_key") == F.col("key"), "left").select("_id", "_text", "start", "end")

    def run(batches):
        for batch in batches:
            data, at = ta.utf8(batch.column(1))
            start, end = batch.column(2), batch.column(3)
            for low in range(0, batch.num_rows, 500):
                size, flat, kept = [], [], []
                for k in range(low, min(low + 500, batch.num_rows)):
                    own = data[at[k] : at[k + 1]]
                    s, e = (np.array(x[k].as_py() or [], np.int64) for x in (start, end))
                    mark = np.zeros(len(own) + 1, np.int64)
                    np.add.at(mark, s, 1)
                    np.add.at(mark, e, -1)
                    gone = np.cumsum(mark)[:-1] > 0
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                    size.append(len(own))
                    flat.append(edge.astype(np.int32))
                    kept.append(own[~gone].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, len(size)), pa.array(size, pa.int64()), pa.array(flat, pa.list_(pa.int32())),
                     pa.array(kept, pa.binary())], ["_id", "n_bytes", "spans", "kept"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {id_type}, n_bytes long, spans array<int>, kept binary").withColumnRenamed("_id", id_col)


def contract(docs: DataFrame) -> DataFrame:
    """The columns of op2."""
    return deduplicated(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
