"""A modified Kneser-Ney model of symbols whose 5-grams are those of the whole corpus, without a bound: they grow with it.

Symbols are code points in lower case, white space and digits as one symbol each, code points from U+0800 on in 2048 hashed
symbols. Every language has its own model. Orders 5, 4 and 3 back off into each other, then to single symbols.

1. Each task cuts its rows into parts of about ``PART_BYTES`` and sends a part's distinct 5-grams, as sorted arrays with the
   number of documents that hold them, to buckets by the hash of (language, the two symbols before the last). All contexts and
   continuations of these orders meet there.
2. Buckets give the counts of counts, added up to each language's discounts (a few numbers a language).
3. Buckets answer each part: the log probability of each of its 5-grams, in the order in which it sent them.
4. A part's texts, compressed, meet its answers, and each document is scored by look-up in the sorted arrays.

A document is part of the corpus, so each of its 5-grams is judged without the document itself (leave one out): its own
count, and the continuations that only it has, are taken away first. The texts are read in the same partitions each time,
as they are from files; the answers carry a check sum of what they answer, and a mismatch is an error.

Bounds: a task holds one part (or one longer text), or one bucket: the distinct 5-grams of all parts that share the hash of
two symbols and a language.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from varsift.llm import text_arrays as ta
from varsift.llm.storage import written

BITS = 12
LAST = np.uint64((1 << BITS) - 1)
#: Text of a part, and the text of the corpus for which there is a bucket.
PART_BYTES, BUCKET_BYTES = 24 << 20, 24 << 20
BLOB_BYTES = 4 << 20
#: Answers are log probabilities in steps of 1 / SCALE.
SCALE = 2000


# -- 5-grams -----------------------------------------------------------------------------------------------------


def symbols(text: str) -> np.ndarray:
    """The symbols of a text, 1 to 4095 (0 stands before its begin)."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    code[((code >= 9) & (code <= 13)) | (code == 0)] = 0x20
    code[(code >= 0x30) & (code <= 0x39)] = 0x30
    far = code >= 2048
    if far.any():
        code[far] = np.uint64(2048) + (ta.mix(code[far]) & np.uint64(2047))
    return code


def grams(text: str) -> np.ndarray:
    """The 5-gram a b c d e that ends at each symbol, its parts laid out as c d b a e: equal contexts are neighbours."""
    code = symbols(text)
    padded = np.concatenate((np.zeros(4, np.uint64), code))
    n = len(code)
    a, b, c, d = (padded[k : k + n] for k in range(4))
    return c << np.uint64(48) | d << np.uint64(36) | b << np.uint64(24) | a << np.uint64(12) | code


def _counted(keys: list[np.ndarray], counts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their summed counts."""
    all_ = np.concatenate([np.zeros(0, np.uint64), *keys])
    if counts is None:
        return np.unique(all_, return_counts=True)
    order = np.argsort(all_, kind="stable")
    all_, n = all_[order], np.concatenate([np.zeros(0, np.int64), *counts])[order]
    first = np.flatnonzero(np.append(True, all_[1:] != all_[:-1])[: len(all_)])
    return all_[first], np.add.reduceat(n, first) if len(first) else n


def _bucket(keys: np.ndarray, lang: str | None, buckets: int) -> np.ndarray:
    seed = np.array([crc32(repr(lang).encode()) << 24], np.uint64)
    return (ta.mix((keys >> np.uint64(36)) ^ ta.mix(seed)) % np.uint64(buckets)).astype(np.int64)


def _packed(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes(), 3)


def _unpacked(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).reshape(-1)


def _check_sum(keys: np.ndarray) -> int:
    return int(ta.signed(np.bitwise_xor.reduce(ta.mix(keys), keepdims=True))[0]) if len(keys) else 0


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(part, rows, bytes, offsets) of pieces of whole rows; a part ends with the piece that fills it."""
    task, part, have = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        for at, data, offsets in ta.chunks(batch, "text"):
            yield (task << 24) + part, batch.slice(at.start, at.stop - at.start), data, offsets
            have += len(data)
            if have >= PART_BYTES:
                part, have = part + 1, 0


def _texts(data: np.ndarray, at: np.ndarray) -> Iterator[str]:
    whole = data.tobytes()
    return (whole[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True))


def part_grams(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, part, lang, keys, counts): each part's distinct 5-grams of each language, with the number of its documents that
    hold them. ``rows``: id, lang, text."""
    schema = to_arrow_schema(StructType.fromDDL(RECORD))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:

        def ended(part: int, own: dict) -> Iterator[pa.RecordBatch]:
            for lang, found in own.items():
                keys, counts = _counted(*map(list, zip(*found, strict=True)))
                bucket = _bucket(keys, lang, buckets)
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
                out = [(int(bucket[own[0]]), part, lang, _packed(np.diff(keys[own], prepend=np.uint64(0))), _packed(counts[own].astype(np.uint32)))
                       for own in (order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

        now, own = -1, {}
        for part, piece, data, at in _parts(batches):
            if part != now:
                yield from ended(now, own)
                now, own = part, {}
            fresh: dict = {}
            for lang, text in zip(piece.column("lang").to_pylist(), _texts(data, at), strict=True):
                if text:
                    fresh.setdefault(lang, []).append(np.unique(grams(text)))
            for lang, found in fresh.items():
                own.setdefault(lang, []).append(_counted(found))
        yield from ended(now, own)

    return rows.mapInArrow(run, RECORD)


RECORD = "bucket int, part long, lang string, keys binary, counts binary"
ANSWER = "part long, lang string, bucket int, log_p binary, n long, checked long"
BLOB = "part long, blob binary"


# -- the model ---------------------------------------------------------------------------------------------------


def levels(keys: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(n-grams, counts) of orders 5, 4 and 3; the lower ones count the kinds of symbols before (continuations)."""
    out = [(keys, counts)]
    four = (keys >> np.uint64(24)) << np.uint64(12) | keys & LAST
    out.append(np.unique(four, return_counts=True))
    three = (out[1][0] >> np.uint64(24)) << np.uint64(12) | out[1][0] & LAST
    out.append(np.unique(three, return_counts=True))
    return out


def discounts(many: tuple[int, int, int, int]) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and 3 or more, from the numbers of n-grams seen 1 to 4 times."""
    n = np.maximum(many, 1).astype(float)
    y = n[0] / (n[0] + 2 * n[1])
    return np.array([0.0, *(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3))])


def log_probabilities(keys: np.ndarray, counts: np.ndarray, taken: np.ndarray, single: np.ndarray,
                      leave_out: bool = True) -> np.ndarray:
    """Log probability of each 5-gram's last symbol after the others, as a document sees it that holds the 5-gram and is
    itself left out. ``taken``: discounts by order (5, 4, 3); ``single``: probability of each symbol."""
    tables = levels(keys, counts)
    place = [np.arange(len(keys))]
    for upper, lower in ((0, 1), (1, 2)):
        own = tables[upper][0]
        place.append(np.searchsorted(tables[lower][0], (own >> np.uint64(24)) << np.uint64(12) | own & LAST)[place[-1]])
    p = single[(keys & LAST).astype(np.int64)]
    gone = np.full(len(keys), leave_out)
    lost = []
    for (own, n), at in zip(tables, place, strict=True):  # what the document alone has, from the highest order down
        lost.append(gone)
        gone = gone & (n[at] == 1)
    for (own, n), at, out, d in reversed(list(zip(tables, place, lost, taken, strict=True))):
        context = own >> np.uint64(12)
        first = np.flatnonzero(np.append(True, context[1:] != context[:-1])[: len(context)])
        size = np.diff(np.append(first, len(context)))
        part = d[np.minimum(n, 3)]
        total = np.add.reduceat(n, first).repeat(size)[at] - out
        kept = n[at] - out
        left = np.add.reduceat(part, first).repeat(size)[at] - part[at] + d[np.minimum(kept, 3)]
        seen = total > 0
        whole = np.maximum(total, 1)
        p = np.where(seen, (kept - d[np.minimum(kept, 3)]) / whole + left / whole * p, p)
    return np.log(p)


def _merged(table: pa.Table) -> Iterator[tuple]:
    """(lang, its records, their keys, merged keys, merged counts) of a bucket."""
    rows = table.to_pylist()
    for lang in sorted({r["lang"] for r in rows}, key=repr):
        own = [r for r in rows if r["lang"] == lang]
        keys = [np.cumsum(_unpacked(r["keys"], np.uint64), dtype=np.uint64) for r in own]
        yield lang, own, keys, *_counted(keys, [_unpacked(r["counts"], np.uint32).astype(np.int64) for r in own])


def fitted(records: DataFrame) -> dict:
    """By language: the discounts of each order and the probability of each single symbol, over the whole corpus."""

    def run(table: pa.Table) -> pa.Table:
        lang_, kind, key, n = [], [], [], []
        for lang, _, _, keys, counts in _merged(table):
            tables = levels(keys, counts)
            found = [np.bincount(np.minimum(c, 5), minlength=6)[1:5] for _, c in tables]
            symbol, many = np.unique(tables[2][0] & LAST, return_counts=True)
            for k, x in [*((k, x) for k, x in enumerate(found)), (3, many)]:
                lang_ += [lang] * len(x)
                kind += [k] * len(x)
                key += symbol.tolist() if k == 3 else [1, 2, 3, 4]
                n += x.tolist()
        return pa.table([pa.array(lang_, pa.string()), pa.array(kind, pa.int32()), pa.array(key, pa.int32()), pa.array(n, pa.int64())],
                        names=["lang", "kind", "key", "n"])

    found = records.groupBy("bucket").applyInArrow(run, "lang string, kind int, key int, n long")
    out: dict = {}
    for r in found.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")).collect():
        own = out.setdefault(r.lang, (np.zeros((3, 4), np.int64), np.zeros(1 << BITS)))
        if r.kind == 3:
            own[1][r.key] = r.n
        else:
            own[0][r.kind, r.key - 1] = r.n
    return {lang: (np.array([discounts(tuple(x)) for x in many]), (single + 0.5) / (single + 0.5).sum()) for lang, (many, single) in out.items()}


def answers(records: DataFrame, model: dict) -> DataFrame:
    """Log probabilities of each record's 5-grams, in its order."""
    schema = to_arrow_schema(StructType.fromDDL(ANSWER))

    def run(table: pa.Table) -> pa.Table:
        out = []
        for lang, own, keys, merged, counts in _merged(table):
            log_p = np.minimum(-log_probabilities(merged, counts, *model[lang]) * SCALE + 0.5, 65535).astype(np.uint16)
            out += [(r["part"], lang, r["bucket"], _packed(log_p[np.searchsorted(merged, k)]), len(k), _check_sum(k)) for r, k in zip(own, keys, strict=True)]
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return records.groupBy("bucket").applyInArrow(run, ANSWER)


def blobs(rows: DataFrame) -> DataFrame:
    """The rows of each part, compressed."""
    schema = to_arrow_schema(StructType.fromDDL(BLOB))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:

        def sent(part: int, pieces: list) -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pieces[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(pa.Table.from_batches(pieces).combine_chunks())
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], schema=schema)

        now, pieces, have = -1, [], 0
        for part, piece, data, _ in _parts(batches):
            if pieces and (part != now or have >= BLOB_BYTES):
                yield sent(now, pieces)
                pieces, have = [], 0
            now = part
            pieces.append(piece)
            have += len(data)
        if pieces:
            yield sent(now, pieces)

    return rows.mapInArrow(run, BLOB)


def looked_up(keys: np.ndarray, value: np.ndarray, texts: list[np.ndarray]) -> list[np.ndarray]:
    """The values of each text's 5-grams. The distinct 5-grams of all texts are looked up, in order, and not every symbol's."""
    own, where = np.unique(np.concatenate(texts), return_inverse=True)
    return np.split(value[np.searchsorted(keys, own)][where], np.cumsum([len(g) for g in texts])[:-1])


def scored(rows: DataFrame, fields: str, scorer: Callable[[], Callable[[np.ndarray, np.ndarray, pa.RecordBatch], list]]) -> DataFrame:
    """Of ``rows`` (id, lang, text, other columns): all but the text, ``fields`` (DDL) as the scorer gives them for the bytes and
    offsets of a few texts and their rows, then ``n_grams``, ``symbol_log_perplexity`` (null for an empty text) and ``symbol_deviation``."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + size // BUCKET_BYTES
    records = written(part_grams(rows, buckets), "grams")  # read twice; a few hundredths of the texts
    model = fitted(records)
    others = [c for c in rows.columns if c != "text"]
    schema = StructType([*(rows.schema[c] for c in others),
                         *StructType.fromDDL(f"{fields}, n_grams long, symbol_log_perplexity double, symbol_deviation double").fields])
    arrow = to_arrow_schema(schema)

    def run(answered: pa.Table, sent: pa.Table) -> pa.Table:
        score = scorer()
        tables: dict = {}
        told: dict = {}
        for r in answered.to_pylist():
            told.setdefault(r["lang"], {})[r["bucket"]] = r
        texts = [pa.ipc.open_stream(b).read_all() for b in sent.column("blob").to_pylist()]
        pieces = [(batch.slice(at.start, at.stop - at.start), data, offsets) for t in texts for batch in t.to_batches()
                  for at, data, offsets in ta.chunks(batch, "text")]
        seen: dict = {}
        for piece, data, at in pieces:
            fresh: dict = {}
            for lang, text in zip(piece.column("lang").to_pylist(), _texts(data, at), strict=True):
                if text:
                    fresh.setdefault(lang, []).append(grams(text))
            for lang, found in fresh.items():
                seen.setdefault(lang, []).append(np.unique(np.concatenate(found)))
        for lang, found in seen.items():
            keys = np.unique(np.concatenate(found))
            value = np.zeros(len(keys))
            bucket = _bucket(keys, lang, buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
            for own in (order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)):
                r = told.get(lang, {}).get(int(bucket[own[0]]))
                if r is None or r["n"] != len(own) or r["checked"] != _check_sum(keys[own]):
                    raise ValueError("the texts came in other partitions when they were read again: write them to files first")
                value[own] = _unpacked(r["log_p"], np.uint16) / -SCALE
            tables[lang] = keys, value
        out = []
        for piece, data, at in pieces:
            stats: list = [(0, None, 0.0)] * len(piece)
            same: dict = {}
            for k, (lang, text) in enumerate(zip(piece.column("lang").to_pylist(), _texts(data, at), strict=True)):
                if text:
                    same.setdefault(lang, []).append((k, grams(text)))
            for lang, found in same.items():
                for (k, _), p in zip(found, looked_up(*tables[lang], [g for _, g in found]), strict=True):
                    stats[k] = len(p), -p.mean(), p.std()
            columns = [*(piece.column(c) for c in others), *score(data, at, piece), *zip(*stats, strict=True)]
            out.append(pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(columns, arrow, strict=True)], schema=arrow))
        return pa.Table.from_batches(out, arrow)

    return answers(records, model).groupBy("part").cogroup(blobs(rows).groupBy("part")).applyInArrow(run, schema)
