"""Array helpers for text columns inside Arrow tasks: byte chunks, word spans, word and shingle hashes.

A task receives Arrow batches; ``chunks`` cuts each into pieces of half a megabyte (always whole rows), so a
task's arrays are bounded by that or by its longest single text. Words are runs of bytes of a 256-entry class
table: every separator used here is ASCII, so byte runs and code point runs are the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: dict[int, np.ndarray] = {}

#: Words of the contracts: everything but space and \x09-\x0D; or ASCII digits, letters and all of non-ASCII.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and each text's offsets (n + 1); a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def chunks(batch: pa.RecordBatch, text: str = "text",
           size: int = CHUNK_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) pieces of whole rows, each of at most ``size`` bytes or one row."""
    data, at = utf8(batch.column(batch.schema.get_field_index(text)))
    row = 0
    while row < len(at) - 1:
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
        yield slice(row, end), data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    """base**0 .. base**(n-1), kept for the task."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1024)
        have = np.full(size, base, U)
        have[0] = 1
        _POWERS[int(base)] = have = np.multiply.accumulate(have)
    return have[:n]


def forget_powers() -> None:
    """Drop the kept powers, after an input that was much longer than a chunk."""
    _POWERS.clear()


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums (n + 1), from which any substring's hash follows."""
    out = np.zeros(len(data) + 1, U)
    np.cumsum(_BYTE[data] * _powers(len(data), _BASE), out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the substrings [start, end)."""
    turn = _powers(len(sums), _INVERSE)[start]
    return mix((sums[end] - sums[start]) * turn + (end - start).astype(U))


def word_spans(data: np.ndarray, at: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; words never cross rows."""
    is_word = member[data]
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = is_word[1:] != is_word[:-1]
    edge[at] = True
    bounds = np.flatnonzero(edge)
    keep = is_word[bounds[:-1]]
    start, end = bounds[:-1][keep], bounds[1:][keep]
    return start, end, np.searchsorted(at, start, "right") - 1


def code_points(data: np.ndarray) -> np.ndarray:
    """Running count (n + 1) of code points."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k consecutive word hashes (len - k + 1; rows are not regarded)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    out, factor = np.zeros(n, U), 1
    for j in range(k):
        out += words[j : j + n] * U(factor)
        factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
    return mix(out + U(k))


def counts_by_row(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n).astype(np.int64)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def crc_fold(doc_id: np.ndarray) -> np.ndarray:
    """crc32 of the id as text, modulo 5 (fold 0 is held out)."""
    from zlib import crc32

    return np.array([crc32(str(x).encode()) % 5 for x in doc_id])
