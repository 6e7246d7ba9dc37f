"""Helpers shared by the training-data operators: words, hashes and bounded batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Words are maximal runs of anything but these bytes (space, tab, LF, VT, FF, CR); fixed values.
SPACE_BYTES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE_BYTES)] = True


_kept: dict[str, object] = {}


def fresh_key() -> str:
    return uuid.uuid4().hex


def once(key: str, make: Callable[[], object]):
    """What ``make`` gives, built once per worker process; the last two are kept."""
    if key not in _kept:
        while len(_kept) > 1:
            _kept.pop(next(iter(_kept)))
        _kept[key] = make()
    return _kept[key]


def bound_batches(spark: SparkSession, rows: int = 1000, size: str = "4m") -> None:
    """Keep Arrow batches small, so that a worker's memory does not depend on how long texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def text_bytes(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The named columns and the text as UTF-8 bytes in ``body`` (null texts stay null)."""
    return docs.select(*keep, F.col(text).cast("binary").alias("body"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, which: str = "base") -> np.ndarray:
    """1, B, B^2 ... modulo 2^64 (or the inverse powers), grown as needed."""
    have = _powers.get(which)
    if have is None or len(have) < n:
        one = BASE if which == "base" else INVERSE
        have = np.full(max(n, 1 << 16), one, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[which] = have
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of (byte + 1) * B^position over [i, j), modulo 2^64."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-independent 64-bit hashes of the byte spans [start, end)."""
    raw = (prefix[end] - prefix[start]) * powers(len(prefix), "inverse")[start]
    return mix64(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def body_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column and the offsets of its rows (nulls are empty)."""
    if column.null_count:
        column = column.fill_null(b"")
    if pa.types.is_large_binary(column.type):
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    else:
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int32).astype(np.int64)
    offsets = offsets[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "body", limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``limit`` bytes of text, one row at least."""
    _, offsets = body_parts(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words (A-Z lower-cased), in order; their count per row; first word of each row."""
    n = len(data)
    if n == 0:
        zero = np.zeros(len(offsets) - 1, dtype=np.int64)
        return np.zeros(0, dtype=np.uint64), zero, zero
    solid = ~_IS_SPACE[data]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = solid[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    before[edges] = False
    start = np.flatnonzero(solid & ~before)
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    after[ends] = False
    end = np.flatnonzero(solid & ~after) + 1
    hashes = span_hash(prefix_hash(_LOWER[data]), start, end)
    first = np.searchsorted(start, offsets)
    return hashes, np.diff(first), first[:-1]


def word_id(word: str) -> int:
    """The hash ``words`` gives to one word, as a signed 64-bit number."""
    data = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(words(data, np.array([0, len(data)]))[0].view(np.int64)[0])


def lower_ascii(body: bytes) -> bytes:
    return body.lower()  # bytes.lower touches A-Z alone


def null_free(column: pa.Array, value: int = 0) -> np.ndarray:
    return column.fill_null(value).to_numpy(zero_copy_only=False)
