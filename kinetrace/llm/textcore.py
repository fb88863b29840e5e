"""Byte-level text kernels shared by the operators of this package.

Arrow hands a batch of strings over as one UTF-8 buffer with offsets, so words
of thousands of documents are found and hashed with a few vector operations
instead of a Python loop over words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession

from kinetrace.workers import reachable

#: Odd multiplier of the polynomial word hash, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of text that one vector step works on; bounds the temporary arrays.
SLICE_BYTES = 2 << 20
#: Bytes of an Arrow batch between the JVM and a worker; both sides hold a few.
BATCH_BYTES = 8 << 20

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def bounded(spark: SparkSession) -> None:
    """Lowers the session's limit on the bytes of an Arrow batch, and lets workers find this package."""
    reachable(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and plain path of a URI or local path, as workers open it."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), "/" + path[5:].lstrip("/") if path.startswith("file:") else path


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    valid, offsets, data = column.buffers()
    wide = pa.types.is_large_string(column.type)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    if valid is not None and column.null_count and np.diff(at)[column.is_null().to_numpy(zero_copy_only=False)].any():
        return utf8(column.fill_null(""))  # bytes below a null
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``size`` bytes; a longer row is a run by itself."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A copy with A-Z in lower case; other bytes stay."""
    out = data.copy()
    out[(data >= 0x41) & (data <= 0x5A)] += 0x20
    return out


def byte_table(is_word) -> np.ndarray:
    """A table of 256 flags from a predicate on byte values."""
    return np.array([bool(is_word(b)) for b in range(256)])


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of all maximal runs of word bytes, and how many words each row has.

    A run ends with its row.
    """
    n = len(data)
    counts = np.zeros(len(offsets) - 1, np.int64)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), counts
    inside = table[data]
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    edge = offsets[:-1][offsets[:-1] < n]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def salt(i: int) -> np.uint64:
    """The i-th of a fixed run of 64-bit constants."""
    return np.uint64(0xA0761D6478BD642F * i & 0xFFFFFFFFFFFFFFFF)


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers))
        for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
            grown = np.full(size, base, np.uint64)
            grown[0] = 1
            globals()[name] = np.multiply.accumulate(grown)


class RangeHash:
    """64-bit hashes of byte ranges of one buffer; equal bytes have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        _grow(n + 1)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[:n], out=self.total[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.total[ends] - self.total[starts]) * _inverses[starts])


#: Words of more bytes than this are hashed one by one.
_LONG = 256


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words: eight bytes after the other are mixed in, so no pair of texts collides by design of a polynomial.

    Equal bytes have equal hashes wherever they stand.
    """
    n = len(starts)
    sizes = ends - starts
    out = mix(sizes.astype(np.uint64) * np.uint64(_BASE))
    if not n:
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each position on
    at = np.flatnonzero(sizes <= _LONG)
    lane = 0
    while len(at):
        left = sizes[at] - 8 * lane
        more = left > 0
        at, left = at[more], left[more]
        if not len(at):
            break
        value = lanes[starts[at] + 8 * lane]
        short = left < 8
        value[short] &= (np.uint64(1) << (8 * left[short]).astype(np.uint64)) - np.uint64(1)
        out[at] = mix((out[at] ^ value) * np.uint64(_BASE) + salt(lane + 1))
        lane += 1
    for i in np.flatnonzero(sizes > _LONG).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def hashed_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, size: int = 1 << 19) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """:func:`words` and their :func:`hashes`, worked out in slices of ``size`` bytes."""
    starts, ends, counts, codes = [], [], [], []
    for i, j in slices(offsets, size):
        part = data[offsets[i] : offsets[j]]
        s, e, c = words(part, offsets[i : j + 1] - offsets[i], table)
        codes.append(hashes(part, s, e))
        starts.append(s + offsets[i])
        ends.append(e + offsets[i])
        counts.append(c)
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return join(starts, np.int64), join(ends, np.int64), join(counts, np.int64), join(codes, np.uint64)


def shingles(word_hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words inside each row, and the row of each.

    A row of fewer, but not none, is one shingle of all its words.
    """
    n = len(word_hashes)
    rows = np.repeat(np.arange(len(counts)), counts)
    if n == 0:
        return np.zeros(0, np.uint64), rows
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    left = np.repeat(first + counts, counts) - np.arange(n)  # words from here to the row's end
    total = np.zeros(n, np.uint64)
    multiplier = np.uint64(_BASE)
    for j in range(k):
        shifted = np.zeros(n, np.uint64)
        shifted[: max(0, n - j)] = word_hashes[j:]
        total = total * multiplier + np.where(left > j, shifted, np.uint64(j + 1))
    starts = (left >= k) | (np.arange(n) == np.repeat(first, counts))
    return mix(total[starts]), rows[starts]


def trimmed(run):
    """A partition function that gives freed memory back to the system after each batch: workers serve many tasks."""

    def wrapped(batches):
        try:
            for batch in run(batches):
                yield batch
                del batch
                release()
        finally:
            release()

    return wrapped


def release() -> None:
    """Returns memory that Arrow's pool and the C library keep for later."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library, which trims by its own rules
