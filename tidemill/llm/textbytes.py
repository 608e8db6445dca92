"""Whole texts as numpy byte arrays, straight from Arrow buffers.

The operators of this subpackage read documents in ``mapInArrow``.  A batch's texts already lie in one buffer; words,
lines and hashes are found for all of them at once, without a Python object for a text.  Slices bound the memory by
bytes and not by rows; only a single text longer than the bound makes a slice larger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the n + 1 offsets into them; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    if data is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES, rows: int = 1 << 16) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes and ``rows`` rows, at least one row each."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), low + rows, n)
        yield low, high
        low = high


def text_slices(batch: pa.RecordBatch, name: str = "text", limit: int = SLICE_BYTES):
    """(rows of the batch, bytes, offsets) for each slice of a batch."""
    data, offsets = text_bytes(batch.column(name))
    for low, high in slices(offsets, limit):
        own = offsets[low : high + 1]
        yield batch.slice(low, high - low), data[own[0] : own[-1]], own - own[0]
    give_back()


def give_back() -> None:
    """Return freed memory to the system, so that idle workers do not hold it; without glibc nothing happens."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def byte_table(pattern: str) -> np.ndarray:
    """True for the bytes listed as ``a-z`` ranges and single characters, and for ``\\x80-\\xff`` if the list ends in ``+``."""
    table = np.zeros(256, bool)
    high = pattern.endswith("+")
    for part in pattern.removesuffix("+").split():
        first, last = (part[0], part[-1]) if len(part) == 3 and part[1] == "-" else (part, part)
        table[ord(first) : ord(last) + 1] = True
    if high:
        table[128:] = True
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Digits, ASCII letters and every byte of a longer character.
WORD = byte_table("0-9 a-z A-Z +")


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut where texts meet."""
    if not len(mask):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    full = offsets[1:] > offsets[:-1]
    before = np.empty(len(mask), bool)
    before[1:] = mask[:-1]
    before[offsets[:-1][full]] = False
    after = np.empty(len(mask), bool)
    after[:-1] = mask[1:]
    after[offsets[1:][full] - 1] = False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


def owner(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The text in which each byte position lies."""
    return np.searchsorted(offsets, positions, "right") - 1


LETTERS = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, kept for later slices."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(19, (n - 1).bit_length() if n > 1 else 1)
        inverse = pow(_ODD, -1, 1 << 64)
        tables = []
        with np.errstate(over="ignore"):
            for base in (_ODD, inverse):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                tables.append(np.cumprod(steps))
        _powers[:] = tables
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class SpanHashes:
    """64-bit hashes of any spans of one byte array, equal for equal bytes wherever they stand."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        table = LETTERS[LOWER] if lower else LETTERS
        n = len(data)
        self.inverse = _power_tables(n + 1)[1]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(table[data] * _power_tables(n + 1)[0][:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(_ODD))


def span_hash(text: bytes) -> int:
    """The hash that SpanHashes gives to this whole byte string."""
    raw = sum(int(LETTERS[b]) * pow(_ODD, k, 1 << 64) for k, b in enumerate(text)) + len(text) * _ODD
    return int(mix(np.array([raw & _MASK], np.uint64))[0])


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of ``width`` neighbours at each start that has so many."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * np.uint64(_ODD) + hashes[k : k + n]
    return mix(total)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """Starts, ends, hashes and text numbers of all words, and the first word of each text (n + 1 numbers)."""
    starts, ends = runs(WORD[data], offsets)
    hashes = SpanHashes(data, lower).of(starts, ends)
    firsts = np.searchsorted(starts, offsets)
    return starts, ends, hashes, firsts


def repeat_index(firsts: np.ndarray) -> np.ndarray:
    """The text number of each word, from the first words."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))


def code_points(data: np.ndarray) -> np.ndarray:
    """How many characters begin before each byte position (n + 1 numbers)."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    return total
