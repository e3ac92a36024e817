"""NumPy views of Arrow text columns, for use inside tasks.

Every function works on one bounded slice of a batch (``slices``): the UTF-8
bytes of its texts back to back and the offsets of each text. Nulls count as
empty texts. A single text longer than the bound is a slice of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_MUL = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_PLAIN = np.ones(256, bool)
_PLAIN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = False


def give_back() -> None:
    """Return a task's freed memory to the system: Spark keeps its Python workers, and an idle one would hold it through the next stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library may have none
    if trim is not None:
        trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def filled(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one large-string array, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets of the texts in them."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of rows with at most ``max_bytes`` of text; gives (rows, bytes, offsets)."""
    column = filled(batch.column(text))
    offsets = buffer(column)[1]
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1)
        yield batch.slice(at, to - at), *buffer(column.slice(at, to - at))
        at = to


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word (run of bytes other than space, 09 to 0D), and the n + 1 word offsets of the texts."""
    inside = ~_SPACE[data]
    cut = np.zeros(data.size + 1, bool)
    cut[offsets] = True
    before = np.zeros(data.size, bool)
    before[1:] = inside[:-1]
    after = np.zeros(data.size, bool)
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | cut[:-1]))
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return start, end, np.searchsorted(start, offsets)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``words``, without ASCII punctuation at the ends of words that have anything else."""
    start, end, at = words(data, offsets)
    plain = _PLAIN[data]
    place = np.flatnonzero(plain)
    if not start.size or not place.size:
        return start, end, at
    mark = np.r_[0, np.cumsum(plain)]
    some = mark[end] > mark[start]
    first = np.where(some, place[np.minimum(mark[start], len(place) - 1)], start)
    return first, np.where(some, place[np.maximum(mark[end] - 1, 0)] + 1, end), at


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span (spans must not be empty)."""
    if not start.size:
        return np.zeros(0, np.uint64)
    size = end - start
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(first, size)
    power = np.cumprod(np.full(int(size.max()), _MUL), dtype=np.uint64)
    value = (data[np.repeat(start, size) + at].astype(np.uint64) + np.uint64(1)) * power[at]
    return mix(np.add.reduceat(value, first) + size.astype(np.uint64) * _MUL)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z lower-cased if ``lower``) and the word offsets of the texts."""
    start, end, at = words(data, offsets)
    return hash_spans(LOWER[data] if lower else data, start, end), at


def chain(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n neighbouring hashes."""
    out = np.zeros(max(0, h.size - n + 1), np.uint64)
    for k in range(n):
        out = mix(out * _MUL + h[k : k + out.size])
    return out


def shingles(h: np.ndarray, at: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text index and first word of every n-word shingle; a text of 1 to n - 1 words is one shingle."""
    count = np.diff(at)
    every, doc = chain(h, n), np.repeat(np.arange(count.size), count)
    whole = np.flatnonzero(doc[: every.size] == doc[n - 1 :]) if every.size else np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < n))
    if not short.size:
        return every[whole], doc[whole], whole
    extra = np.array([chain(h[at[d] : at[d + 1]], int(count[d]))[0] for d in short], np.uint64) ^ _MUL
    first = np.concatenate([whole, at[short]])
    order = np.argsort(first, kind="stable")
    return np.concatenate([every[whole], extra])[order], doc[first[order]], first[order]


def pack(a: np.ndarray) -> bytes:
    """Integers as byte planes, as many as the largest needs, led by their number."""
    a = a.astype("<u8")
    width = max(1, (int(a.max()).bit_length() + 7) // 8) if a.size else 1
    return bytes([width]) + np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8).T[:width]).tobytes()


def unpack(b: bytes) -> np.ndarray:
    width = b[0]
    planes = np.frombuffer(b, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").reshape(-1)


def pack_sorted(a: np.ndarray) -> bytes:
    """Ascending integers as differences in byte planes."""
    a = a.astype(np.uint64)
    return pack(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b), dtype=np.uint64)
