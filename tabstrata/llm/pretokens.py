"""Pre-tokens of byte-level BPE: the published split pattern, evaluated on whole slices of text with NumPy.

The pattern's pieces are a contraction, an optional space and a run of
letters, of numbers or of other signs, or white space; of white space before
another piece the last character stands alone, or joins that piece if it is a
plain space. Character classes are read from the tokenizers library itself.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import tokenizers
from tokenizers import normalizers

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_OTHER, _LETTER, _NUMBER, _WHITE, _NONE = range(5)


@lru_cache(1)
def classes() -> np.ndarray:
    """Class of every code point as the tokenizers library sees it."""
    points = np.r_[0:0xD800, 0xE000:0x110000]
    text = points.astype("<u4").tobytes().decode("utf-32-le")
    out = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_WHITE, r"\s+")):
        rest = normalizers.Replace(tokenizers.Regex(pattern), "").normalize_str(text)
        hit = np.ones(0x110000, bool)
        hit[np.frombuffer(rest.encode("utf-32-le"), "<u4")] = False
        hit[0xD800:0xE000] = False
        out[hit] = kind
    return out


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the n + 1 byte offsets of the characters."""
    point = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
    size = 1 + (point >= 0x80).astype(np.int64) + (point >= 0x800) + (point >= 0x10000)
    return point, np.r_[0, np.cumsum(size)]


def pretokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every piece, and the n + 1 piece offsets of the texts."""
    point, byte = characters(data)
    n = point.size
    texts = np.searchsorted(byte, offsets)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    cut = np.zeros(n + 1, bool)
    cut[texts] = True
    kind = classes()[point]
    new = cut[:n].copy()
    new[1:] |= kind[1:] != kind[:-1]
    # white space before something else in the same text gives its last character away
    last = (kind == _WHITE) & np.r_[new[1:], True] & ~cut[1:]
    joins = np.flatnonzero(last & (point == 32)) + 1
    new |= last
    new[joins] = False
    # contractions, where an apostrophe begins a piece
    mark = np.flatnonzero(new & (point == ord("'")))
    if mark.size:
        ahead = np.full((2, mark.size), 0, np.uint32)
        for k in (1, 2):
            at = np.minimum(mark + k, n - 1)
            inside = (mark + k < n) & ~cut[np.minimum(mark + k, n)] & ((k == 1) | ~cut[mark + 1])
            ahead[k - 1] = np.where(inside, point[at], 0)
        one = np.isin(ahead[0], [ord(c) for c in "stmd"])
        two = np.zeros(mark.size, bool)
        for pair in ("re", "ve", "ll"):
            two |= (ahead[0] == ord(pair[0])) & (ahead[1] == ord(pair[1]))
        hit = one | two
        new[mark[hit] + 1] = False
        end = mark[hit] + np.where(one[hit], 2, 3)
        new[end[end < n]] = True
    start = np.flatnonzero(new)
    return byte[start], byte[np.r_[start[1:], n]], np.searchsorted(start, texts)


def ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions first[i], first[i] + 1, ... of ``size[i]`` each, back to back."""
    size = size.astype(np.int64)
    if not size.size:
        return np.zeros(0, np.int64)
    return np.arange(int(size.sum()), dtype=np.int64) + np.repeat(first - (np.cumsum(size) - size), size)


@lru_cache(1)
def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it prints, else the next free one from 256."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(prints))
    table = {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return [table[b] for b in range(256)]


def as_characters(piece: bytes) -> str:
    return piece.decode("latin-1").translate(byte_characters())
