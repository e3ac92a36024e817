"""Byte-level BPE with the tokenizers library over Arrow batches.

A rank file becomes a library BPE model over byte characters. Each batch is
cut into pre-tokens, every distinct pre-token of a slice is merged once by the
library, and ids are laid out with array operations. Tokens are byte spans;
their character offsets come from the byte-to-character positions, so a token
that ends inside a character covers that character. Decoding maps ids back to
bytes, joins them and only then reads characters, so split ones are whole
again.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import models

from tabstrata.llm import pretokens, textarrays

#: Distinct pre-tokens (by 64-bit hash) that a task remembers before it starts anew.
REMEMBERED = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def library_model(ranks: dict[bytes, int]) -> models.BPE:
    """The library's BPE over byte characters with the ranks' merges: every pair of tokens that makes a token, lowest result first."""
    name = {token: pretokens.as_characters(token) for token in ranks}
    merges = []
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            a, b = ranks.get(token[:k]), ranks.get(token[k:])
            if a is not None and b is not None:
                merges.append((rank, a, b, name[token[:k]], name[token[k:]]))
    merges.sort()
    return models.BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=[(a, b) for *_, a, b in merges], ignore_merges=True)


class PieceTable:
    """Ids of the distinct pre-tokens met so far, each merged once by the library."""

    def __init__(self, model: models.Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.slot: dict[int, int] = {}
        self.size, self.first, self.ids = (np.zeros(0, t) for t in (np.int64, np.int64, np.int32))

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces back to back and the number of ids of each."""
        ids = [[t.id for t in self.model.tokenize(pretokens.as_characters(p))] for p in pieces]
        return np.array([i for x in ids for i in x], np.int32), np.array([len(x) for x in ids], np.int64)

    def slots(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of every distinct piece, and which of them each piece is."""
        keys, one, which = np.unique(textarrays.hash_spans(data, start, end), return_index=True, return_inverse=True)
        if len(self.slot) + len(keys) > REMEMBERED:
            self.clear()
        slots = np.fromiter((self.slot.get(k, -1) for k in keys.tolist()), np.int64, len(keys))
        new = np.flatnonzero(slots < 0)
        if new.size:
            raw = data.tobytes()
            ids, size = self.merged([raw[start[i] : end[i]] for i in one[new]])
            slots[new] = len(self.slot) + np.arange(new.size)
            self.slot.update(zip(keys[new].tolist(), slots[new].tolist()))
            self.first = np.r_[self.first, len(self.ids) + np.cumsum(size) - size]
            self.size, self.ids = np.r_[self.size, size], np.r_[self.ids, ids]
        return slots, which


class Codec:
    """Encoder and decoder of one rank table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.pieces = PieceTable(library_model(ranks))
        size = max(ranks.values()) + 1
        spelled = [b""] * size
        for token, rank in ranks.items():
            spelled[rank] = token
        self.length = np.array([len(t) for t in spelled], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts back to back and the n + 1 token offsets of the texts."""
        start, end, at = pretokens.pretokens(data, offsets)
        if not start.size:
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        slots, which = self.pieces.slots(data, start, end)
        n = self.pieces.size[slots][which]
        ids = self.pieces.ids[pretokens.ragged(self.pieces.first[slots][which], n)]
        return ids, np.r_[0, np.cumsum(n)][at]

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, back to back."""
        return self.bytes[pretokens.ragged(self.first[ids], self.length[ids])]

    def spans(self, data: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and one-past-last character of every token in the slice; a split character belongs to all its tokens."""
        end = np.cumsum(self.length[ids])
        before = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]  # characters begun before each byte
        start = end - self.length[ids]
        inside = (data[np.minimum(start, max(0, data.size - 1))] & 0xC0) == 0x80
        return before[start] - inside, before[end]


@lru_cache(4)
def codec(path: str) -> Codec:
    return Codec(read_ranks(path))


def _encode(path: str, with_offsets: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            for part, data, offsets in textarrays.slices(batch, "_text"):
                ids, at = coder.encode(data, offsets)
                cols = [part.column("row"), pa.ListArray.from_arrays(at.astype(np.int32), pa.array(ids, pa.int32()))]
                if with_offsets:
                    first, last = coder.spans(data, ids)
                    texts = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][offsets[:-1]]
                    base = np.repeat(texts, np.diff(at))
                    cols += [pa.ListArray.from_arrays(at.astype(np.int32), pa.array((x - base).astype(np.int32))) for x in (first, last)]
                yield pa.RecordBatch.from_arrays(cols, names=["row", "ids", "char_start", "char_end"][: len(cols)])
        coder.pieces.clear()  # an idle worker holds no table

    return rows


def encode(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, with_offsets: bool = True) -> DataFrame:
    """row (struct of the ``keep`` columns, all by default), ids and, with offsets, the characters of each token.

    Null and empty texts have no ids; repeated rows stay apart; columns of any
    name may be present.
    """
    rows = df.select(F.struct(*(keep if keep is not None else df.columns)).alias("row"), F.col(text).alias("_text"))
    kind = rows.schema["row"].dataType.simpleString()
    more = ", char_start array<int>, char_end array<int>" if with_offsets else ""
    return rows.mapInArrow(_encode(path, with_offsets), f"row {kind}, ids array<int>{more}")


def _numerals(coder: Codec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids as decimals with a comma, back to back, and each one's first character and length."""
    name = [b"%d," % i for i in range(len(coder.length))]
    long = np.array([len(x) for x in name], np.int64)
    return np.frombuffer(b"".join(name), np.uint8), np.cumsum(long) - long, long


def _decode(path: str, digests: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        digits, first, long = _numerals(coder)
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                batch = whole.slice(lo, 512)
                column = batch.column("ids")
                n, texts, listed = [], [], []
                for k in range(batch.num_rows):
                    ids = column[k].values.to_numpy() if column[k].is_valid else np.zeros(0, np.int32)
                    raw = coder.spelled(ids).tobytes()
                    n.append(len(ids))
                    texts.append(hashlib.sha256(raw).hexdigest() if digests else raw.decode(errors="replace"))
                    if digests:
                        listed.append(hashlib.sha256(digits[pretokens.ragged(first[ids], long[ids])].tobytes()[:-1]).hexdigest())
                cols = [batch.column("row"), pa.array(n, pa.int64())]
                cols += [pa.array(listed), pa.array(texts)] if digests else [pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=["row", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["decoded"])])

    return rows


def decode(encoded: DataFrame, path: str, digests: bool = False) -> DataFrame:
    """row, n_tokens and the decoded text, or with ``digests`` the SHA-256 of the ids and of the decoded bytes.

    Ids that don't make whole characters decode to replacement characters.
    """
    kind = encoded.schema["row"].dataType.simpleString()
    out = "ids_sha256 string, decoded_sha256 string" if digests else "decoded string"
    return encoded.select("row", "ids").mapInArrow(_decode(path, digests), f"row {kind}, n_tokens long, {out}")


def _round_trip(path: str, with_ids: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        digits, first, long = _numerals(coder)
        sha = lambda a: hashlib.sha256(a).hexdigest()
        for batch in batches:
            for part, data, offsets in textarrays.slices(batch, "_text", 1 << 20):
                ids, at = coder.encode(data, offsets)
                begun = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][offsets[:-1]]  # characters before each text
                spans = np.stack(coder.spans(data, ids), 1) - np.repeat(begun, np.diff(at))[:, None]
                texts = [ids[a:b] for a, b in zip(at, at[1:])]
                bytes_back = [coder.spelled(x).tobytes() for x in texts]
                given = textarrays.filled(part.column("_text")).to_pylist()
                cols = [
                    part.column("row"), pa.array(np.diff(at), pa.int64()), pa.array([sha(digits[pretokens.ragged(first[x], long[x])].tobytes()[:-1]) for x in texts], pa.string()), pa.array([sha(x) for x in bytes_back], pa.string()),
                    pa.array([sha(spans[a:b].astype("<i4").tobytes()) for a, b in zip(at, at[1:])], pa.string()), pa.array([x.decode(errors="replace") == t for x, t in zip(bytes_back, given)], pa.bool_()),
                ]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(at.astype(np.int32), pa.array(ids, pa.int32())))
                yield pa.RecordBatch.from_arrays(cols, names=["row", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256", "same_text", "ids"][: len(cols)])
        coder.pieces.clear()
        textarrays.give_back()

    return rows


def round_trip(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, with_ids: bool = False) -> DataFrame:
    """row, n_tokens, ids_sha256, decoded_sha256, spans_sha256, same_text and, if asked for, ids: ``encode`` and ``decode`` of each text in one pass.

    ``spans_sha256`` is of the first and one-past-last character of every token
    (32-bit little-endian, token by token); ``same_text`` tells whether the
    decoded text is the given one (null: empty). The ids are decoded where they
    are made, so a task needs one Python worker and no ids travel for the digests.
    """
    rows = df.select(F.struct(*(keep if keep is not None else df.columns)).alias("row"), F.col(text).alias("_text"))
    kind = rows.schema["row"].dataType.simpleString()
    more = ", ids array<int>" if with_ids else ""
    return rows.mapInArrow(_round_trip(path, with_ids), f"row {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string, same_text boolean{more}")


def default_ranks() -> str:
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
