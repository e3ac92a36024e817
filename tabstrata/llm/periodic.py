"""Periodic runs of words: stretches that repeat a block of words over and over.

Every text is treated on its own, so nothing is shuffled. Runs come from Lyndon
words: a run's root that is a Lyndon word under one of the two orders of the
words is the longest Lyndon word that begins there, so the Lyndon arrays under
both orders name every run. They are read off directly from the first phase of
Baier's suffix sorter (``lyndon_ends``), which groups suffixes by their longest
Lyndon prefix and never sorts the suffixes themselves. Each array entry whose
block is repeated at once is extended to both sides through longest common
extensions.

In a run of exponent e every word occurs e times or more. So the words that are
rarer than that within their stretch are cut out first, again and again until
none is left (``stretches``); no run crosses such a word, and what is left holds
every run whole. On prose nearly nothing is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstrata.llm import textarrays

_BASE = np.uint64(0x9E3779B97F4A7C15)
RUN = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def lyndon_ends(order: list[int]) -> list[int]:
    """End of the longest Lyndon word that begins at each place, where ``order`` has the rank of the letter there.

    Phase one of Baier's sorter: places are grouped by the Lyndon word known to
    begin there, groups are taken from the highest down. A place of the group
    taken is done: its word ends where the next place begins that is not done.
    The nearest place before it that is not done takes its word over, as often
    as it stands there in a row, and moves to a group right above its own.
    """
    n = len(order)
    left, right = [*range(-1, n - 1), n - 1], [*range(1, n + 1), 0]  # the last entries stand for both borders
    ends, group = [0] * n, list(order)
    members: dict[int, list[int]] = {}
    for i, g in enumerate(order):
        members.setdefault(g, []).append(i)
    ranked = sorted(members)
    below = dict(zip(ranked[1:], ranked))
    above = dict(zip(ranked, ranked[1:]))
    fresh, g = ranked[-1] + 1 if ranked else 0, ranked[-1] if ranked else None
    while g is not None:
        times: dict[int, int] = {}
        for i in members.pop(g):
            if group[i] == g:
                before, after = left[i], right[i]
                ends[i] = after
                right[before], left[after] = after, before
                times[before] = times.get(before, 0) + 1
        times.pop(-1, None)
        moved: dict[tuple[int, int], list[int]] = {}
        for i, k in times.items():
            moved.setdefault((k, group[i]), []).append(i)
        top: dict[int, int] = {}  # the highest group made above each old one
        for (_, old), places in sorted(moved.items()) if len(moved) > 1 else moved.items():
            under = top.get(old, old)
            over = above.get(under)
            members[fresh], below[fresh], above[under], top[old] = places, under, fresh, fresh
            if over is not None:
                above[fresh], below[over] = over, fresh
            for i in places:
                group[i] = fresh
            fresh += 1
        g = below.get(g)
    return ends


def stretches(words: np.ndarray, text: np.ndarray, times: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that occur ``times`` or more in their stretch, and the n + 1 offsets of the stretches of ``least`` words or more.

    A stretch is a row of neighbouring such words of one text.
    """
    place, part = np.arange(words.size), text
    while place.size:
        _, which, count = np.unique(textarrays.mix(words[place] + textarrays.mix(part.astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True)
        often = count[which] >= times
        begins = lambda x: np.r_[True, (np.diff(x) != 1) | (np.diff(text[x]) != 0)]
        stay = place[often]
        if stay.size:
            part = np.cumsum(begins(stay))
            long = np.bincount(part)[part] >= least
            stay, part = stay[long], part[long]
        if stay.size == place.size:
            return place, np.r_[np.flatnonzero(begins(place)), place.size]
        place = stay
    return place, np.zeros(1, np.int64)


def _repeated(value: np.ndarray, offsets: np.ndarray, ends: np.ndarray, whole: bool) -> np.ndarray:
    """Places whose Lyndon word can be a run's first root: with ``whole`` those where it stands twice in a row (by a hash; equal blocks are never missed)."""
    place = np.arange(value.size)
    if not whole:
        return place
    last = np.repeat(offsets[1:], np.diff(offsets))
    place = place[2 * ends - place <= last]
    power = np.cumprod(np.r_[np.uint64(1), np.full(value.size, _BASE)], dtype=np.uint64)
    total = np.r_[np.uint64(0), np.cumsum(value * power[:-1], dtype=np.uint64)]
    end = ends[place]
    size = end - place
    return place[(total[end] - total[place]) * power[size] == total[end + size] - total[end]]


def _same(letters: np.ndarray, a: int, b: int, step: int, limit: int) -> int:
    """Length of the longest common extension from places a and b in direction ``step``, ``limit`` at most."""
    done, block = 0, 32
    while done < limit:
        k = min(block, limit - done)
        x, y = (letters[p + done : p + done + k] if step > 0 else letters[p - done - k + 1 : p - done + 1][::-1] for p in (a, b))
        off = np.flatnonzero(x != y)
        if off.size:
            return done + int(off[0])
        done, block = done + k, block * 4
    return done


def find_runs(words: np.ndarray, at: np.ndarray, min_exponent: int = 4, min_words: int = 6) -> list[tuple[int, int, int, int]]:
    """(text, first word, words, period) of every run of at least ``min_exponent`` periods and ``min_words`` words.

    ``words``: a hash of every word, texts back to back; ``at``: their n + 1
    offsets. Periods are the smallest ones; runs are as long as they can be.
    """
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    place, offsets = stretches(words, text, min_exponent, max(min_words, min_exponent))
    if not place.size:
        return []
    values, letters = np.unique(words[place], return_inverse=True)
    found: set[tuple[int, int, int, int]] = set()
    for ranks in (letters, len(values) - 1 - letters):
        ends = np.concatenate([a + np.array(lyndon_ends(ranks[a:b].tolist()), np.int64) for a, b in zip(offsets, offsets[1:])])
        roots = _repeated(words[place], offsets, ends, min_exponent > 2)
        known: dict[tuple[int, int], int] = {}  # end of the last stretch met, by stretch of text and period
        for i, part in zip(roots.tolist(), (np.searchsorted(offsets, roots, "right") - 1).tolist()):
            first, last = int(offsets[part]), int(offsets[part + 1])
            q = int(ends[i]) - i
            if i + q <= known.get((part, q), -1):
                continue
            end = i + q + _same(letters, i, i + q, 1, last - i - q)
            start = i - _same(letters, i - 1, i + q - 1, -1, i - first)
            if end - start >= 2 * q:  # then the root's length is the smallest period
                known[part, q] = end
                if end - start >= max(min_words, min_exponent * q):
                    t = int(text[place[i]])
                    found.add((t, int(place[start] - at[t]), end - start, q))
    return sorted(found)


def _texts(min_exponent: int, min_words: int, spans: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            for part, data, offsets in textarrays.slices(batch, "_text"):
                words, at = textarrays.word_hashes(data, offsets, lower=False)
                runs: dict[int, list[tuple[int, int, int]]] = {}
                for t, *run in find_runs(words, at, min_exponent, min_words):
                    runs.setdefault(t, []).append(tuple(run))
                raw, out = data.tobytes(), []
                for t, (a, b) in enumerate(zip(offsets, offsets[1:])):
                    said, own = raw[a:b].split(), runs.get(t, [])  # splits at 20 and 09 to 0D
                    best = max(own, key=lambda r: (r[1], -r[0], -r[2]), default=None)
                    if own:
                        change = np.zeros(len(said) + 1, np.int64)
                        for start, n, q in own:
                            change[start + q] += 1
                            change[start + n] -= 1
                        said = [w for w, drop in zip(said, np.cumsum(change)) if not drop]
                    kept = b" ".join(said)
                    listed = "".join(f"{s},{n},{q}\n" for s, n, q in own)
                    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
                    more = ([dict(zip(("start", "length", "period"), r)) for r in own], kept.decode()) if spans else ()
                    out.append((len(own), *top, sha(listed.encode()), sha(kept), *more))
                types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])), pa.string()] * spans
                cols = [pa.array(c, k) for c, k in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays([part.column("row"), *cols], names=["row", *RUN, "runs", "collapsed"][: len(cols) + 1])

    return rows


def periodic_runs(df: DataFrame, text: str = "text", keep: list[str] | None = None, min_exponent: int = 4, min_words: int = 6, spans: bool = True) -> DataFrame:
    """row (struct of the ``keep`` columns, all by default) and the runs of words of each whole text.

    n_runs; start, length, period and exponent_milli of the longest run (ties:
    first start, then period; null without runs); SHA-256 of the list of runs
    and of the text without repeats (words of any run after its first period
    go, the others are joined by single spaces); with ``spans`` also the runs
    and that text themselves.

    Null and empty texts have no words and no runs; each row is treated alone,
    so repeated rows and null ids come back as they are; columns of any name
    may be present.
    """
    rows = df.select(F.struct(*(keep if keep is not None else df.columns)).alias("row"), F.col(text).alias("_text"))
    kind = rows.schema["row"].dataType.simpleString()
    more = ", runs array<struct<start:long,length:long,period:long>>, collapsed string" if spans else ""
    numbers = ", ".join(f"{c} long" for c in RUN[:5])
    return rows.mapInArrow(_texts(min_exponent, min_words, spans), f"row {kind}, {numbers}, runs_sha256 string, collapsed_sha256 string{more}")
