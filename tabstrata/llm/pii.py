"""Personal data in texts: exact patterns, and a linear-chain CRF for the ways of writing that they miss.

The patterns (``base_spans``) find e-mail addresses, IP addresses, payment cards
and international phone numbers as they are commonly written. The conditional
random field finds altered forms: "name (at) host dot org", national phone
numbers, cards and IP addresses with other separators. It reads tokens by their
shape (digits by count, letters by case and length, signs as themselves, a few
cue words) and those beside them, is fitted on a small labelled table
(``examples`` makes one from a rule; any table of text and spans will do) and is
decoded by Viterbi over NumPy batches. A span that it proposes stays only if its
digits or parts make such a thing (Luhn sum, parts up to 255, digit counts) and
if it doesn't touch a pattern's span.

The field's sequences are the stretches of a text around its triggers (digits,
``@``, the words for a spelled-out dot), ``REACH`` tokens to each side; a text
without triggers has none, whatever its length.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabstrata.llm import textarrays

KINDS = ("email", "ip", "card", "phone")
#: O, then the first and the further tokens of each kind.
LABELS = 1 + 2 * len(KINDS)
#: Tokens of a sequence on each side of a trigger.
REACH = 10
#: Labelled rows learnt from at most; the first ones by the hash of their text.
MAX_ROWS = 5000
CLASSES, PAIRS = 256, 1 << 14
ROUNDS, RATE, RIDGE = 60, 0.25, 2e-5

# --- exact patterns ---------------------------------------------------------

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, ``@`` and dotted domain; linear in the text, as each ``@`` is looked at once."""
    out, at, last = [], text.find("@"), 0
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > last and _LOCAL.match(text[start - 1]):
                start -= 1
            if start < at:
                out.append((start, domain.end()))
                last = domain.end()
        last, at = max(last, 0), text.find("@", max(at + 1, last))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' matches, kinds in order, each by start; a match that fails its test is passed over."""
    found = [("email", *s) for s in emails(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    found += [("card", *m.span()) for m in _CARD.finditer(text) if 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
    found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return found


# --- tokens and their shapes ------------------------------------------------

_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")
_TRIGGER = re.compile(r"[0-9]+|@|(?<![^\W\d_])(?:dot|punkt|punto|point)(?![^\W\d_])", re.I)
#: Cue words, fixed: words for "at" and "dot", and what stands before numbers of a kind.
CUES = ["at", "dot", "arroba", "punkt", "punto", "point", "mail", "email", "tel", "phone", "call", "fax", "mobile", "card", "visa", "carte", "karte", "tarjeta", "ip", "host", "server", "address", "com", "org", "net", "version", "order", "invoice", "date", "isbn", "page"]
_CUE = {w: 200 + i for i, w in enumerate(CUES)}


def shape(token: str, spaced: bool) -> int:
    """Class of a token below ``CLASSES``: what it is made of and how long it is; ``spaced`` if white space stands before it."""
    if "0" <= token[0] <= "9":
        n = min(len(token), 20)
        return 1 + 2 * (n - 1) + spaced
    if token[0].isalpha():
        cue = _CUE.get(token.lower())
        if cue is not None:
            return cue
        case = 0 if token.islower() else 1 if token[1:].islower() else 2
        return 41 + 2 * (4 * case + min(3, len(token) // 3)) + spaced
    return 65 + 2 * (min(ord(token[0]), 127) - 33) % 134 + spaced if ord(token[0]) > 32 else 199


def sequences(text: str, reach: int = REACH) -> Iterator[list[tuple[int, int]]]:
    """Spans of the tokens of each stretch around triggers; stretches that meet are one, and a line feed ends one."""
    for line in re.finditer(r"[^\n]+", text):
        marks = [m.span() for m in _TRIGGER.finditer(text, *line.span())]
        if not marks:
            continue
        lo, hi, width = marks[0][0], marks[0][1], 12 * reach
        parts = []
        for a, b in marks[1:]:
            if a - hi > 2 * width:
                parts.append((lo, hi))
                lo = a
            hi = b
        for a, b in [*parts, (lo, hi)]:
            a, b = max(line.start(), a - width), min(line.end(), b + width)
            tokens = [m.span() for m in _TOKEN.finditer(text, a, b)]
            hot = np.array([bool(_TRIGGER.match(text, *t)) for t in tokens])
            near = np.flatnonzero(np.convolve(hot, np.ones(2 * reach + 1), "full")[reach : reach + len(tokens)] > 0)
            for run in np.split(near, np.flatnonzero(np.diff(near) > 1) + 1):
                if run.size:
                    yield tokens[run[0] : run[-1] + 1]


def classes(text: str, tokens: list[tuple[int, int]]) -> np.ndarray:
    return np.array([shape(text[a:b], a > 0 and text[a - 1].isspace()) for a, b in tokens], np.int64)


# --- the field --------------------------------------------------------------


def _features(batch: np.ndarray) -> list[np.ndarray]:
    """Rows of the weight tables that each token adds up: its class, two to each side, and hashed pairs. ``batch``: classes, 0 beyond the ends."""
    padded = np.pad(batch, ((0, 0), (2, 2)))
    n = batch.shape[1]
    c = [padded[:, k : k + n] for k in range(5)]
    pair = lambda a, b, salt: ((a * 0x9E3779B1 + b * 0x85EBCA77 + salt * 0xC2B2AE3D) >> 7) % PAIRS
    single = [c[k] + CLASSES * k for k in range(5)]
    return single + [5 * CLASSES + pair(c[i], c[j], s) for s, (i, j) in enumerate(((1, 2), (2, 3), (0, 1), (3, 4), (1, 3)))]


ROWS = 5 * CLASSES + PAIRS


def batches(found: list[np.ndarray], most: int = 20_000) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Sequences of like length as padded arrays of at most ``most`` tokens (one long sequence may have more): their places, classes and lengths."""
    order = sorted(range(len(found)), key=lambda i: len(found[i]))
    while order:
        n, take = len(found[order[-1]]), []
        while order and (not take or (len(take) + 1) * n <= most):
            take.append(order.pop())
        out = np.zeros((len(take), n), np.int64)
        for k, i in enumerate(take):
            out[k, : len(found[i])] = found[i]
        yield take, out, np.array([len(found[i]) for i in take])


class Field:
    """Weights of a linear-chain CRF: ``emit`` (feature rows x labels), ``move`` (label to label), ``first`` and ``last``."""

    def __init__(self, emit: np.ndarray | None = None, move: np.ndarray | None = None, first: np.ndarray | None = None, last: np.ndarray | None = None):
        self.emit = np.zeros((ROWS, LABELS)) if emit is None else emit
        self.move = np.zeros((LABELS, LABELS)) if move is None else move
        self.first = np.zeros(LABELS) if first is None else first
        self.last = np.zeros(LABELS) if last is None else last

    def scores(self, batch: np.ndarray) -> np.ndarray:
        return sum(self.emit[f] for f in _features(batch))

    def viterbi(self, batch: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """Most probable labels of each sequence; ties go to the lower label."""
        e = self.scores(batch)
        n = batch.shape[1]
        back = np.zeros((n, len(batch), LABELS), np.int8)
        best = self.first + e[:, 0]
        for t in range(1, n):
            step = best[:, :, None] + self.move
            back[t] = step.argmax(1)
            best = np.where((t < lengths)[:, None], step.max(1) + e[:, t], best)
        label = (best + self.last).argmax(1)
        out = np.zeros(batch.shape, np.int8)
        rows = np.arange(len(batch))
        for t in range(n - 1, -1, -1):
            out[:, t] = label
            label = np.where((t < lengths) & (t > 0), back[t][rows, label], label)
        return [o[:k] for o, k in zip(out, lengths)]

    def expectations(self, batch: np.ndarray, lengths: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sum of the log partition functions; expected labels of each token, moves, first and last labels (forward-backward)."""
        e = self.scores(batch)
        n, rows = batch.shape[1], np.arange(len(batch))
        inside = np.arange(n) < lengths[:, None]
        high = e.max(2, keepdims=True)
        x, move = np.exp(e - high), np.exp(self.move)
        alpha, beta, scale = np.zeros(e.shape), np.zeros(e.shape), np.ones(batch.shape)  # each step scaled to a sum of one
        for t in range(n):
            step = (alpha[:, t - 1] @ move if t else np.exp(self.first)[None]) * x[:, t]
            scale[:, t] = np.where(inside[:, t], step.sum(1), 1.0)
            alpha[:, t] = np.where(inside[:, t, None], step / scale[:, t, None], alpha[:, t - 1])
        end = alpha[:, n - 1] @ np.exp(self.last)
        beta[:, n - 1] = np.exp(self.last)
        for t in range(n - 2, -1, -1):
            ahead = (beta[:, t + 1] * x[:, t + 1] / scale[:, t + 1, None]) @ move.T
            beta[:, t] = np.where(inside[:, t + 1, None], ahead, beta[:, n - 1])
        z = np.log(scale).sum(1) + (high[..., 0] * inside).sum(1) + np.log(end)
        label = alpha * beta / end[:, None, None] * inside[..., None]
        right = beta[:, 1:] * x[:, 1:] / scale[:, 1:, None] / end[:, None, None] * inside[:, 1:, None]
        moves = np.tensordot(alpha[:, :-1], right, ([0, 1], [0, 1])) * move
        return float(z.sum()), label, moves, label[:, 0].sum(0), label[rows, lengths - 1].sum(0)


def gold_labels(tokens: list[tuple[int, int]], spans: list[tuple[str, int, int]]) -> np.ndarray:
    out = np.zeros(len(tokens), np.int64)
    for kind, start, end in spans:
        k, new = KINDS.index(kind), True
        for i, (a, b) in enumerate(tokens):
            if a >= start and b <= end:
                out[i], new = 1 + 2 * k + (not new), False
    return out


def train(labelled: DataFrame, max_rows: int = MAX_ROWS) -> Field:
    """A field fitted to ``labelled`` (text, spans: array of kind, start, end in code points), at most ``max_rows`` of its rows.

    Rows come in the order of a hash of their text, so the fit is the same on
    every run; rows without a text are left out, null spans mean none.
    """
    rows = labelled.filter("text is not null").orderBy(F.sha2("text", 256)).limit(max_rows).collect()
    found, gold = [], []
    for r in rows:
        spans = [(s["kind"], s["start"], s["end"]) for s in r["spans"] or []]
        for tokens in sequences(r["text"]):
            found.append(classes(r["text"], tokens))
            gold.append(gold_labels(tokens, spans))
    return fit(found, gold)


def gradient(field: Field, found: list[np.ndarray], gold: list[np.ndarray]) -> tuple[float, Field]:
    """Log likelihood of the gold labels and its gradient, a field of the same form."""
    total, g = 0.0, Field()
    for places, batch, lengths in batches(found):
        want = np.zeros(batch.shape, np.int64)
        for k, i in enumerate(places):
            want[k, : lengths[k]] = gold[i]
        inside = np.arange(batch.shape[1]) < lengths[:, None]
        z, label, move, first, last = field.expectations(batch, lengths)
        e, rows = field.scores(batch), np.arange(len(batch))
        total += float((np.take_along_axis(e, want[..., None], 2)[..., 0] * inside).sum() + field.first[want[:, 0]].sum() + field.last[want[rows, lengths - 1]].sum())
        steps = inside[:, 1:]
        total += float((field.move[want[:, :-1], want[:, 1:]] * steps).sum()) - z
        diff = (np.eye(LABELS)[want] * inside[..., None] - label).reshape(-1, LABELS)
        for f in _features(batch):
            for k in range(LABELS):
                g.emit[:, k] += np.bincount(f.ravel(), diff[:, k], ROWS)
        np.add.at(g.move, (want[:, :-1][steps], want[:, 1:][steps]), 1.0)
        g.move -= move
        g.first += np.bincount(want[:, 0], minlength=LABELS) - first
        g.last += np.bincount(want[rows, lengths - 1], minlength=LABELS) - last
    return total, g


def fit(found: list[np.ndarray], gold: list[np.ndarray], rounds: int = ROUNDS) -> Field:
    """Maximum likelihood with a ridge, by AdaGrad over all sequences at once."""
    field = Field()
    names = ("emit", "move", "first", "last")
    seen = {k: np.full(getattr(field, k).shape, 1e-8) for k in names}
    n = max(1, sum(map(len, found)))
    for _ in range(rounds if found else 0):
        _, g = gradient(field, found, gold)
        for k in names:
            w = getattr(field, k)
            step = getattr(g, k) / n - RIDGE * w
            seen[k] += step * step
            w += RATE * step / np.sqrt(seen[k])
    return field


# --- the labelled table -----------------------------------------------------


def _card(rng: random.Random, prefix: str, n: int) -> str:
    body = prefix + "".join(rng.choice("0123456789") for _ in range(n - 1 - len(prefix)))
    return next(body + c for c in "0123456789" if luhn(body + c))


def _said(rng: random.Random) -> tuple[str, str | None]:
    """A piece of text and its kind: personal data in many forms, or a number that is none (None)."""
    word = lambda lo=2, hi=9: "".join(rng.choice("abcdefghilmnoprstuvé") for _ in range(rng.randint(lo, hi)))
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    name = lambda: "".join(c for c in word() if c < "z") or "ann"
    pick = rng.random()
    if pick < 0.2:
        user = name() + rng.choice(["", ".", "_", "-"]) * (k := rng.random() < 0.5) + (rng.choice([name(), num(2)]) if k else "")
        at = rng.choice(["@", "@", " at ", " (at) ", "(at)", " [at] ", "[at]", " AT ", " @ ", "{at}", " arroba "])
        dots = [".", "."] if at == "@" else [rng.choice([" dot ", " (dot) ", "(dot)", " [dot] ", "[dot]", " DOT ", ".", " . ", " punkt ", " punto "])] * 2
        host = dots[0].join([name() + rng.choice(["", num(1)]) for _ in range(rng.randint(1, 2))] + [rng.choice(["com", "org", "net", "de", "fr", "es", "example"])])
        return user + at + host, "email"
    if pick < 0.35:
        parts = [str(rng.randint(0, 255)) for _ in range(4)]
        return rng.choice([".", ".", "[.]", "(.)", " . ", " dot ", "[dot]", "(dot)", " [.] "]).join(parts), "ip"
    if pick < 0.5:
        d = _card(rng, rng.choice(["4", "5", "37", "6011"]), 16)
        d = _card(rng, "37", 15) if d.startswith("37") else d
        sep = rng.choice(["", " ", "-", ".", "/", " - ", "_", "  "])
        return sep.join([d[:4], d[4:10], d[10:]] if len(d) == 15 else [d[i : i + 4] for i in range(0, 16, 4)]), "card"
    if pick < 0.72:
        a, b, c = num(3), num(3), num(4)
        a = rng.choice("23456789") + a[1:]
        forms = [f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"({a}) {b} {c}", f"1-{a}-{b}-{c}", f"+{rng.randint(20, 99)} {num(2)} {num(3)} {num(4)}", f"00{rng.randint(20, 99)} {num(3)} {num(3)} {num(3)}", f"0{num(1)} {num(2)} {num(2)} {num(2)} {num(2)}", f"0{num(3)}/{num(7)}", f"0{num(3)} {num(7)}", f"({a}){b}-{c}", f"+1-{a}-{b}-{c}", f"+1.{a}.{b}.{c}", f"0{num(2)}-{num(4)}-{num(4)}"]
        return rng.choice(forms), "phone"
    y, m, d = rng.randint(1900, 2030), rng.randint(1, 12), rng.randint(1, 28)
    hexes = "".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(16, 40)))
    none = [str(y), f"{y}-{m:02}-{d:02}", f"{d}.{m}.{y}", f"{m}/{d}/{y}", f"{rng.randint(0, 23)}:{rng.randint(10, 59)}", f"{rng.randint(1, 9)}.{rng.randint(0, 99)}", f"version {rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 9)}", f"${num(3)},{num(3)}.{num(2)}", f"{num(2)}%", f"page {num(2)}", f"pages {num(3)}-{num(3)}", f"order {num(rng.randint(5, 12))}", num(rng.randint(1, 12)), f"{num(1)},{num(3)},{num(3)}", f'token = "{hexes}"', f"key={hexes}", hexes.upper(), f"ISBN 978-{num(1)}-{num(3)}-{num(5)}-{num(1)}", f"at {word()} dot {word()}", f"{word()}{num(2)}{word()}", f"{num(1)}. {num(1)}. {num(1)}.", f"{y}-{m:02}-{d:02}T{num(2)}:{num(2)}:{num(2)}", f"{word()} at {num(2)} {word()}", f"the dot {word()}", f"punkt {num(1)}", f"#{num(4)}", f"{num(3)} x {num(3)}", f"@{word()}", f"{num(2)} {num(2)} {num(2)}"]
    return rng.choice(none), None


def example_rows(n: int = 900, seed: int = 7) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Labelled texts by a fixed rule: made-up words with one to three pieces of personal data or of other numbers among them."""
    rng, rows = random.Random(seed), []
    word = lambda: "".join(rng.choice("aeioubcdefghlmnprstvéñü") for _ in range(rng.randint(2, 10)))
    for _ in range(n):
        text, spans = "", []
        for _ in range(rng.randint(1, 3)):
            for _ in range(rng.randint(1, 12)):
                w = word()
                w = w.title() if rng.random() < 0.15 else w.upper() if rng.random() < 0.05 else w
                w = rng.choice(["at", "dot", "point", "punto", "tel", "phone:", "call", "email", "card", "IP"]) if rng.random() < 0.06 else w
                text += w + rng.choice([" ", " ", " ", " ", " ", ", ", ". "])
            piece, kind = _said(rng)
            if kind:
                spans.append((kind, len(text), len(text) + len(piece)))
            text += piece + rng.choice([" ", " ", " ", ". ", ", ", "!! ", "### ", "\n"])
        rows.append((text + word() + ".", spans))
    return rows


def examples(spark: SparkSession, n: int = 900) -> DataFrame:
    """``example_rows`` as a table of text and spans."""
    return spark.createDataFrame(example_rows(n), "text string, spans array<struct<kind:string,start:int,end:int>>")


# --- finding ----------------------------------------------------------------

_AT = re.compile(r"\s*(?:[(\[{]\s*(?:at|@|arroba)\s*[)\]}]|\bat\b|\barroba\b|@)\s*", re.I)
_DOT = re.compile(r"\s*(?:[(\[{]\s*(?:dot|punkt|punto|point|\.)\s*[)\]}]|\b(?:dot|punkt|punto|point)\b|\.)\s*", re.I)
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def plausible(kind: str, said: str) -> bool:
    """Whether a proposed span is such a thing: an address once "at" and "dot" are signs, four parts up to 255, a Luhn sum, or a phone's digits with separators or a plus."""
    if kind == "email":
        return bool(_ADDRESS.fullmatch(_DOT.sub(".", _AT.sub("@", said, count=1))))
    if kind == "ip":
        parts = _DOT.split(said)
        return len(parts) == 4 and all(p and set(p) <= set("0123456789") and _small(p) for p in parts)
    digits = digits_of(said)
    if kind == "card":
        return 15 <= len(digits) <= 19 and not re.search(r"[^0-9 ._/-]", said) and luhn(digits)
    separated = len(re.findall(r"[0-9]+", said)) > 1
    return not re.search(r"[^0-9 ()./+-]", said) and (9 if digits[:1] == "0" else 10) <= len(digits) <= 15 and (separated or said[0] == "+")


def model_spans(field: Field, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """What the field finds and ``plausible`` lets stand, by start, for each text."""
    found, home = [], []
    for i, text in enumerate(texts):
        for tokens in sequences(text):
            found.append(classes(text, tokens))
            home.append((i, tokens))
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for places, batch, lengths in batches(found):
        for k, labels in zip(places, field.viterbi(batch, lengths)):
            i, tokens = home[k]
            if not labels.any():
                continue
            kind = np.where(labels > 0, (labels + 1) // 2, 0)
            begins = np.flatnonzero((kind > 0) & ((labels % 2 == 1) | (np.r_[0, kind[:-1]] != kind)))
            for at in begins.tolist():
                to = at + 1
                while to < len(kind) and kind[to] == kind[at] and labels[to] % 2 == 0:
                    to += 1
                start, end = tokens[at][0], tokens[to - 1][1]
                if plausible(KINDS[kind[at] - 1], texts[i][start:end]):
                    out[i].append((KINDS[kind[at] - 1], start, end))
    return [sorted(x, key=lambda s: s[1]) for x in out]


def all_spans(base: list[tuple[str, int, int]], more: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The base spans and those of ``more`` that touch none of them, by kind, then start."""
    taken = sorted((a, b) for _, a, b in base)
    starts = np.array([a for a, _ in taken])
    far = np.maximum.accumulate([b for _, b in taken]) if taken else None

    def free(a: int, b: int) -> bool:
        k = int(np.searchsorted(starts, b)) if taken else 0
        return not k or far[k - 1] <= a

    extra = [s for s in more if free(s[1], s[2])]
    return sorted([*base, *extra], key=lambda s: (KINDS.index(s[0]), s[1]))


def _find(field: Field):
    def rows(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        hot = np.zeros(256, np.uint8)
        hot[[*b"0123456789@"]] = 1
        dots = re.compile(rb"dot|punkt|punto|point", re.I)
        for batch in batches_:
            for part, data, offsets in textarrays.slices(batch, "_text", 8 << 20):
                marks = np.r_[0, np.cumsum(hot[data], dtype=np.int64)]
                some = np.diff(marks[offsets]) > 0
                raw = data.tobytes()
                texts = {i: raw[a:b].decode() for i, (a, b) in enumerate(zip(offsets, offsets[1:])) if some[i] or dots.search(raw, a, b)}
                base = {i: base_spans(t) for i, t in texts.items()}
                more = dict(zip(texts, model_spans(field, list(texts.values()))))
                out = []
                for i in range(part.num_rows):
                    own = base.get(i, [])
                    spans = all_spans(own, more[i]) if more.get(i) else own
                    said = told(own)
                    out.append((*(sum(s[0] == k for s in own) for k in KINDS), hashlib.sha256(said.encode()).hexdigest(), told(spans)))
                cols = [pa.array(c, k) for c, k in zip(zip(*out), [pa.int64()] * 4 + [pa.string()] * 2)]
                yield pa.RecordBatch.from_arrays([part.column("row"), *cols], names=["row", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return rows


def find(df: DataFrame, field: Field, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """row (struct of the ``keep`` columns, all by default), the patterns' matches by kind, the digest of their list, and all spans.

    Spans are ``kind:start:end`` in code points, joined by commas, by kind and
    start; the digest's list is written likewise. Null and empty texts have
    none; rows are treated alone, so null ids and repeated rows come back as
    they are; columns of any name may be present.
    """
    rows = df.select(F.struct(*(keep if keep is not None else df.columns)).alias("row"), F.col(text).alias("_text"))
    kind = rows.schema["row"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(_find(field), f"row {kind}, {counts}, base_sha256 string, spans string")
