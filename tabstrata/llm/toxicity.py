"""Toxicity by a factorization machine over hashed terms.

Terms are a text's words (A-Z lower-cased, ASCII punctuation off their ends)
and the words' first 4, 5 and 6 bytes, hashed to 2^20 columns and counted once
a text. The score is the logistic function of a bias, the terms' weights and
the pairwise products of their factors, so that two terms together can weigh
more than each alone. The pairwise part is over the root of the number of
terms, so a long text isn't all pairs.

The model is fitted on a bounded sample of labelled rows (``SAMPLE`` and
``SAMPLE_TERMS``, those with the smallest hash of their id); the terms of the
sample come to the driver as packed numbers, the texts don't. Pairs of words are
counted in tasks, a range of words each; the words that tell come back. A column is fitted if its presence goes
with the label, or if it is half of a pair of words that does where neither
word need do so alone: among texts with either word, the other tells. Columns
and pairs in fewer than ``MIN_TEXTS`` sample texts are left out. All texts are
scored in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabstrata.llm import textarrays
from tabstrata.session import scratch_path

COLUMNS_LOG2, PREFIXES = 20, (4, 5, 6)
#: Labelled rows to fit on, at most, and how many distinct terms their texts have together, at most.
SAMPLE, SAMPLE_TERMS = 20_000, 40_000_000
#: Neighbours of words that one task looks through for pairs, at most (or those of one word).
PAIR_STEPS = 20_000_000
MIN_TEXTS = 3
#: A column is fitted if its chi-square with the label is at least this (one in 1e4 columns by chance),
#: the words of a pair if so are both likelihood ratios of the pair, among texts with one word or the other. Three-fold
#: cross-validation among the learnable labels of sf0.1 (2,990) gave log losses of 0.057, 0.051, 0.059, 0.060 for 10.8, 15.1, 20, 25.
MIN_CHI2 = 15.1
FACTORS, EPOCHS, BATCH, RATE, DECAY = 4, 12, 128, 0.1, 1e-5
THRESHOLD = 0.3


def terms(data: np.ndarray, offsets: np.ndarray, prefixes: tuple[int, ...] = PREFIXES) -> tuple[np.ndarray, np.ndarray]:
    """Text index and column of every distinct term of the texts, in order; without ``prefixes``, of every distinct word."""
    start, end, at = textarrays.word_spans(data, offsets)
    if not start.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lower = textarrays.LOWER[data]
    doc = np.repeat(np.arange(len(at) - 1, dtype=np.uint64), np.diff(at))
    pairs = []
    for k in (0, *prefixes):
        take = np.arange(len(start)) if not k else np.flatnonzero(end - start >= k)
        h = textarrays.hash_spans(lower, start[take], start[take] + k if k else end[take])
        column = textarrays.mix(h + np.uint64(k)) >> np.uint64(64 - COLUMNS_LOG2)
        pairs.append(doc[take] << np.uint64(COLUMNS_LOG2) | column)
    every = np.unique(np.concatenate(pairs))
    return (every >> np.uint64(COLUMNS_LOG2)).astype(np.int64), (every & np.uint64((1 << COLUMNS_LOG2) - 1)).astype(np.int64)


class Machine:
    """Bias, weights and factors of the columns that were fitted."""

    def __init__(self, columns: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.columns, self.bias, self.weights, self.factors = columns, bias, weights, factors

    def place(self) -> np.ndarray:
        """Row of each hashed column, or -1."""
        place = np.full(1 << COLUMNS_LOG2, -1, np.int32)
        place[self.columns] = np.arange(len(self.columns), dtype=np.int32)
        return place

    def margins(self, doc: np.ndarray, col: np.ndarray, n: int) -> np.ndarray:
        """Margin of each of n texts from its (text, row) pairs."""
        count = np.bincount(doc, minlength=n)
        scale = 1.0 / np.sqrt(np.maximum(count, 1))
        out = self.bias + np.bincount(doc, self.weights[col], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[col, f]
            out += 0.5 * ((np.bincount(doc, v, n) * scale) ** 2 - np.bincount(doc, v * v, n) * scale**2)
        return out


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def telling(texts: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Columns in ``MIN_TEXTS`` texts or more whose presence goes with the label."""
    counts = np.zeros((2, 1 << COLUMNS_LOG2))
    for k in (0, 1):
        own = [t for t, y in zip(texts, labels) if y == k]
        counts[k] = np.bincount(np.concatenate([np.zeros(0, np.int64), *own]), minlength=1 << COLUMNS_LOG2)
    n0, n1 = float((labels == 0).sum()), float((labels == 1).sum())
    c0, c1 = counts
    has = c0 + c1
    spread = has * (n0 + n1 - has) * n0 * n1
    chi2 = np.divide((n0 + n1) * (c1 * (n0 - c0) - c0 * (n1 - c1)) ** 2, spread, out=np.zeros_like(has), where=spread > 0)
    return np.flatnonzero((has >= MIN_TEXTS) & (chi2 >= MIN_CHI2))


def _ratio(t: np.ndarray, n: np.ndarray, all_t: np.ndarray, all_n: np.ndarray) -> np.ndarray:
    """Likelihood ratio of t ones in n texts against the others of all_n texts with all_t ones."""
    log = lambda x, y: x * np.log(np.maximum(x, 1) / np.maximum(y, 1))
    rest, rest_t = all_n - n, all_t - t
    return 2 * (log(t, n) + log(n - t, n) + log(rest_t, rest) + log(rest - rest_t, rest) - log(all_t, all_n) - log(all_n - all_t, all_n))


class _Words:
    """Texts as ascending lists of candidate words, and each word's places in them."""

    def __init__(self, words: list[np.ndarray], labels: np.ndarray):
        has, ones = (np.bincount(np.concatenate([np.zeros(0, np.int64), *some]), minlength=1 << COLUMNS_LOG2).astype(float) for some in (words, [w for w, y in zip(words, labels) if y > 0]))
        self.columns = np.flatnonzero((has >= MIN_TEXTS) & (_ratio(ones, ones, ones, has) >= MIN_CHI2))
        place = np.full(1 << COLUMNS_LOG2, -1, np.int32)
        place[self.columns] = np.arange(len(self.columns), dtype=np.int32)
        rows = [r[r >= 0] for r in (place[w] for w in words)]
        self.flat = np.concatenate([np.zeros(0, np.int32), *rows])
        length = np.array([len(r) for r in rows], np.int64)
        self.end = np.repeat(np.cumsum(length), length).astype(np.int32)
        self.one = np.repeat(labels > 0, length)
        self.by_word = np.argsort(self.flat, kind="stable").astype(np.int32)
        self.total, self.ones = has[self.columns], ones[self.columns]
        self.cut = np.r_[0, np.cumsum(self.total).astype(np.int64)]

    def ranges(self) -> list[tuple[int, int]]:
        """Ranges of words with at most ``PAIR_STEPS`` later neighbours each, or of one word."""
        steps = np.r_[0, np.cumsum((self.end - np.arange(len(self.flat)))[self.by_word])][self.cut]
        out, at = [], 0
        while at < len(self.columns):
            to = max(at + 1, int(np.searchsorted(steps, steps[at] + PAIR_STEPS, "right")) - 1)
            out.append((at, to))
            at = to
        return out

    def found(self, first: int, last: int) -> np.ndarray:
        """Words in telling pairs whose first word is in the range."""
        size = len(self.columns)
        found = np.zeros(size, bool)
        for i in range(first, last):
            at = self.by_word[self.cut[i] : self.cut[i + 1]]
            toxic = self.one[at]
            t, n = (np.bincount(np.concatenate([np.zeros(0, np.int32), *(self.flat[a + 1 : b] for a, b in zip(some.tolist(), self.end[some].tolist()))]), minlength=size) for some in (at[toxic], at[~toxic]))
            n = n + t
            j = np.flatnonzero(n >= MIN_TEXTS)
            t, n = t[j].astype(float), n[j].astype(float)
            hit = j[(_ratio(t, n, self.ones[i], self.total[i]) >= MIN_CHI2) & (_ratio(t, n, self.ones[j], self.total[j]) >= MIN_CHI2)]
            if len(hit):
                found[i] = found[hit] = True
        return np.flatnonzero(found)


def telling_pairs(words: list[np.ndarray], labels: np.ndarray, spark: SparkSession | None = None) -> np.ndarray:
    """Columns of the words in pairs that tell more than each of their words.

    Pairs in ``MIN_TEXTS`` texts or more are counted, one word at a time with
    the words that come after it in its texts. Words whose texts' labels have
    too little entropy for any pair to reach ``MIN_CHI2`` are left out first.
    With a session, ranges of words are counted by its tasks; the lists that
    they are sent hold at most ``SAMPLE_TERMS`` words.
    """
    lists = _Words(words, labels)
    ranges = lists.ranges()
    if spark is None or len(ranges) < 2:
        found = [lists.found(*r) for r in ranges]
        return lists.columns[np.unique(np.concatenate([np.zeros(0, np.int64), *found]))]
    sent = spark.sparkContext.broadcast(lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("id").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(sent.value.found(*ranges[k]), pa.int64())], names=["word"])

    told = spark.range(0, len(ranges), 1, len(ranges)).mapInArrow(run, "word long").distinct().toArrow()  # at most the candidate words
    return lists.columns[np.sort(told["word"].to_numpy())]


def fit(texts: list[np.ndarray], words: list[np.ndarray], labels: np.ndarray, spark: SparkSession | None = None, seed: int = 7) -> Machine:
    """Logistic loss by AdaGrad over batches of texts; the columns of each text, and those of its words, are distinct."""
    columns = np.union1d(telling(texts, labels), telling_pairs(words, labels, spark))
    rate = float(labels.mean()) if len(labels) else 0.0
    clipped = min(max(rate, 1e-6), 1 - 1e-6)
    rng = np.random.default_rng(seed)
    machine = Machine(columns, float(np.log(clipped / (1 - clipped))), np.zeros(len(columns)), rng.normal(0, 0.01, (len(columns), FACTORS)))
    if not 0 < rate < 1:
        return machine
    place = machine.place()
    rows = [r[r >= 0] for r in (place[t] for t in texts)]
    w, v = machine.weights, machine.factors
    sum_w, sum_v, sum_b = np.full(len(w), 1e-6), np.full(v.shape, 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            these = order[at : at + BATCH]
            own = [rows[i] for i in these]
            size = np.array([len(r) for r in own])
            col, doc = np.concatenate(own), np.repeat(np.arange(len(these)), size)
            scale = 1.0 / np.sqrt(np.maximum(size, 1))
            gradient = logistic(machine.margins(doc, col, len(these))) - labels[these]
            used, which = np.unique(col, return_inverse=True)
            step = np.bincount(which, gradient[doc], len(used)) + DECAY * len(these) * w[used]
            sum_w[used] += step**2
            w[used] -= RATE * step / np.sqrt(sum_w[used])
            for f in range(FACTORS):
                x = v[col, f]
                total = np.bincount(doc, x, len(these)) * scale
                step = np.bincount(which, gradient[doc] * scale[doc] * (total[doc] - x * scale[doc]), len(used)) + DECAY * len(these) * v[used, f]
                sum_v[used, f] += step**2
                v[used, f] -= RATE * step / np.sqrt(sum_v[used, f])
            step = gradient.sum()
            sum_b += step**2
            machine.bias -= RATE * step / np.sqrt(sum_b)
    return machine


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row an id, however many rows it has in the task: those terms whose text has the smallest hash."""
    best: dict[int, tuple] = {}  # at most the chosen ids
    for batch in batches:
        for part, data, offsets in textarrays.slices(batch, "_text"):
            packed = []
            for prefixes in (PREFIXES, ()):
                doc, col = terms(data, offsets, prefixes)
                cut = np.searchsorted(doc, np.arange(part.num_rows + 1))
                packed.append([col[a:b].astype("<i4").tobytes() for a, b in zip(cut, cut[1:])])
            ids, *known = (part.column(c).to_pylist() for c in ("doc_id", "key", "label"))
            for i, *row in zip(ids, *known, *packed):
                if i not in best or row < best[i]:
                    best[i] = row
    ids = list(best)
    for at in range(0, len(ids), 1000):
        some = ids[at : at + 1000]
        columns = [pa.array([best[i][k] for i in some], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.binary(), pa.binary()))]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *columns], names=["doc_id", "key", "label", "terms", "words"])


def train(docs: DataFrame, labels: DataFrame, label: str, usable: Column, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Machine:
    """Fit on at most ``sample`` labelled rows whose id satisfies ``usable`` (a condition on ``doc_id``).

    They are taken by a hash of their id as long as their texts have at most
    ``SAMPLE_TERMS`` distinct terms together.

    Rows with a null id or label are left out; an id labelled twice counts as
    1 if any label is, an id with several rows in ``docs`` once, with the text
    of the smallest hash. Without both classes every score is the share of ones.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).dropna().filter(usable)
    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"))
    chosen = known.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), F.col(text).alias("_text"))
    found = texts.join(F.broadcast(chosen), "doc_id").mapInArrow(_terms, "doc_id long, key long, label int, terms binary, words binary")
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "toxicity-sample")
    found.groupBy("doc_id").agg(F.min(F.struct("key", "label", "terms", "words")).alias("row")).select("doc_id", "row.*").write.parquet(path)
    least = spark.read.parquet(path)
    so_far = F.sum(F.octet_length("terms") / 4).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))  # ``sample`` rows of two numbers
    taken = least.select("doc_id", so_far.alias("n")).filter(F.col("n") <= SAMPLE_TERMS)
    rows = least.join(F.broadcast(taken), "doc_id").select("label", "terms", "words").toArrow()  # bounded by ``sample`` and ``SAMPLE_TERMS``
    order = sorted(range(rows.num_rows), key=lambda i: rows["terms"][i].as_py())  # the same order on every run
    packed = [[np.frombuffer(rows[c][i].as_py(), "<i4") for i in order] for c in ("terms", "words")]
    return fit(*packed, np.array([rows["label"][i].as_py() for i in order], float), spark)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.value
        place = machine.place()
        for batch in batches:
            for part, data, offsets in textarrays.slices(batch, "_text"):
                doc, col = terms(data, offsets)
                row = place[col]
                margin = machine.margins(doc[row >= 0], row[row >= 0], part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(logistic(margin))], names=["row", "score"])

    return run


def score(docs: DataFrame, machine: Machine, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """row (struct of the ``keep`` columns, all by default) and score of every row; null and empty texts score the bias."""
    rows = docs.select(F.struct(*(keep if keep is not None else docs.columns)).alias("row"), F.col(text).alias("_text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(machine)), f"row {kind}, score double")
