"""Personal data, periodic runs and the Merkle manifest against brute force and on odd inputs."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tabstrata.llm import merkle, periodic, pii, queries, textarrays
from tabstrata.session import ship_package

ODD = [
    (1, "a b a b a b a b c", "s1"), (2, "mail ann.b@x.example.org or call +1 (249) 555-6835, 10.0.0.255.", "s1"), (3, None, None), (4, "", "s2"), (5, "same row", "s2"), (5, "same row", "s2"),
    (None, "no id", "s1"), (6, "\n \n", None), (7, "word " * 30_000, "s3"), (8, "tab\tüß漢🙂 x@é a@b.c 1.2.3.4.5", ""), (10, "lone leaf", "s4"),
]
SHA = lambda s: hashlib.sha256(s.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, a repeated row, and columns whose names the operators use themselves."""
    ship_package(spark)
    rows = [(*r, "en", len(r[1] or ""), i, "x", [i]) for i, r in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, n_runs long, row string, digest array<int>")


# --- personal data


PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def _base(text):
    out = []
    for kind, p in PATTERNS:
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")) or kind == "card" and 16 <= len(d) <= 19 and pii.luhn(d) or kind == "phone" and 8 <= len(d) <= 15:
                out.append((kind, *m.span()))
    return out


def test_patterns_equal_plain_regexes():
    rng = random.Random(2)
    for letters in ("a.@-", "12.0@", "0 -4", "+1 ().-2", "a@.1-_%+ \n", "25.+ -(@aé"):
        for _ in range(3000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
            assert pii.base_spans(text) == _base(text), text
    assert pii.base_spans("x" * 300_000) == pii.base_spans("1" * 300_000 + "." * 100_000) == []


def test_field_sums_and_gradient_equal_enumeration():
    rng = np.random.default_rng(0)
    f = pii.Field(rng.normal(size=(pii.ROWS, pii.LABELS)) * 0.3, rng.normal(size=(9, 9)), rng.normal(size=9), rng.normal(size=9))
    found = [rng.integers(1, 250, n) for n in (3, 1, 2)]
    gold = [rng.integers(0, 9, len(s)) for s in found]

    def score(s, y):
        e = f.scores(s[None])[0]
        return f.first[y[0]] + f.last[y[-1]] + sum(e[t, k] for t, k in enumerate(y)) + sum(f.move[a, b] for a, b in zip(y, y[1:]))

    def likelihood():
        return sum(score(s, g) - np.log(sum(np.exp(score(s, y)) for y in itertools.product(range(9), repeat=len(s)))) for s, g in zip(found, gold))

    total, g = pii.gradient(f, found, gold)
    assert abs(total - likelihood()) < 1e-8
    for name in ("emit", "move", "first", "last"):
        w, slope = getattr(f, name), getattr(g, name)
        for i in map(tuple, np.argwhere(np.abs(slope) > 1e-3)[:2]):
            w[i] += 1e-5
            up = likelihood()
            w[i] -= 2e-5
            down = likelihood()
            w[i] += 1e-5
            assert abs((up - down) / 2e-5 - slope[i]) < 1e-4
    lengths = np.array([3, 2])
    batch = np.array([found[0], [*found[2], 0]])
    for s, got in zip((found[0], found[2]), f.viterbi(batch, lengths)):
        assert tuple(got) == max(itertools.product(range(9), repeat=len(s)), key=lambda y: score(s, y))


@pytest.fixture(scope="module")
def field(spark):
    return pii.train(pii.examples(spark))


def test_field_on_held_out_examples(field):
    rows = pii.example_rows(300, seed=99)
    right = wrong = missed = 0
    for (_, spans), found in zip(rows, pii.model_spans(field, [t for t, _ in rows])):
        right, wrong, missed = right + len(set(spans) & set(found)), wrong + len(set(found) - set(spans)), missed + len(set(spans) - set(found))
    assert right / (right + wrong) > 0.98 and right / (right + missed) > 0.93
    said = "write to jo.doe (at) mail dot example dot com or 249-555-6835, not 2024-01-15 nor version 1.2.3"
    assert [(k, said[a:b]) for k, a, b in pii.model_spans(field, [said])[0]] == [("email", "jo.doe (at) mail dot example dot com"), ("phone", "249-555-6835")]


def test_find_keeps_base_spans(spark, odd, field):
    got = {r.row.n_runs: r for r in pii.find(odd, field).collect()}
    assert len(got) == len(ODD) and got[0].row.asDict().keys() == set(odd.columns)
    for i, (_, text, _) in enumerate(ODD):
        base, r = _base(text), got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert r.base_sha256 == SHA(",".join(f"{k}:{a}:{b}" for k, a, b in base))
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(","))
    assert pii.find(odd.limit(0), field).count() == 0
    blank = pii.train(spark.createDataFrame([(None, None)], pii.examples(spark, 1).schema))
    assert blank.viterbi(np.zeros((1, 3), int), np.array([3]))[0].tolist() == [0, 0, 0]


def test_pii_query(spark, odd):
    got = {r.doc_id: r for r in queries.op11_pii(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        base = _base(r.text)
        assert got[r.doc_id].base_sha256 == SHA(",".join(f"{k}:{a}:{b}" for k, a, b in base))
        if not re.search("[0-9@]", r.text or ""):
            assert got[r.doc_id].spans == ""


# --- periodic runs


def _runs(w, exponent, least):
    found, n = {}, len(w)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def test_lyndon_words_of_both_orders():
    rng = random.Random(1)
    for _ in range(1500):
        w = [rng.randint(0, rng.choice([1, 2, 3])) for _ in range(rng.randint(0, 24))]
        tails = [w[i:] for i in range(len(w))]
        assert periodic.lyndon_ends(w) == [next((j for j in range(i + 1, len(w)) if tails[j] < tails[i]), len(w)) for i in range(len(w))]


def test_runs_equal_brute_force():
    rng = random.Random(4)
    for _ in range(1000):
        docs = []
        for _ in range(rng.randint(1, 4)):
            w = []
            while rng.random() < 0.8:
                block = [rng.randint(0, rng.choice([1, 2, 4])) for _ in range(rng.randint(1, 5))] * rng.randint(1, 7)
                w += block[: rng.randint(1, len(block))]
            docs.append(w)
        words = textarrays.mix(np.array([x for w in docs for x in w], np.uint64) + np.uint64(7))
        at = np.r_[0, np.cumsum([len(w) for w in docs])]
        for exponent, least in ((4, 6), (2, 2), (3, 4)):
            assert periodic.find_runs(words, at, exponent, least) == sorted((k, *r) for k, w in enumerate(docs) for r in _runs(w, exponent, least))
    with pytest.raises(ValueError):
        periodic.find_runs(words, at, 1)


def _told(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = _runs(w, 4, 6)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return runs, SHA("".join(f"{s},{n},{q}\n" for s, n, q in runs)), SHA(" ".join(x for i, x in enumerate(w) if i not in gone))


def test_periodic_runs_on_odd_rows(spark, odd):
    got = {r.row.n_runs: r for r in periodic.periodic_runs(odd).collect()}
    assert len(got) == len(ODD)
    for i, (_, text, _) in enumerate(ODD):
        if i == 8:  # 30,000 equal words
            assert [tuple(x) for x in got[i].runs] == [(0, 30_000, 1)] and got[i].collapsed == "word" and got[i].exponent_milli == 30_000_000
            continue
        runs, listed, kept = _told(text)
        assert ([tuple(x) for x in got[i].runs], got[i].runs_sha256, got[i].collapsed_sha256) == (runs, listed, kept)
        assert got[i].n_runs == len(runs) and (got[i].start is None) == (not runs)
    assert periodic.periodic_runs(odd.limit(0)).count() == 0


def test_periodic_query(spark, odd):
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SF_SMALL).collect()}
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        h = zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if len(w) < 1500:
            _, listed, kept = _told(" ".join(w))
            assert (got[r.doc_id].runs_sha256, got[r.doc_id].collapsed_sha256) == (listed, kept)


# --- Merkle manifest


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _tree(nodes):
    """Root, and for each leaf its siblings from the bottom up as (before, after) lists."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, k in enumerate(at):
            lo = k // 16 * 16
            paths[leaf].append((nodes[lo:k], nodes[k + 1 : lo + 16]))
        nodes, at = [SHA("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)], [k // 16 for k in at]
    return nodes[0], paths


def _manifest(rows, tampered=lambda d: False):
    """rows: (doc_id, source, lang, n_chars, text)."""
    null_first = lambda v: (v is not None, v if v is not None else 0)
    leaf = lambda r: SHA("".join(map(_field, r)))
    by = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), null_first(r[0]), leaf(r))):
        by.setdefault(r[1], []).append(r)
    trees = [_tree([leaf(r) for r in own]) for own in by.values()]
    root, tops = _tree([t for t, _ in trees])
    out = []
    for (sub, paths), top, own in zip(trees, tops, by.values()):
        for path, r in zip(paths, own):
            text = re.sub("[A-Z]", lambda m: m[0].lower(), r[4]) if r[4] is not None and tampered(r[0]) else r[4]
            given = leaf((*r[:4], text))
            for before, after in path + top:
                given = SHA("".join([*before, given, *after]))
            proof = SHA("".join("".join(b + a) for b, a in path + top))
            out.append((r[0], leaf(r), sub, root, proof, given, given == root))
    return sorted(out, key=str)


def test_manifest_equals_brute_force(spark, odd):
    rows = [(d, s, "en", len(t or ""), t) for d, t, s in ODD]
    got = merkle.manifest(odd).drop("path").collect()
    assert sorted(map(tuple, got), key=str) == _manifest(rows) and all(r.verified for r in got)
    assert merkle.manifest(odd.limit(0)).collect() == []
    one = odd.filter("doc_id = 10")
    assert merkle.manifest(one).drop("path").collect()[0].root == _manifest([r for r in rows if r[0] == 10])[0][3]


def test_manifest_of_deep_trees_and_repeated_rows(spark, odd):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    docs = spark.range(900).select(F.when(F.col("id") < 600, F.col("id")).otherwise(F.lit(7)).alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 19).cast("string"))).alias("source"), F.lit("en").alias("lang"), F.lit(3).alias("n_chars"), F.lit("Abc").alias("text")).repartition(3)
    rows = [tuple(r) for r in docs.collect()]
    try:
        for parts in (1, 5):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            chosen = F.col("doc_id") % 5 == 0
            got = merkle.manifest(docs, {"text": F.lower("text")}, chosen).drop("path").collect()
            assert sorted(map(tuple, got), key=str) == _manifest(rows, lambda d: d % 5 == 0)
            assert {r.doc_id % 5 == 0 for r in got if not r.verified} == {True}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_manifest_plan_does_not_grow_with_the_trees(spark):
    def joins(n):
        docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"), F.lit("a").alias("text"))
        out = merkle.manifest(docs)
        assert out.filter("verified").count() == n
        return out._jdf.queryExecution().optimizedPlan().toString().count("Join ")

    assert joins(300) == joins(5000)  # three and four heights


def test_manifest_query(spark, odd):
    got = sorted(map(tuple, queries.op13_merkle_manifest(spark, SF_SMALL).collect()), key=str)
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert got == _manifest(rows, lambda d: zlib.crc32(str(d).encode()) % 5 == 0)
