"""Line dedup, host rules, token counts, byte-level BPE and chat windows against brute force and on odd inputs."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import tiktoken
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tabstrata.llm import bpe, chat_windows, host_rules, line_dedup, pretokens, queries, token_counts
from tabstrata.session import ship_package

ODD = [
    (1, "a b c\nshared line\n\nit's", "s1"), (2, " Shared LINE \t\nx", "s1"), (3, None, None), (4, "", "s2"), (5, "shared line", "s2"), (5, "shared line", "s2"),
    (None, "shared line\nno id", "s1"), (6, "\n\n", "s3"), (7, "word " * 30_000, "s3"), (8, "tab\tüß漢🙂 <|endoftext|> 's 12", "s3"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, a repeated row, and columns whose names the operators use themselves."""
    ship_package(spark)
    rows = [(*r, i, "x", [i]) for i, r in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words long, row string, ids array<int>")


def test_line_dedup_brute_force(spark, odd):
    for keep_first in (False, True):
        got = line_dedup.drop_shared_lines(odd, min_docs=3, keep_first=keep_first).collect()
        assert len(got) == len(ODD)
        seen = collections.defaultdict(set)
        for d, t, _ in ODD:
            for line in (t or "").encode().split(b"\n"):
                if line_dedup.line_key(line):
                    seen[line_dedup.line_key(line)].add(d)
        often = {k for k, v in seen.items() if len(v) >= 3}
        assert often == {b"shared line"}
        kept = [r for r in got if b"shared line" in [line_dedup.line_key(x) for x in r.kept_text.encode().split(b"\n")]]
        if keep_first:  # the least id has it still
            assert [r.row.doc_id for r in kept] == [1] or {r.row.doc_id for r in kept} <= {None, 1}
            assert len(kept) == 1
            continue
        for r in got:
            lines = (r.row.text or "").split("\n")
            stay = [x for x in lines if line_dedup.line_key(x.encode()) not in often]
            assert (r.n_lines, r.n_dropped, r.kept_text) == (len(lines), len(lines) - len(stay), "\n".join(stay))


def test_line_dedup_hot_line_spans_partitions(spark):
    """A line of every document: its run crosses many partitions, at every count around the limit."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (9, 10, 11, 400):
            docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("common\nown "), F.col("id").cast("string")).alias("text")).repartition(5)
            for parts in (1, 7):
                spark.conf.set("spark.sql.shuffle.partitions", parts)
                gone = line_dedup.dropped_lines(docs, min_docs=10).count()
                assert gone == (n if n >= 10 else 0)
                assert line_dedup.dropped_lines(docs, min_docs=10, keep_first=True).count() == (n - 1 if n >= 10 else 0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_dedup_documents_columns_and_emptied(spark, odd):
    out = line_dedup.dedup_documents(odd, min_docs=3, drop_emptied=True)
    assert out.columns == odd.columns
    rows = out.collect()
    assert sorted(r.n_words for r in rows) == [0, 1, 2, 3, 6, 7, 8, 9]  # the two rows that were one shared line are gone
    assert next(r for r in rows if r.n_words == 2).text is None


def _rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_host_rules_brute_force(spark, odd):
    more = [(100 + i, t, "s9") for i, t in enumerate(["a b c a b c", "x\nx\n x\nx", "# | <> a", "one two three " * 40, "é " * 60])]
    docs = odd.select("doc_id", "text", "source").unionByName(spark.createDataFrame(more, "doc_id long, text string, source string"))
    got = host_rules.judge(docs).collect()
    key = lambda r: str(r)
    want = sorted([(d, *_rules(t)) for d, t, _ in [*ODD, *more]], key=key)
    assert sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got], key=key) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_host_verdict_shrinks_and_spares_clean_documents(spark):
    clean, noisy = " ".join(f"word{i}" for i in range(60)), " ".join(f"w{i}ord #" for i in range(60))
    rows = [(i, noisy if i % 10 else clean, "bad") for i in range(100)] + [(200 + i, clean, "good") for i in range(100)] + [(400, noisy, "tiny")] + [(500, noisy, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in host_rules.judge(docs).collect()}
    assert got[1].host_rejected and not got[1].kept and got[0].kept  # a clean document of a bad host stays
    assert not got[200].host_rejected and got[200].kept
    assert got[400].host_rate < 1 and got[500].host_rate < 1  # one failure is pulled towards all hosts
    kept = host_rules.filter_documents(docs.withColumn("host", F.lit(1)).withColumn("row", F.lit(2)))
    assert kept.columns == ["doc_id", "text", "source", "host", "row"]
    assert {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if r.kept}


def test_base_failures_count_for_the_host(spark):
    """One in four documents of a host is too short, and nobody else's: its soft failures go, those of another host stay."""
    clean, noisy = " ".join(f"word{i}" for i in range(60)), " ".join(f"w{i}ord #" for i in range(60))
    rows = [(i, "short" if i % 4 == 0 else noisy if i % 50 == 1 else clean, "bad") for i in range(400)] + [(1000 + i, noisy if i % 50 == 1 else clean, f"h{i % 8}") for i in range(4000)]
    got = {r.doc_id: r for r in host_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[1].host_rejected and got[1].soft_failed and not got[1].kept and got[2].kept
    assert not got[1001].host_rejected and got[1001].soft_failed and got[1001].kept
    assert {d for d, r in got.items() if r.host_rejected} == set(range(400))


def test_host_rules_are_native(spark, odd):
    plan = host_rules.with_rules(host_rules.document_features(odd.select("doc_id", "source", "text")))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pretokens_match_the_pattern():
    regex = pytest.importorskip("regex")
    import pyarrow as pa

    from tabstrata.llm import textarrays

    pattern, rng = regex.compile(pretokens.PATTERN), random.Random(3)
    letters = "ab'srevlt m d\n\t 12,.!é　\u0085漢🙂"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(4000)] + ["", None, "don'todo", "''s", " 's", "\n's", "'", "x'll've"]
    data, offsets = textarrays.buffer(textarrays.filled(pa.array(texts)))
    start, end, at = pretokens.pretokens(data, offsets)
    raw = data.tobytes()
    for i, t in enumerate(texts):
        assert [raw[a:b].decode() for a, b in zip(start[at[i] : at[i + 1]], end[at[i] : at[i + 1]])] == pattern.findall(t or "")


def test_token_counts_equal_the_library(spark, odd, monkeypatch):
    path = token_counts.default_tokenizer()
    library = token_counts.library(path)
    key = lambda r: str(r)
    got = sorted([tuple(r) for r in token_counts.count_tokens(odd, path).collect()], key=key)
    want = sorted([(d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t, _ in ODD], key=key)
    assert got == want
    monkeypatch.setattr(token_counts, "RANGE_BYTES", 500)  # more ranges, same counts
    assert sorted([tuple(r) for r in token_counts.count_tokens(odd, path).collect()], key=key) == want
    whole = {r.doc_id: r for r in queries.op7_token_counts(spark, SF_SMALL).collect()}
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert (whole[r.doc_id].n_tokens, whole[r.doc_id].over_limit) == (n, n > 1024)
    with pytest.raises(ValueError):
        token_counts.library(path.replace("byte_bpe_50k", "word_bpe_49k"))


def _tiktoken():
    ranks = bpe.read_ranks(bpe.default_ranks())
    return tiktoken.Encoding("own", pat_str=pretokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken_and_round_trips(spark, odd):
    other, ranks = _tiktoken(), bpe.default_ranks()
    encoded = bpe.encode(odd, ranks)
    rows = encoded.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        text = r.row.text or ""
        assert r.ids == other.encode_ordinary(text)
        spans = list(zip(r.char_start, r.char_end))
        assert all(0 <= a < b <= len(text) for a, b in spans) and (not text or (spans[0][0] == 0 and spans[-1][1] == len(text)))
        for (a, b), i in zip(spans, r.ids):  # a token's bytes lie within its characters
            assert other.decode_single_token_bytes(i) in text[a:b].encode()
    decoded = bpe.decode(encoded, ranks).collect()
    assert sorted(r.decoded for r in decoded) == sorted(t or "" for _, t, _ in ODD)
    split = spark.createDataFrame([([r.ids[0]], 1) for r in rows if r.ids], "ids array<int>, k int").select(F.struct("k").alias("row"), "ids")
    assert bpe.decode(split, ranks).count() > 0
    digests = {r.doc_id: r for r in queries.op9_bpe(spark, SF_SMALL).collect()}
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        ids = other.encode_ordinary(r.text or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
        got = digests[r.doc_id]
        assert (got.n_tokens, got.ids_sha256, got.decoded_sha256) == want and got.same_text
    done = {(r.row.doc_id, r.row.text): r for r in bpe.round_trip(odd, ranks).collect()}
    for r in rows:  # the registered run's spans are those of ``encode``
        spans = np.array(list(zip(r.char_start, r.char_end)), "<i4")
        assert done[r.row.doc_id, r.row.text].spans_sha256 == hashlib.sha256(spans.tobytes()).hexdigest()


def test_bpe_random_strings_equal_tiktoken():
    import pyarrow as pa

    from tabstrata.llm import textarrays

    other, coder, rng = _tiktoken(), bpe.codec(bpe.default_ranks()), random.Random(5)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for letters in ("ab", "a ", "aé", "!?*#-=", "0123456789", "the and'sé漢🙂 \n") for _ in range(500)]
    data, offsets = textarrays.buffer(textarrays.filled(pa.array(texts)))
    ids, at = coder.encode(data, offsets)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [other.encode_ordinary(t) for t in texts]
    assert coder.spelled(ids).tobytes() == data.tobytes()


TURNS = [
    (1, 0, "system", "be # brief </turn>\n### user: x"), (1, 1, "user", "hi \\ there"), (1, 2, "assistant", "one\\"), (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "assistant", "long " * 300),
    (1, 6, "user", "tail"), (2, 0, "user", "same"), (2, 0, "user", "same"), (2, 1, None, "no: role"), (None, 3, "assistant", "null id"), (3, None, "assistant", "null turn"), (3, 1, "assis:tant", ": x"),
]


@pytest.mark.parametrize("budget,history", [(64, 16), (64, 0), (10_000, 256)])
def test_chat_windows_round_trip(spark, odd, budget, history):
    turns = spark.createDataFrame([(*t, 1) for t in TURNS], "conv_id long, turn long, role string, text string, window int")
    windows = chat_windows.format_windows(turns, bpe.default_ranks(), budget, history)
    rows = sorted(windows.collect(), key=lambda w: (str(w.conv_id), w.window))
    said = collections.defaultdict(list)
    for w in rows:
        turns_of = chat_windows.parse(w.text)
        said[w.conv_id] += turns_of[w.n_repeated :]
        assert w.n_tokens <= budget or len(turns_of) - w.n_repeated == 1  # only a single long turn goes over
        if w.conv_id == 1 and w.window:
            assert turns_of[0][0] == "system" and w.n_repeated >= 1
    order = lambda t: (t[0] is not None, t[0] or 0, t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")
    want = collections.defaultdict(list)
    for c, _, role, text in sorted(TURNS, key=order):
        want[c].append((role or "", text or ""))
    assert said == want
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in chat_windows.read_back(windows).collect():
        target = "".join(t for role, t in want[r.conv_id] if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(want[r.conv_id]), digest("".join(f"{a}\n{b}\n" for a, b in want[r.conv_id])))
        assert (r.loss_chars, r.loss_sha256) == (len(target), digest(target))
        assert r.formatted_chars == sum(len(w.text) for w in rows if w.conv_id == r.conv_id)


def test_chat_roles_with_colons_read_back():
    turns = [(r, t) for r in ("a: b", "a\\: b", "a\\", ": ", "\\\\: :", "", "### x: </turn>\n", "u\n: ") for t in ("x: y", "", ": \\", "</turn>\n### a: b")]
    assert chat_windows.parse("".join(chat_windows.render(r, t)[0] for r, t in turns)) == turns


def test_chat_query_has_the_control_conversation(spark, odd):
    got = {r.conv_id: r for r in queries.op6_chat_windows(spark, SF_SMALL).collect()}
    text = "\\### Assistant: </turn> ok"
    assert got[-7].loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and got[-7].n_turns == 2
    assert len(got) == 1 + spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id").distinct().count()


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    assert line_dedup.drop_shared_lines(none).count() == 0
    assert host_rules.judge(none).count() == 0 and host_rules.filter_documents(none).count() == 0
    assert token_counts.count_tokens(none, token_counts.default_tokenizer()).count() == 0
    assert bpe.decode(bpe.encode(none, bpe.default_ranks()), bpe.default_ranks()).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_windows.read_back(chat_windows.format_windows(turns, bpe.default_ranks())).count() == 0
