"""Quality rules with host verdicts, in DataFrame functions only.

Each document gets rule counts from its words and lines. Failures of any rule,
base or soft (share of symbols, share of repeated lines, length of words), are
aggregated by host; a host's failure rate is shrunk towards all hosts' rate
with a beta prior fitted to the hosts by moments. A host is rejected where its
rate is surely above the common one: the posterior mean less ``SURE`` standard
deviations is above ``EXCESS`` times the pooled rate. Documents that fail a soft
rule are dropped only on rejected hosts, so clean documents stay whatever their
host. Documents that fail a base rule are always dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabstrata.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
#: Soft rules: most symbols per word, most repeated lines per line, least and most code points per word.
MAX_SYMBOLS, MAX_DUP_LINES, MIN_WORD, MAX_WORD = 0.1, 0.3, 3.0, 10.0
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Times the pooled failure rate that a rejected host's rate is above, and the standard deviations of its posterior that must clear it.
EXCESS, SURE = 1.5, 3.0


def _repeat_words(ordered: Column) -> Column:
    """Words inside 3-word windows that occur twice or more; ``ordered``: (hash, position) of the windows, sorted."""
    same = lambda i, j: F.get(ordered, i)["h"].eqNullSafe(F.get(ordered, j)["h"])
    hit = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), lambda i: same(i - 1, i) | same(i + 1, i))
    covered = F.flatten(F.transform(hit, lambda i: F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda k: F.get(ordered, i)["p"] + k)))
    return F.size(F.array_distinct(covered)).cast("long")


def document_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text but with n_words, word_chars, n_symbols, n_dup_lines, n_lines and n_repeat_words.

    A null text has no words and no lines with words; all counts are over the
    whole text. Windows are compared by 64-bit hashes within one text.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    keep = [c for c in docs.columns if c != text]
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(WORD))
    base = docs.select(
        *keep,
        F.regexp_extract_all(whole, F.lit(f"({WORD})"), F.lit(1)).alias("_words"),
        (F.size(F.split(whole, r"[#*$%&|<>]", -1)) - 1).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
    )
    # explode of one-element arrays keeps the arrays as columns, so that lambdas don't compute them anew for each element
    base = base.select(*keep, "n_symbols", F.explode(F.array(F.struct("_words", "_lines"))).alias("_a"))
    base = base.select(*keep, "n_symbols", F.col("_a._words").alias("_words"), F.col("_a._lines").alias("_lines"))
    grams = F.when(
        F.size("_words") >= 3,
        F.transform(F.sequence(F.lit(0), F.size("_words") - 3), lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    counts = [
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.col("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    ]
    base = base.select(*keep, *counts, F.explode(F.array(grams)).alias("_g"))
    repeats = F.size(F.array_distinct("_g")) < F.size("_g")
    ordered = F.when(repeats, F.sort_array(F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("p")))))
    base = base.withColumn("_o", F.explode(F.array(ordered))).drop("_g")
    count = F.when(F.col("_o").isNull(), F.lit(0).cast("long")).otherwise(_repeat_words(F.col("_o")))
    return base.withColumn("n_repeat_words", count).drop("_o")


def soft_rules() -> Column:
    n = F.col("n_words")
    return (n > 0) & (
        (F.col("n_symbols") > MAX_SYMBOLS * n)
        | (F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines"))
        | (F.col("word_chars") < MIN_WORD * n)
        | (F.col("word_chars") > MAX_WORD * n)
    )


def with_rules(features: DataFrame) -> DataFrame:
    """Adds base_failed and soft_failed."""
    n = F.col("n_words")
    base = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    return features.withColumn("base_failed", base).withColumn("soft_failed", soft_rules())


def host_verdicts(rules: DataFrame, host: str, excess: float = EXCESS, sure: float = SURE) -> DataFrame:
    """One row per host: documents, failures, shrunk rate, its standard deviation, verdict. A null host is a host.

    The prior Beta(a, b) has the mean m and the variance v of the hosts' rates:
    a + b = m (1 - m) / v - 1, at least 1; hosts all alike give the largest
    weight, 1e6 documents.
    """
    spark = rules.sparkSession
    path = scratch_path(spark, "host-counts")  # written, so that the prior doesn't count anew
    rules.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("base_failed") | F.col("soft_failed")).cast("long")).alias("failed")).write.parquet(path)
    hosts = spark.read.parquet(path)
    rate = F.col("failed") / F.col("n")
    prior = hosts.agg((F.sum("failed") / F.sum("n")).alias("m"), F.var_pop(rate).alias("v"))
    weight = F.least(F.greatest(F.col("m") * (1 - F.col("m")) / F.greatest(F.col("v"), F.lit(1e-12)) - 1, F.lit(1.0)), F.lit(1e6))
    m, w = prior.select("m").scalar(), prior.select(weight).scalar()  # one row each
    rated = hosts.withColumn("rate", (F.col("failed") + m * w) / (F.col("n") + w))
    rated = rated.withColumn("sd", F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + w + 1)))
    return rated.withColumn("host_rejected", F.col("rate") - sure * F.col("sd") > excess * m)


def judge(docs: DataFrame, doc_id: str = "doc_id", host: str = "source", text: str = "text", excess: float = EXCESS, sure: float = SURE) -> DataFrame:
    """doc_id, the rule counts, base_failed, soft_failed, host_rate, host_rejected and kept of every row.

    The counts are computed once and written to the shared folder; the host
    table is joined back to them. An empty table gives no rows, repeated rows
    are judged one by one, a null text has no words, other columns of ``docs``
    are left out.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "host-rules")
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text"))
    with_rules(document_features(narrow)).write.parquet(path)
    rules = spark.read.parquet(path)
    hosts = host_verdicts(rules, "host", excess, sure).select(F.col("host").alias("_host"), F.col("rate").alias("host_rate"), "host_rejected")
    joined = rules.join(hosts, F.col("host").eqNullSafe(F.col("_host")), "left").drop("host", "_host")
    return joined.withColumn("kept", ~F.col("base_failed") & ~(F.col("soft_failed") & F.col("host_rejected")))


def filter_documents(docs: DataFrame, host: str = "source", text: str = "text", excess: float = EXCESS, sure: float = SURE) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns as they were.

    Only hosts' counts and verdicts are written; texts are read twice and,
    while the table of rejected hosts is small, never shuffled. The rows ride
    along as one struct, so columns of any name may be present; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(host).alias("host"), F.col(text).alias("text"))
    flags = with_rules(document_features(narrow)).select("host", "base_failed", "soft_failed")
    path = scratch_path(spark, "host-rejected")
    host_verdicts(flags, "host", excess, sure).filter("host_rejected").select(F.col("host").alias("_host"), F.lit(True).alias("_bad")).write.parquet(path)
    bad = spark.read.parquet(path)
    packed = docs.select(F.struct("*").alias("row"), F.col(host).alias("host"), F.col(text).alias("text"))
    marked = with_rules(document_features(packed)).filter(~F.col("base_failed")).select("row", "host", "soft_failed")
    joined = marked.join(bad, F.col("host").eqNullSafe(F.col("_host")), "left")
    return joined.filter(~F.col("soft_failed") | F.col("_bad").isNull()).select("row.*")
