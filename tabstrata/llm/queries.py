"""The registered queries of this subpackage: one per operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabstrata.llm import bpe, chat_windows, decontaminate, host_rules, line_dedup, lm_scoring, merkle, near_dup, periodic, pii, token_counts, toxicity, warc
from tabstrata.session import scratch_path, table


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document: the least id of its class."""
    return near_dup.with_classes(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    folder = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), folder, min_bytes=0)
    records = warc.read_archive(spark, folder, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_to_page").alias("refers_to"))


def op6_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one full of control strings, formatted, written and read back."""
    said = "\\### Assistant: </turn> ok"
    odd = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    path = scratch_path(spark, "chat-windows")
    chat_windows.format_windows(turns, bpe.default_ranks()).write.parquet(path)
    return chat_windows.read_back(spark.read.parquet(path))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every text."""
    out = token_counts.count_tokens(table(spark, sf_dir, "documents"), token_counts.default_tokenizer())
    return out.withColumn("over_limit", F.col("n_tokens") > 1024)


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word and line rules of every document and its host's verdict."""
    out = host_rules.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's closeness to the documents labelled as good."""
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return lm_scoring.score(table(spark, sf_dir, "documents"), good)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of the held-out quarter of the ids are not learnt from."""
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic", ~held_out)
    out = toxicity.score(docs, machine, keep=["doc_id"]).select("row.doc_id", "score")
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least 10 documents share."""
    out = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents"), digest=True, min_docs=10, min_chars=1)
    return out.select("row.doc_id", "n_lines", "n_dropped", "kept_sha256")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text to ids and back."""
    done = bpe.round_trip(table(spark, sf_dir, "documents"), bpe.default_ranks(), keep=["doc_id"])
    return done.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256", "same_text")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) with a similar window."""
    marked = decontaminate.mark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    found = marked.select("row.doc_id", F.explode("leaks").alias("leak"))
    return found.select("doc_id", "leak.item_id", F.round("leak.similarity", 6).alias("similarity"), "leak.first_word", "leak.n_words")


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every text: the exact patterns' matches and the field's further spans."""
    field = pii.train(pii.examples(spark))
    out = pii.find(table(spark, sf_dir, "documents"), field, keep=["doc_id"])
    return out.select("row.doc_id", *(f"n_{k}" for k in pii.KINDS), "base_sha256", "spans")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every text; a tenth of the texts (by the crc32 of their id) end in repeats made from their own words."""
    h = F.crc32(F.col("doc_id").cast("string"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.floor(h / 10).cast("long").alias("g"), F.coalesce(h % 10 == 0, F.lit(False)).alias("chosen"))
    docs = docs.withColumn("w", F.when(F.col("chosen"), F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)")))).withColumn("n", F.size("w"))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    docs = docs.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    ended = F.expr("array_join(concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), cast((n - a + p - 1) div p as int))), 1, n - a)), ' ')")
    made = docs.select("doc_id", F.when(F.col("chosen") & (F.col("n") > 0), ended).otherwise(F.col("text")).alias("text"))
    return periodic.periodic_runs(made, keep=["doc_id"], spans=False).select("row.doc_id", *periodic.RUN)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and root of every document; a fifth of the proofs (by the crc32 of the id) are tried on a lower-cased text."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    out = merkle.manifest(table(spark, sf_dir, "documents"), {"text": lowered}, chosen)
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {f.__name__: f for f in (op1_lm_scoring, op2_toxicity, op3_line_dedup, op4_near_dup, op5_warc, op6_chat_windows, op7_token_counts, op8_host_rules, op9_bpe, op10_decontamination, op11_pii, op12_periodic_runs, op13_merkle_manifest)}
