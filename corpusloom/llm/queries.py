"""Registered queries of the operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    byte_bpe, chat, decontaminate, feistel, maxscore, merkle, packing, periodic, quality, repair, simhash, suffixes, url_rules,
)
from corpusloom.session import stage_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op2_repair_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "token-files")
    repair.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return repair.read_digests(spark, path)


def op3_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = quality.judge_documents(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op5_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(packing.document_lengths(table(spark, sf_dir, "documents")))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    added = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role")
    ).withColumn("text", F.lit(text))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.format_conversations(turns.unionByName(added.withColumn("turn", F.col("turn").cast("long"))))
    read = formatted.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn(
        "loss", chat.loss_texts(F.col("formatted"), F.col("loss_spans"))
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss", "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge_urls(table(spark, sf_dir, "pages"), [*url_rules.SITES, *url_rules.PATTERNS])
    site = F.when(F.col("rule_rank") >= url_rules.SITE_RANK, F.col("rule"))
    return judged.select("page_id", "host", "path", site.alias("rule"), "verdict")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op10_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = feistel.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def planted_repeats(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` where, in a tenth of the documents by checksum of the id, words from some place on repeat."""
    n, hashed = F.size("words"), F.crc32(F.col("doc_id").cast("string").cast("binary"))
    part = F.call_function("div", hashed, F.lit(10))
    chosen = docs.select("doc_id", "text", hashed.alias("hashed"), F.when(hashed % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("words"))
    first = F.pmod(part, n)
    length = 1 + F.call_function("div", n - first, 3 + F.pmod(part, F.lit(8)))
    placed = chosen.withColumn("first", F.when(n > 0, first)).withColumn("length", F.when(n > 0, length))
    words = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", F.when(i < F.col("first"), i).otherwise(F.col("first") + F.pmod(i - F.col("first"), F.col("length"))).cast("int")))
    return placed.select("doc_id", F.when(F.col("length").isNotNull(), F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(planted_repeats(table(spark, sf_dir, "documents")))
    best = found.withColumn("best", periodic.longest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.call_function("div", 1000 * F.col("best.length"), F.col("best.period")).alias("exponent_milli"),
        F.sha2(periodic.run_lines(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampers = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(tampers, decontaminate.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    docs = table(spark, sf_dir, "documents")
    found = merkle.manifest(docs.withColumn("claimed", merkle.leaf({**{c: F.col(c) for c in merkle.FIELDS}, "text": text})), ["claimed"])
    folded = found.withColumn("folded_root", merkle.fold(F.col("claimed"), F.col("proof")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), "contaminated"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_repair_files": op2_repair_files,
    "op3_quality_trees": op3_quality_trees,
    "op4_maxscore": op4_maxscore,
    "op5_best_fit": op5_best_fit,
    "op6_simhash": op6_simhash,
    "op7_chat_format": op7_chat_format,
    "op8_url_rules": op8_url_rules,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_feistel_shards": op10_feistel_shards,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_decontaminate": op13_decontaminate,
}
