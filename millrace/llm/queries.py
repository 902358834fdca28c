"""Queries over the operators of this subpackage, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, chat, decontam, importance, licenses, merkle, pii, quality, sharding, simhash, substring, suffix, tokens
from millrace.llm.oracle import ORACLE_SQL  # noqa: F401


#: The text of both turns of the added conversation -7.
PROBE = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 shards whose row counts differ by one at most and which all match the mixture of sources."""
    found = sharding.shard(sharding.measured(table(spark, sf_dir, "documents")), 40)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and template labels of every document."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    found = pii.find(table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [of(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, whole or edited, with the alignment's score and place."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the formatted windows of every conversation hold, read back from them."""
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    read = chat.read_back(chat.windows(turns))
    told = read.select(
        "conv_id", "window", "chars", F.size("turns").cast("long").alias("n"), F.array_join("learned", "").alias("learned"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("told"),
    )
    whole = told.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.array_sort(F.collect_list(F.struct("window", "told", "learned"))).alias("w"))
    joined = lambda field: F.array_join(F.transform("w", lambda x: x[field]), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(joined("told"), 256).alias("turns_sha256"), F.length(joined("learned")).cast("long").alias("loss_chars"),
        F.sha2(joined("learned"), 256).alias("loss_sha256"), "formatted_chars",
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps without repeated 50-word windows."""
    found = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality.quality_report(table(spark, sf_dir, "documents")).drop("rejected_by")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps without 100-byte strings that start earlier."""
    found = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the bytes decoded from them."""
    import public_tokenizers

    found = bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn towards the benchmark's distribution of words and pairs of words."""
    found = importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, checked against rows a third of which are tampered with."""
    found = merkle.manifest(table(spark, sf_dir, "documents"), merkle.tampered(F.col("doc_id"), F.col("text")))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    import public_tokenizers

    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {
    "op1_simhash": op1_simhash, "op2_sharding": op2_sharding, "op3_license_scan": op3_license_scan, "op4_pii": op4_pii, "op5_decontamination": op5_decontamination,
    "op6_chat_windows": op6_chat_windows, "op7_substring_dedup": op7_substring_dedup, "op8_quality_rules": op8_quality_rules, "op9_suffix_dedup": op9_suffix_dedup, "op10_byte_bpe": op10_byte_bpe,
    "op11_importance_resampling": op11_importance_resampling, "op12_merkle_manifest": op12_merkle_manifest, "op13_token_counts": op13_token_counts,
}
