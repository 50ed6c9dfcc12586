"""One registered query per operator, over its whole table, and SQL where SQL can give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import cells, circulant, class_lm, doubling, ftrl, host_rules, line_store, mixing, multi_search, oracles, packing, part_codes, prefix_trie, url_ratio
from jobtide.llm.common import read

VOCABULARY = "word_bpe_49k.json"


def pack_rules() -> packing.PackRules:
    import public_tokenizers

    return packing.PackRules(vocabulary=public_tokenizers.path(VOCABULARY))


def op1_url_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_ratio.judge_urls(read(spark, sf_dir, "pages"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents"), pack_rules())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) == 0
    return class_lm.score_documents(read(spark, sf_dir, "documents"), held)


def op4_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant.near_duplicates(read(spark, sf_dir, "documents"), circulant.ShingleRules(words=2))


def op5_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = doubling.without_repeats(read(spark, sf_dir, "documents"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"])
    return cut.select(
        "doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_embedding_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.near_duplicates(read(spark, sf_dir, "embeddings"))


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(read(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = ftrl.FtrlRules()
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = ftrl.score(docs, ftrl.train(docs, read(spark, sf_dir, "labels"), rules), rules)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(rules.folds)) == 0
    return scored.select(
        "doc_id",
        F.coalesce(held, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= rules.threshold).cast("int").alias("predicted"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_store.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_nodes(read(spark, sf_dir, "conversations"))


def op12_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = part_codes.compress(read(spark, sf_dir, "embeddings"))
    rows = part_codes.with_label_errors(coded).withColumn("codebooks_sha256", F.lit(part_codes.book_digest(books)))
    return rows.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_multi_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = multi_search.passages(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_ratio, op2_packing, op3_class_lm, op4_circulant_minhash, op5_prefix_doubling, op6_embedding_cells, op7_host_rules,
        op8_quality_classifier, op9_line_dedup, op10_mixing, op11_prefix_trie, op12_part_codes, op13_multi_search,
    )
}

ORACLES: dict[str, str] = {
    "op4_circulant_minhash": oracles.NEAR_DOCUMENTS,
    "op6_embedding_cells": oracles.NEAR_VECTORS,
    "op7_host_rules": oracles.HOST_RULES,
    "op9_line_dedup": oracles.LINE_DEDUP,
    "op10_mixing": oracles.MIXING,
    "op11_prefix_trie": oracles.PREFIX_TRIE,
    "op12_part_codes": oracles.PART_CODES,
    "op13_multi_search": oracles.MULTI_SEARCH,
}
