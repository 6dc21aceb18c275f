"""Registered queries of the operators over the ``documents`` table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (crf_quality, decontaminate, exact_dedup, fill_in_middle, katz_lm, merkle, mixing, near_dup, oracle, pii,
               quality_rules, ring_shards, substring_dup, token_files)
from ._columns import crc32_of
from ._scratch import settle

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(crc32_of("doc_id") % 4 != 2)
    scored = crf_quality.score(docs, crf_quality.train(docs, labels))
    return scored.select("doc_id", (crc32_of("doc_id") % 4 == 2).alias("held_out"), "score",
                         (F.col("score") >= crf_quality.THRESHOLD).cast("int").alias("predicted"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return found.select("doc_id", *(pii.count_of(k).alias(f"n_{k}") for k in pii.BASE),
                        F.sha2(pii.digest(pii.base_spans()).cast("binary"), 256).alias("base_sha256"),
                        pii.digest(F.col("pii")).alias("spans"),
                        F.transform("pii", lambda s: s["score"]).alias("scores"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "llm", "tokens")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_tokens(spark, folder)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"), carry=False)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        decontaminate.items_digest("items").alias("items_sha256"), "contaminated")


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_substring_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = substring_dup.remove_repeats(_table(spark, sf_dir, "documents"))
    return rest.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    judged = quality_rules.judge(settle(quality_rules.measure(docs).drop("text"), "measured"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op9_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = katz_lm.score(_table(spark, sf_dir, "documents"), "crc32(cast(cast(doc_id as string) as binary)) % 7 <> 2", katz_lm.ORDER)
    return scored.select("doc_id", (crc32_of("doc_id") % 7 == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op10_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return (ring_shards.ring_shards(docs, 40, carry=False)
            .select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard")))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    changed = [F.col("n_chars") + 1 if f == "n_chars" else F.col(f) for f in merkle.FIELDS]
    tampered = F.when((crc32_of("doc_id") % 7 == 0) & F.col("n_chars").isNotNull(), merkle.leaf(*changed))
    rows = merkle.manifest(docs, extra={"tampered": tampered})
    rows = rows.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(_table(spark, sf_dir, "documents"), carry=False)
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return (fill_in_middle.restore(made.select("*", digest("output")))
            .select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", digest("restored")))


QUERIES: dict[str, Query] = {
    "op1_crf_quality": op1_crf_quality,
    "op2_pii": op2_pii,
    "op3_token_files": op3_token_files,
    "op4_mixing": op4_mixing,
    "op5_decontaminate": op5_decontaminate,
    "op6_near_dup": op6_near_dup,
    "op7_substring_dup": op7_substring_dup,
    "op8_quality_rules": op8_quality_rules,
    "op9_katz_lm": op9_katz_lm,
    "op10_ring_shards": op10_ring_shards,
    "op11_merkle": op11_merkle,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_fill_in_middle": op13_fill_in_middle,
}

#: DuckDB statements of the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op11_merkle": oracle.OP11_MERKLE,
    "op12_exact_dedup": oracle.OP12_EXACT_DEDUP,
    "op13_fill_in_middle": oracle.OP13_FILL_IN_MIDDLE,
}
