"""A training corpus from ``documents``: rules, near-duplicates, benchmark, mix, token files.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns
of ``documents``.  ``run`` writes every stage's result as Parquet in the shared
folder and reads it again as the next one's input.

* ``quality_rules``: documents that break a rule go.
* ``near_dup``: of each component of near-duplicates the smallest id stays.
* ``decontaminate``: documents with a benchmark passage go.
* ``mixing``: each document comes as often as the mix takes it.
* ``token_files``: the corpus as token files, read back as one row a copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstream.llm import decontaminate, mixing, near_dup, quality_rules, token_files
from sensorstream.llm._columns import packed, unpacked
from sensorstream.llm._scratch import bounded, settle
from sensorstream.session import scratch_path


def by_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed and the adaptive rules keep."""
    needed = "doc_id", "lang", "source", "text"
    return unpacked(quality_rules.quality_rules(packed(docs, *needed)).where("kept"), docs.columns, *needed)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component; rows without an id stay."""
    gone = near_dup.near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(bounded(settle(gone, "duplicates")), "doc_id", "left_anti").select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=True)
    return found.where("NOT contaminated").select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents so that each source meets its target."""
    needed = "doc_id", "source", "text"
    return unpacked(mixing.take(mixing.mix(packed(docs, *needed))), docs.columns, *needed)


def to_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every copy, from the files."""
    import public_tokenizers

    folder = scratch_path(spark, "llm", "tokens")
    token_files.write_tokens(docs, folder, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_tokens(spark, folder)


STAGES = [
    ("quality_rules", by_quality_rules),
    ("near_dup", without_near_duplicates),
    ("decontaminate", without_benchmark),
    ("mixing", mixed),
    ("token_files", to_token_files),
]

#: Token ids and hash minima have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
