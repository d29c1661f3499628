"""From raw documents to token ids: quality rules, near copies, benchmark passages, secrets, byte-level BPE.

Every stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of ``documents``.  The first three remove documents; the fourth
keeps all and replaces secrets in their texts; the last gives the token ids.  Empty tables pass through all stages; what
a stage does with nulls, repeated rows and long texts is said by its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wheelhouse.llm import bpe, decontamination, lsh_forest, quality, secret_scan
from wheelhouse.llm.scratch import written
from wheelhouse.session import tune

#: SQL cannot express byte-pair merges; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the default policy keeps."""
    return quality.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by five-word shingles and a similarity of 0.8."""
    return lsh_forest.without_copies(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced."""
    return secret_scan.without_secrets(docs)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit), their number and digest, and the digest of what they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(docs, path, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("token_bytes") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_bytes", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "token_bytes",
    )


STAGES = [
    ("quality rules", quality_rules),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("byte-level bpe", byte_level_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = written(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
