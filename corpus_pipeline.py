"""Corpus cleaning in stages, each of which reads what the one before it wrote.

Toxic documents go; lines that ten documents share go from the others; of each group of near
copies (Jaccard similarity 0.8 and more over five-word shingles, linked by SimHash and where its
links end by an exact join) one document stays; documents that hold ten
words of a benchmark item in a row go; the rest is encoded.

Null and empty texts pass as they are. All stages but the last return the columns of their input.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltcomb.llm import byte_bpe, decontaminate, line_dedup, near_copies, toxicity
from siltcomb.llm._runtime import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fits on the labelled documents of this stage's input, then leaves out what scores 0.5 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    return toxicity.reject(docs, toxicity.fit(docs, learn))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(docs, min_docs=10, min_chars=1).drop("n_lines", "n_dropped")
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # texts without words are nobody's copies
    empty = ~F.coalesce(F.col("text").rlike(r"[^ \t\n\x0B\f\r]"), F.lit(False))
    return near_copies.keep_one(docs.where(~empty)).unionByName(docs.where(empty))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.round_trip_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_shared_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte-level BPE", encode),
]

#: Learned scores and SimHash can't be put in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    where = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{where}/{i}")
            docs = spark.read.parquet(f"{where}/{i}")
    return docs
