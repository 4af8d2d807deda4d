"""From raw documents to token ids: each stage works on all that the one before kept.

1. toxicity: documents at or above the threshold of their language go.
2. exact_dedup: of equal texts the smallest identifier stays.
3. near_dedup: of documents linked by five-word shingles (0.75 or more) one stays.
4. mixing: documents are repeated or left out so that sources meet their targets.
5. byte_bpe: texts are encoded, decoded again and described by their digests.

Each stage is given as a function (spark, docs, sf_dir); all but the last keep
the columns of documents. ``run`` writes each stage's rows below
``spark.checkpoint.dir`` and reads them again, so that no stage repeats
another's work and a lost executor costs one stage's tasks at most.

Nulls, empty texts, ties, repeated rows and further columns are handled as the
docstrings of the five operators say; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerleaf.llm.byte_bpe import token_digests
from ledgerleaf.llm.exact_dedup import drop_copies
from ledgerleaf.llm.jaccard_join import drop_near_copies
from ledgerleaf.llm.source_mixing import mix_sources
from ledgerleaf.llm.toxicity import drop_toxic
from ledgerleaf.scratch import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_digests(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("byte_bpe", byte_bpe),
]

#: The classifier is trained, which SQL cannot say; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
