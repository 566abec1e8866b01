"""The corpus pipeline: five stages over ``documents``, each written and read again.

Toxic documents go; one document of each near-duplicate group stays; documents that hold a
benchmark item go; secrets are cut out of the texts; the last stage encodes what is left as
sampled SentencePiece segmentations.

Defined cases: rows are judged one by one, by their text, whatever their ids (null, repeated); a
null, empty or blank text is neither toxic nor a duplicate nor a leak, so such rows stay, and are
encoded as the empty sequence; of rows equal in id and text one stays; columns beside those of
``documents`` pass the first four stages as they are; without labels nothing is toxic, without a
benchmark nothing leaks; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from walletweave.llm import decontaminate, neardup, pieces, secrets, toxicity
from walletweave.llm.common import stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_representatives(docs, shingle=5, threshold=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.sample_encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("sentencepiece", encode),
]

#: No SQL: the classifier, the lattice sampling and the edit search are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
