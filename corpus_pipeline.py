"""From raw documents to piece ids: five stages, each written as Parquet and read again by the next.

1. documents that the language model finds unlike trusted text go,
2. one document of each group of near duplicates stays (five words, similarity 0.8),
3. documents with a passage of a benchmark go,
4. personal data is replaced by its kind,
5. the texts are encoded, with distinct sampled segmentations.

Defined results: null and empty texts pass all stages as they are, each row for itself, and have
one empty segmentation; rows that repeat, with their id or without, and texts that are equal or
nearly so, leave one row, that of the smallest doc_id; texts that only share a doc_id both stay;
rows without doc_id stay. Without labels no document is rejected, without benchmark items none is
contaminated, an empty table of documents gives no rows. Extra columns of documents are kept
up to the last stage.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import decontaminate, language_model, near_duplicates, personal_data, segmentations
from starloom.llm.queries import table
from starloom.session import shared_dir
from starloom.sinks import files


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_model.accepted(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.deduplicated(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return personal_data.redact(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return segmentations.encode(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_uncontaminated),
    ("personal_data", mask_personal_data),
    ("encoding", encode_pieces),
]

#: Trained models and sampling are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each returns is in the shared folder until the next one is written."""
    folder, before = f"{shared_dir(spark)}/pipeline-{uuid4().hex}", None
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            files.remove(spark, f"{folder}/{before}")
        before = name
    return docs
