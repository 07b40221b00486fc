"""A training corpus from raw documents: quality, near-duplicates, benchmark leaks, personal data, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkcohort.llm.bpe import encode_documents
from linkcohort.llm.common import cut
from linkcohort.llm.decontaminate import remove_contaminated
from linkcohort.llm.neardup import drop_near_duplicates
from linkcohort.llm.pii import redact
from linkcohort.llm.quality import keep_good
from linkcohort.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; those without any words are rejected."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words, a similarity of 0.8 or more."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    return redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids of all documents."""
    return encode_documents(docs, vocabulary(), outputs=("ids",))


STAGES = [
    ("quality", quality),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("personal_data", mask_personal_data),
    ("tokens", encode),
]

# The classifier's model and the tokens are beyond SQL; the README says what of the stages is tested.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents, each written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
