"""Corpus pipeline: quality rules, language identification, near-duplicate removal, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that ``run`` writes as Parquet to the shared folder and
reads again as the next stage's documents. All but the last return the columns of documents.

Defined cases: null and empty texts fail the quality rules and go; rows with equal ids and texts are copies, of which
one stays; an empty table gives no rows in any stage; further columns are carried along unchanged up to packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import language, packing, pii, quality, resemblance
from tidemark.llm.common import Masked, table, written
from tidemark.llm.queries import byte_bpe_path

#: Least score of a language for a document to stay.
LANGUAGE_SCORE = 0.5
#: SQL can't express the stages: hash fingerprints and their components, learned models, packing.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that keep to all quality rules."""
    masked = Masked(docs)
    return masked.restore(quality.judged(masked.df, masked.df.columns, masked["text"]).where("kept"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned from the documents themselves."""
    model = language.learn(docs.where(~language.held_out(F.col("doc_id"))))
    masked = Masked(docs)
    found = language.identify(masked.df, model, masked.df.columns, masked["text"])
    return masked.restore(found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LANGUAGE_SCORE)))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies: by SimHash fingerprints, and what these leave apart by resemblance."""
    return resemblance.representatives(docs, shingle=5, distance=2)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by marks; ``n_chars`` follows the text."""
    return pii.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    return packing.pack(docs, ["doc_id"], byte_bpe_path(), end_id=2)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("dedup", dedup_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
