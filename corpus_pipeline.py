"""From raw documents to packed training sequences, in stages.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame that is
written and read again as the next one's docs. All but the last return the columns of
documents; the last returns the pieces with their places in the sequences.

Any column may be null, and there may be more columns, of any name; they are passed on.
Rows that repeat are judged one by one, but for the near-duplicate stage. An empty table
passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.llm import mixing, nbsvm, near_dups, packing, queries, weak_rules
from driftwell.llm.text import stored, unused


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts.

    A null text is scored as an empty one; labels are read by id, so rows without an id
    teach nothing and are scored like others.
    """
    score = unused(docs, "score")
    scored = nbsvm.with_score(docs, queries.quality_model(docs, sf_dir), out=score)
    return scored.where(F.col(score) >= queries.ACCEPT).drop(score)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep; null, empty and very short texts go."""
    return weak_rules.apply_rules(docs, carry=True).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest id's. Rows without words
    stay, but of rows that repeat id and text one does."""
    return near_dups.drop_near_duplicates(docs, 0.8)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them, a null source being a
    source. Rows without words go."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences; a null text is its end mark alone."""
    tokenizer = queries.tokenizer_path("word_bpe_49k.json")
    return packing.pack(packing.tokenized_pieces(docs, tokenizer, False, True, 1))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("pack", pack),
]

#: A fitted classifier, hashed draws and a packing have no SQL; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
