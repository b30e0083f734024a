"""A corpus made ready for training: toxic documents out, one document of each group of near
copies kept, live-looking secrets masked, the rest packed into sequences.

``STAGES`` are applied to ``documents`` in this order; each result is written as Parquet and
read back as the next stage's input.

All stages take nulls in any column, empty and very long texts, repeated rows and an empty table, and all but the
last return the columns of ``documents`` in their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from levyflow.llm.catalog import train_toxicity
from levyflow.llm.packing import pack
from levyflow.llm.secret_scan import mask_live
from levyflow.llm.shared import stored
from levyflow.llm.simhash import first_of_groups
from levyflow.llm.toxicity import drop_toxic


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. Each row is judged by its own text; null and empty texts and
    null ids stay."""
    return drop_toxic(docs, train_toxicity(spark, sf_dir))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near copies. Null and empty texts are copies of each other;
    rows with a null id stay, and rows that repeat an id go or stay together."""
    return first_of_groups(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with live-looking secrets masked. Repeated rows are masked alike; a null source is an owner of its
    own, and null texts stay null."""
    return mask_live(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences. A null or empty text is one piece of
    length 1, and repeated rows are packed each on its own."""
    return pack(docs)


STAGES = [
    ("toxicity", clean_language),
    ("simhash", one_of_each),
    ("secrets", without_secrets),
    ("packing", packed),
]

# SQL can express neither a trained classifier nor a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
