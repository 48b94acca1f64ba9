"""From documents to packed training sequences, as stages that each write their result.

``STAGES`` lists (name, function); a function takes (spark, docs, folder of the tables) and
returns what the next stage works on. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventmart.llm import mixing, near_duplicates, packing, secrets, site_quality
from eventmart.llm.shared import ready, table
from eventmart.session import scratch, work_dir


# Words of a shingle; the query of near duplicates is bound to four, the pipeline is not.
SHINGLE = 5


def keep_good_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier keeps; it learns from those that have a label."""
    labels = table(spark, folder, "labels", "doc_id", "quality")
    return site_quality.keep_good(docs, site_quality.fit(docs, labels))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ready(spark)
    return near_duplicates.keep_first(docs, size=SHINGLE)


def mask_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with secrets masked."""
    ready(spark)
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """A row per epoch of each document that the mix takes; one per source may be cut short."""
    ready(spark)
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of every row: their token ids, and their places in sequences."""
    ready(spark)
    return packing.pack(docs)


STAGES = [
    ("quality", keep_good_documents),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again as the next one's input."""
    docs = ready(spark).read.parquet(f"{folder}/documents.parquet")
    out = work_dir(spark)
    for name, stage in STAGES:
        with scratch(spark):
            stage(spark, docs, folder).write.parquet(f"{out}/{name}")
        docs = spark.read.parquet(f"{out}/{name}")
    return docs


# No SQL for training a classifier, MinHash or tokenizing; tests compare with brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
