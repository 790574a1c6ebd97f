"""From raw documents to packed training sequences: stages over the documents table.

Each stage reads what its predecessor kept. Stages before the last return the columns of
``documents``; the last one returns the pieces of the packed sequences. They decide row by row: a
row that shares its doc_id with others, or has none, stays or goes for its own text. Empty tables
give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import byte_convnet, content_sort, ngram_join, packing, positional_index
from daybook.llm.registry import vocabulary
from daybook.llm.tables import bounded, stored, table


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier rejects go; a null text is scored as an empty one."""
    return byte_convnet.keep_good(docs, table(spark, folder, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of equal texts stays: the longest, then the smallest id, null last."""
    bounded(spark)
    return content_sort.keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id; blank texts stay."""
    bounded(spark)
    return ngram_join.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a passage of the benchmark go; null and empty texts have none."""
    return positional_index.keep_clean(docs, table(spark, folder, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of the training sequences; rows that share an id are documents of their own."""
    bounded(spark)
    return packing.pieces(docs, vocabulary())


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)


#: The classifier, the components and the packing cannot be stated in SQL; see tests/llm.
ORACLE_SQL = None
