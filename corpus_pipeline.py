"""A training corpus out of `documents`: good documents, without repeated lines, near duplicates or benchmark
passages, mixed to the sources' target weights. Each stage gets what the one before kept, as a table.

The first four stages return the columns of documents; the last adds size, source_size, target and taken, how many
words of each document the mix takes, repeats counted. Rows with nulls follow the operators' docstrings.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from eocube.llm import decontaminate, lines, mixing, quality, simhash
from eocube.llm.common import table, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, takes for good. Null and empty texts are scored like any
    other; rows that repeat stay or go together; documents without a doc_id are scored as well. An empty table stays
    empty."""
    return quality.good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages of lines; documents of which nothing is left go. Null texts and rows without a
    doc_id stay as they are; of equal passages the one of the smallest doc_id stays. An empty table stays empty."""
    return lines.rewritten(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates. Null and empty texts are one group;
    documents without a doc_id stay; rows that repeat a doc_id stay or go together. An empty table stays empty."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item. Null and empty texts stay; rows that repeat stay or go together;
    a null doc_id is no reason to stay or go. An empty table stays empty, an empty benchmark removes nothing."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what the mix takes of each. Null and empty texts have size 0 and are taken 0 times; a null
    source is a source; every row, also one without a doc_id or that repeats, has its own share. An empty table stays
    empty."""
    return mixing.with_shares(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
]

#: Learned scores, fingerprints and content-defined chunks can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, os.fspath(sf_dir)))
    return docs
