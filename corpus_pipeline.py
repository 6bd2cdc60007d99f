"""A corpus pipeline over the documents table.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame that is written as Parquet and reread as the next one's
``docs``.  Toxic texts go, then exact copies, then all but one of each component of
near copies; the rest is mixed to the sources' target weights and packed.  All
stages but the last return the columns of documents.  In the mix a text appears
once for each pass that took words of it, so ids may repeat from there on.

Cases (nulls, empty texts, ties, repeated rows, empty tables, other columns) are
those of the operators; a text without words is in no mix.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quality_lake.llm.common import table
from quality_lake.llm.exact_dedup import exact_dedup
from quality_lake.llm.mixing import mixed_documents
from quality_lake.llm.ngram_join import one_of_each
from quality_lake.llm.packing import pack
from quality_lake.llm.toxicity import without_toxic
from quality_lake.sources import stage


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Shingle similarity, multinomial draws and tokenizers are beyond SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what is between them is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
