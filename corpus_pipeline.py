"""The training-data pipeline over documents: five stages, each an operator, each on all that the one before kept.

run() applies them in turn; what a stage returns is written to the shared folder
and reread as the next one's documents.

Defined cases, beside those of the operators: rows with nulls in any column go
through every stage whose decision does not rest on the null (a null or empty text
fails the quality rules, is a near-duplicate of other empty texts, holds no benchmark
item, is never mixed in, and is put into a shard); repeated rows are near-duplicates of
each other, of which one stays, with the least known doc_id; an empty table gives an
empty table; other columns, whatever their names, are returned as they came.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillspark.llm.common import saved, table
from quillspark.llm.decontaminate import clean_documents
from quillspark.llm.mixing import mixed_documents
from quillspark.llm.quality import passing
from quillspark.llm.sharding import sharded
from quillspark.llm.simhash import one_of_each
from quillspark.llm.similar import digests, similar_documents

SHARDS = 8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject."""
    return passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8 or more): that with the least doc_id."""
    return one_of_each(docs, similar_documents, digests)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of sources: a row for each time a document is taken, with the words taken."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard, 0 to 7."""
    return sharded(docs, SHARDS)


STAGES = [("quality", quality), ("near duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]

#: The stages need hashes and draws that SQL does not have; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = saved(docs, name.replace(" ", "-"))
    return docs
