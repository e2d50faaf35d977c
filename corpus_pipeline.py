"""A corpus through five operators: good documents, without boilerplate, near copies and repeats, packed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read
again as the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kindred.llm import line_dedup, packing, quality, simhash, suffix_dedup
from kindred.llm._common import Workspace, give_back
from kindred.llm.queries import table, tokenizer_file


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier doesn't reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without the lines that too many documents of their source have."""
    return line_dedup.drop_boilerplate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    give_back(spark)
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without passages of 100 bytes or more that stand earlier already."""
    give_back(spark)
    return suffix_dedup.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    give_back(spark)
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken"))


STAGES = [("quality classifier", keep_good), ("line dedup", drop_boilerplate), ("simhash near-dedup", drop_near_copies), ("suffix-array dedup", cut_repeats), ("packing", pack)]

#: Tokenisation and the learned classifier have no SQL. Tests hold near and line dedup against brute force
#: as stages, suffix dedup and packing as operators, the classifier by the share of good rows it keeps.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder first."""
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = ws.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
