"""The corpus pipeline: documents -> packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.llm import line_dedup, mixing, packing, quality, simhash
from ordermart.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that fail a rule or leave their band go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: boilerplate lines go; the length column follows."""
    return _with_length(line_dedup.drop_boilerplate(docs, "source"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one document of each group stays, the smallest id."""
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the spans that the mix takes, repeats included."""
    return _with_length(mixing.mix(docs))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: the pieces of the packed sequences, with their ids."""
    return packing.pack(docs)


def _with_length(docs: DataFrame) -> DataFrame:
    """n_chars follows the text that is left."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_lines),
    ("simhash near-dedup", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_documents),
]

#: language-model scores and random draws are not SQL; tests/llm hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
