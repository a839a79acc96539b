"""A corpus pipeline: five stages over `documents`, each calling one operator.

Every stage gets all rows that its predecessor kept and returns the columns of
`documents` (the last one: packed pieces). Between the stages the rows are
written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubeshelf.llm import decontaminate, language_id, line_dedup, packing, simhash
from cubeshelf.llm.common import held_out, quoted, staged
from cubeshelf.llm.queries import TOKENIZER
from cubeshelf.plans.testbed import table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told (no text, no letter, or no
    n-gram that a language's profile has) go."""
    return language_id.keep_identified(docs, ~held_out("doc_id", 3, 1))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten or more documents go; every document stays."""
    rest = [F.col(quoted(c)) for c in docs.columns if c not in ("doc_id", "text")]
    own = docs.select("doc_id", "text", F.struct(F.lit(True).alias("kept"), *rest).alias("carried"))
    got = line_dedup.drop_frequent_lines(own)
    return got.select(*[F.col(c) if c in ("doc_id", "text") else F.col("carried." + quoted(c)).alias(c) for c in docs.columns])


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 token ids."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

# Fingerprints and token ids can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
