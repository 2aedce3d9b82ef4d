"""A training corpus in five stages, each one operator over all that the stage before kept.

Rules reject poor documents, one document of each group of near duplicates stays, documents with
benchmark text go, personal data is masked, and what is left becomes token ids that
decode to the same bytes.  Every stage's result is written to the shared folder and read back,
so a lost executor costs the tasks of one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from silverlode.llm import bpe, decontamination, ngram_join, pii, quality_rules
from silverlode.llm.shared import table, written

#: Rank file of the last stage; any vocabulary in the same format will do.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.tokenize(docs, bpe.vocabulary(spark, RANKS, public_tokenizers.PATTERN))


STAGES = [
    ("quality rules", rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("PII", mask_pii),
    ("byte-level BPE", tokens),
]

#: SQL cannot express the encoding; the tests hold all stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
