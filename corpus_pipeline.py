"""From raw documents to token ids in five stages, each on all that the one before kept.

Every stage takes and returns whole documents; all but the last return the columns of the
table unchanged. An empty table gives an empty table in each stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallymark.llm.bpe import encoded
from tallymark.llm.common import ship, staged, table
from tallymark.llm.decontam import without_leaks
from tallymark.llm.lines import without_boilerplate
from tallymark.llm.minhash import one_of_each
from tallymark.llm.quality import keep_good


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ship(spark)
    return keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many sites share."""
    ship(spark)
    return without_boilerplate(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship(spark)
    return one_of_each(docs)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids and the digests of ids and decoded bytes."""
    ship(spark)
    return encoded(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                   public_tokenizers.PATTERN, docs.columns, with_ids=True)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("decontamination", leak_stage),
    ("bpe", token_stage),
]

#: SQL has no counterpart of the near-duplicate and edit-distance stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and reread as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
