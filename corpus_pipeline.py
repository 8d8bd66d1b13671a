"""Corpus preparation: language ID, near-duplicates, decontamination, then byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return
the columns of documents; the last adds the ids of each text and the bytes decoded from them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skeinwork.llm import bpe, decontaminate, langid, simhash
from skeinwork.llm.common import materialise, table
from skeinwork.llm.queries import RANKS


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows in a language that is learned from the rows with a lang; `und` and texts of no language learned go."""
    return langid.keep_identified(docs, langid.fit(docs.filter(~langid.held_out("doc_id"))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near-duplicates."""
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows that leak an item of the benchmark."""
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ids (array<int>) and the digests of what they decode to."""
    return bpe.with_tokens(docs, public_tokenizers.path(RANKS))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("byte_bpe", byte_bpe)]

# The stages hash, learn and encode, which SQL does not express; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
