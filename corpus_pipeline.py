"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs.  All but the last
return the columns of documents.  They decide row by row, by numbers of their
own, so rows without an id and rows that share one are each told by their text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rinkline.llm import decontaminate as decontamination
from rinkline.llm import exact_dedup as exact
from rinkline.llm import language_id, ngram_join, packing
from rinkline.llm._shared import ROW, discard, numbered, stored, table, without


def _ranked() -> Column:
    """What orders rows by id, null ids last, and tells them apart."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW).alias("ranked")


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence stay; the others, and those without letters, go."""
    rows = numbered(docs)
    found = language_id.identify(rows, language_id.fit_documents(rows), ROW)
    return without(rows, found.where("rejected").select(ROW), ROW).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts but for blanks, the one with the longest original text stays, then that with the smallest id (null ids last)."""
    rows = numbered(docs)
    found = exact.exact_dedup(rows.select(_ranked(), "text"), "ranked")
    return without(rows, found.where("not kept").select(f"ranked.{ROW}"), ROW).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more over five-word shingles, that with the smallest id stays (null ids last)."""
    rows = numbered(docs)
    linked = stored(ngram_join.ngram_join(rows, ROW, n=5, percent=80).where(F.col(ROW) != F.col("component_id")).select(ROW, "component_id"), "linked")
    members = linked.unionByName(linked.select(F.col("component_id").alias(ROW), "component_id").distinct())
    first = rows.select(ROW, "doc_id").join(members, ROW).groupBy("component_id").agg(F.min(_ranked()).alias("ranked"))
    kept = without(rows, members.join(first.select(f"ranked.{ROW}"), ROW, "left_anti"), ROW).select(*docs.columns)
    discard(linked)
    return kept


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item occurs go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenised and packed into sequences of 2048, with their token ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", decontaminate),
    ("packing", pack),
]

#: SQL can express neither the classifier nor the tokeniser; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
