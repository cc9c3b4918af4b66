"""The corpus pipeline: documents to training tokens.

Each stage takes what its predecessor kept, works on all of it, and is written as Parquet before the
next one reads it.  Columns beyond those of ``documents``, whatever their names, go through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortframe.llm import bpe, decontam, langid, lines, simhash
from cohortframe.llm.queries import SIMHASH, language_model, vocabulary
from cohortframe.llm.util import fresh, join_keys, stage_table
from cohortframe.sources.tables import read_table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the language is not rejected.

    A null or empty text, or one without a letter, has no language and goes.  Repeated rows are judged alike, a null
    doc_id or lang does not matter, whole texts count.  Without labelled rows to learn from (an empty table too) no row is left.
    """
    return langid.keep_known(docs, language_model(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source.

    A null text stays null, one of boilerplate alone becomes empty; rows without a source keep all lines; repeated
    rows count as pages of their own and stay.  An empty table gives none.
    """
    return lines.line_dedup(docs, host_col="source")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies.

    Texts without words (null, empty) are one group.  The smallest doc_id stays, a null one only if all are; of repeated rows
    one stays, of different texts under one id the least by hash.  An empty table gives none.
    """
    return simhash.keep_first(docs, simhash.near_duplicates(docs, **SIMHASH))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark occurs.

    A null text has no words and stays; texts that share a doc_id are judged apart, repeated rows alike; an empty
    benchmark leaves all, an empty table gives none.
    """
    found = decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark")).filter("contaminated")
    doc, text = fresh(docs, "hit_id", "hit_text")
    hit = stage_table(found.select(F.col("doc_id").alias(doc), F.col("text_key").alias(text)).distinct(), "pipeline-hit")
    return join_keys(docs, hit, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(text)), "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, and digests of them and of what they decode to.

    A null or empty text has no tokens; each repeated row has its row; very long texts are encoded whole; an empty
    table gives none.
    """
    return bpe.round_trip(docs, vocabulary(), keep_ids=True)


STAGES = [("language", language), ("line_dedup", line_dedup), ("simhash", near_copies), ("decontamination", decontaminate), ("bpe", tokens)]

#: The language model has no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
