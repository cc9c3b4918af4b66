"""One query for each operator over its whole table, with the settings used in production."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortframe.llm import bpe, chat, decontam, html, importance, jaccard, langid, lines, phrases, simhash, topk, urls, warc
from cohortframe.session import scratch_path
from cohortframe.sources.tables import read_table

#: Shingle length in words and largest bit distance of near copies.
SIMHASH = {"shingle": 3, "max_bits": 3}


#: Verdict, host and path prefix.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Tools of the conversations, with their arguments' types and whether they are required.
CHAT_TOOLS = {"respond": {"text": ("string", True)}}
#: File of the public tokenizer for training text.
VOCABULARY = "word_bpe_49k.json"


def vocabulary() -> str:
    import public_tokenizers
    return os.fspath(public_tokenizers.path(VOCABULARY))


def op1_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-copy component of every document."""
    groups = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), **SIMHASH)
    return groups.select("doc_id", "fingerprint", "component_id")


def op2_topk_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best documents for every document whose id is divisible by 20, among all documents."""
    return topk.top_k(read_table(spark, sf_dir, "documents"), every=20, k=10)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the boilerplate lines of its source."""
    kept = lines.line_dedup(read_table(spark, sf_dir, "documents"), host_col="source", counts=True)
    return kept.select("doc_id", "n_lines", "n_dropped", "text")


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, indexed, and read back by byte ranges."""
    path = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    warc.write_archive(read_table(spark, sf_dir, "pages"), path)
    return warc.captures(warc.read_records(warc.build_index(spark, path)))


def op5_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text encoded and decoded."""
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), vocabulary())


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(read_table(spark, sf_dir, "pages"))


def held_out() -> Column:
    """Whether language identification may not learn from a document; a null id counts as held out."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(True))


def language_model(docs: DataFrame) -> langid.Model:
    """Trained on documents whose id falls outside the fold that is held out."""
    return langid.fit(docs.filter(~held_out()))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = read_table(spark, sf_dir, "documents")
    found = langid.predict(docs, language_model(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    return urls.judge(read_table(spark, sf_dir, "pages"), URL_RULES)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a passage of the benchmark."""
    return decontam.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("text_key")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message as an event in canonical JSON: prompts as calls, replies as their results."""
    found = chat.events(read_table(spark, sf_dir, "conversations"), prompts="respond")
    out = chat.format_chats(found, CHAT_TOOLS)
    return out.select("conv_id", "turn", "kind", "call_id", "status", "at", "depth", F.coalesce(F.size("errors"), F.lit(0)).cast("long").alias("n_errors"), "json")


def op11_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's set of 4-word shingles, and its component of sets with a similarity of 0.85."""
    return jaccard.join(read_table(spark, sf_dir, "documents"), grams=4, percent=85)


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of each language."""
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of every document towards the benchmark's texts, and the ranks of the tenth that is drawn."""
    out = importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_neardup": op1_simhash_neardup,
    "op2_topk_bm25": op2_topk_bm25,
    "op3_line_dedup": op3_line_dedup,
    "op4_warc_index": op4_warc_index,
    "op5_bpe_roundtrip": op5_bpe_roundtrip,
    "op6_html_extract": op6_html_extract,
    "op7_language_id": op7_language_id,
    "op8_url_filter": op8_url_filter,
    "op9_decontaminate": op9_decontaminate,
    "op10_chat_format": op10_chat_format,
    "op11_ngram_jaccard": op11_ngram_jaccard,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_importance_resample": op13_importance_resample,
}

ORACLE: dict[str, str] = {
    "op2_topk_bm25": topk.ORACLE_SQL,
    "op3_line_dedup": lines.ORACLE_SQL,
    "op4_warc_index": warc.ORACLE_SQL,
    "op9_decontaminate": decontam.ORACLE_SQL,
    "op10_chat_format": chat.ORACLE_SQL,
    "op11_ngram_jaccard": jaccard.ORACLE_SQL,
    "op12_phrase_collocations": phrases.ORACLE_SQL,
    "op13_importance_resample": importance.ORACLE_SQL,
}
