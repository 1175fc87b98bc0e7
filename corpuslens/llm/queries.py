"""Registered queries of the subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm.conversations import damage, judge_conversations
from corpuslens.llm.fingerprints import fingerprint_neighbours
from corpuslens.llm.licenses import find_notices, scan_licenses
from corpuslens.llm.mixing import mix_sources
from corpuslens.llm.neighbours import nearest_vectors
from corpuslens.llm.ngram_join import near_duplicates
from corpuslens.llm.packing import pack_documents
from corpuslens.llm.quality import BASE, judge_quality
from corpuslens.llm.spellings import spelling_variants
from corpuslens.llm.substrings import find_repeats
from corpuslens.llm.token_blocks import encode_documents
from corpuslens.llm.toxicity import is_held_out, score_toxicity, train
from corpuslens.llm.urls import judge_urls

URL_RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_neighbours(_table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    return judged.select("doc_id", *BASE, "base_failed", "kept", "quality", "votes")


def op4_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(_table(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(_table(spark, sf_dir, "documents"))
    return found.selectExpr("doc_id", "size(licenses) AS n_licenses", "license", "dice", "license_text")


def op5_license_wordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_notices(_table(spark, sf_dir, "documents"))
    return found.selectExpr("doc_id", "size(licenses) AS n_licenses", "license", "dice", "license_text")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    machine = train(docs, _table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs.select("doc_id", "text"), machine)
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"), carry=["doc_id", "source"])


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_vectors(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op12_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return judge_conversations(damage(conversations), all_ids=conversations)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_ngram_join": op2_ngram_join,
    "op3_quality": op3_quality,
    "op4_token_blocks": op4_token_blocks,
    "op5_licenses": op5_licenses,
    "op5_license_wordings": op5_license_wordings,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_mixing": op8_mixing,
    "op9_urls": op9_urls,
    "op10_substrings": op10_substrings,
    "op11_neighbours": op11_neighbours,
    "op12_spellings": op12_spellings,
    "op13_conversations": op13_conversations,
}
