"""The registered queries of this subpackage, each with its SQL where SQL can state its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from docsift.llm import (chat, chatrepair, decontaminate, fingerprint, jaccard, langid, linetemplates, packing, sharding,
                         suffixdedup, toxicity, vectorcodes, windows)
from docsift.llm.packing import default_vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query("op2_packing")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(documents(spark, sf), default_vocabulary())


@query("op9_language_id")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify(documents(spark, sf))


@query("op5_line_dedup", "SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM ("
       + linetemplates.kept_sql() + ")")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    kept = linetemplates.drop_recurring(documents(spark, sf), counts=True)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op10_ngram_jaccard")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.join(documents(spark, sf)).select("doc_id", "n_shingles", "component_id")


@query("op3_decontamination")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


@query("op7_chat_formatting")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    turns = chat.with_probe(spark.read.parquet(f"{sf}/conversations.parquet"))
    return chat.digests(chat.format_chats(turns, default_vocabulary()), default_vocabulary())


@query("op4_fingerprints")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprint.fingerprints(documents(spark, sf))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)


@query("op6_toxicity")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return suffixdedup.digests(docs, suffixdedup.find_repeats(docs))


@query("op8_substring_dedup")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return windows.near_passages(documents(spark, sf))


@query("op12_sharding")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.digests(documents(spark, sf))


@query("op11_vector_codes", vectorcodes.rounds_sql())
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return vectorcodes.digests(spark.read.parquet(f"{sf}/embeddings.parquet"))


@query("op13_chat_repair", chatrepair.repair_sql())
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return chatrepair.damaged_digests(spark.read.parquet(f"{sf}/conversations.parquet"))
