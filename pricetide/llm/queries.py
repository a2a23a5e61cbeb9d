"""Registered queries of the operators, with their DuckDB texts where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricetide.llm.ann import neighbours
from pricetide.llm.common import ship_package, table
from pricetide.llm.packing import pack_documents
from pricetide.llm.records import records_round_trip
from pricetide.llm.decontamination import leaks
from pricetide.llm.neardup import near_duplicates
from pricetide.llm.sharding import shard_documents
from pricetide.llm import chat, hardneg, licenses, lm, simhash, toxicity, trie


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(table(spark, sf_dir, "documents"))


def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_round_trip(table(spark, sf_dir, "documents"))


def op6_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link_conversations(table(spark, sf_dir, "conversations"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardneg.hard_negatives(hardneg.shifted_labels(table(spark, sf_dir, "embeddings")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def _ready(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _ready(f) for f in (op1_near_duplicates, op2_toxicity, op3_sharding, op4_license_scan, op5_token_records, op6_tool_calls, op7_nearest_neighbours, op8_decontamination, op9_language_model, op10_packing,
                                    op11_simhash, op12_hard_negatives, op13_prefix_trie)}
ORACLE: dict[str, str] = {"op4_license_scan": licenses.oracle(), "op6_tool_calls": chat.oracle(),
                          "op12_hard_negatives": hardneg.oracle(), "op13_prefix_trie": trie.oracle()}
