"""One query per operator over its whole table, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import (
    disclosure, divergence, minmax, neighbours, oracles, packing, quality, recipes, repair, substrings, token_files, toxicity, urls, winnow,
)
from textloom.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file; the file is read on the executors, where the package lies too."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if name in oracles.SQL:
            ORACLES[name] = oracles.SQL[name]
        return run

    return register


@query("op7_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.col("items").cast("array<string>"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), "contaminated",
    )


@query("op6_minhash_near_dedup")
def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


@query("op2_exact_dedup")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recipes.exact_duplicates(table(spark, sf_dir, "documents")).drop("n_chunks")


URL_RULES = (
    urls.Rule(True, "com"),
    urls.Rule(False, "example.com", "/en/"),
    urls.Rule(True, "www.example.com", "/en/"),
    urls.Rule(False, "net", "/es/"),
    urls.Rule(False, "net", "/fr/"),
)


@query("op8_url_filters")
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), with_ids=False)


@query("op10_token_id_binary_output")
def token_id_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op3_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = disclosure.sensitive_spans(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    counts = [disclosure.span_count(spans, k).alias(f"n_{name}") for k, name in enumerate(disclosure.KINDS[:4])]
    base = disclosure.spans_text(spans, (0, 1, 2, 3))
    return found.select(
        "doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), disclosure.spans_text(spans).alias("spans")
    )


@query("op4_substring_dedup")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


@query("op12_conversation_structure_repair")
def conversation_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.repair_conversations(repair.damaged(conversations), conversations.select("conv_id"))


@query("op11_source_divergence_audit")
def source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


@query("op13_approximate_nearest_neighbours")
def approximate_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
