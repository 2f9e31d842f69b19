"""The registered queries of this subpackage, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomline.llm.byte_network import score_quality
from loomline.llm.common import ship_package, table
from loomline.llm.decontaminate import decontaminated
from loomline.llm.langid import predict_languages
from loomline.llm.mixing import mix
from loomline.llm.near_dedup import near_duplicates
from loomline.llm.paragraph_dedup import without_repeated_paragraphs
from loomline.llm.prefix_trie import trie_nodes
from loomline.llm.quality import quality_verdicts
from loomline.llm.repair import repair_report
from loomline.llm.secrets import document_secrets
from loomline.llm.suffix_dedup import without_repeats
from loomline.llm.token_files import token_digest
from loomline.llm.toxicity import score_documents


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """The place of a public tokenizer file, which every machine has installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op1_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_paragraphs(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_secrets(table(spark, sf_dir, "documents"))


def op10_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_byte_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_nodes(table(spark, sf_dir, "conversations"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(table(spark, sf_dir, "conversations"))


Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


_OWN: dict[str, Query] = {
    "op1_paragraph_dedup": op1_paragraph_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_mix_sources": op4_mix_sources,
    "op5_secret_scan": op5_secret_scan,
    "op6_token_files": op6_token_files,
    "op7_language_id": op7_language_id,
    "op8_decontaminate": op8_decontaminate,
    "op9_near_dedup": op9_near_dedup,
    "op10_quality_outliers": op10_quality_outliers,
    "op11_byte_quality": op11_byte_quality,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_repair": op13_repair,
}

QUERIES: dict[str, Query] = {name: _shipped(query) for name, query in _OWN.items()}
