"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.cap_filters import near_duplicate_vectors
from skyledger.llm.chat import chat_digests, format_chats
from skyledger.llm.common import table
from skyledger.llm.decision_list import quality_verdicts
from skyledger.llm.katz import katz_scores
from skyledger.llm.mixing import mix_sources
from skyledger.llm.oracle import ORACLE  # noqa: F401
from skyledger.llm.packing import pack_documents
from skyledger.llm.sharding import shard_by_bytes
from skyledger.llm.simhash import near_duplicates
from skyledger.llm.token_files import token_file_digests
from skyledger.llm.tokens import tokenizer_path
from skyledger.llm.toxicity import toxicity_scores
from skyledger.llm.url_filter import Rule, default_labels, judge_urls
from skyledger.llm.vector_codes import vector_code_digests
from skyledger.llm.whitening import whitened_rows


def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents"))


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_file_digests(spark, table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1)


def op3_katz(spark: SparkSession, folder: str) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    scores = katz_scores(table(spark, folder, "documents"), train=fold != 0)
    return scores.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_cap_filters(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, folder, "embeddings"), cosine=0.9)


def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat_digests(format_chats(turns.union(more)))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_verdicts(table(spark, folder, "documents"), table(spark, folder, "labels"), sample=20_000)


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"), sample=8000, landmarks=64)


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), shingle=3, radius=3)


def op9_pack_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0, capacity=2048)


def op10_shard_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return shard_by_bytes(table(spark, folder, "documents"), shards=8)


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_code_digests(table(spark, folder, "embeddings"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened_rows(table(spark, folder, "embeddings"))


def op13_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = [
        Rule("allow", "org"),
        Rule("block", "example.org", "/es/"),
        Rule("block", "example.org", "/en/1"),
        Rule("allow", "com", "/fr/"),
        Rule("block", "com", "/de/"),
    ]
    return judge_urls(table(spark, folder, "pages"), rules, default_labels(spark)).select("page_id", "host", "path", "rule", "verdict")


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_token_files": op2_token_files,
    "op3_katz": op3_katz,
    "op4_cap_filters": op4_cap_filters,
    "op5_chat_format": op5_chat_format,
    "op6_quality_rules": op6_quality_rules,
    "op7_toxicity": op7_toxicity,
    "op8_simhash": op8_simhash,
    "op9_pack_best_fit": op9_pack_best_fit,
    "op10_shard_bytes": op10_shard_bytes,
    "op11_vector_codes": op11_vector_codes,
    "op12_whitening": op12_whitening,
    "op13_url_filter": op13_url_filter,
}
