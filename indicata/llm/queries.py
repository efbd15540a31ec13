"""One registered query per operator, each over its whole table with
production parameters; ``ORACLES`` holds DuckDB SQL where SQL can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.llm import (chat, decontam, embed_dedup, html_text, jaccard, licenses, lm_score, oracles, packing,
                          prefix_trie, toxicity, url_filter, warc, whitening)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_documents(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train_model(docs, table(spark, sf_dir, "labels")))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(F.explode(F.array(
        F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"),
                 F.lit("user").alias("role"), F.lit(said).alias("text")),
        F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(1).cast("long").alias("turn"),
                 F.lit("assistant").alias("role"), F.lit(said).alias("text")))).alias("r")).select("r.*")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.conversation_digests(chat.format_conversations(turns))


# The rules the query judges by (host, path, verdict).
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return url_filter.match_urls(table(spark, sf_dir, "pages"), rules)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prefix_trie.turn_rows(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.steps_with_shared_heads(rows))


QUERIES = {
    "op1_warc_salvage": op1_warc_salvage,
    "op2_license_scan": op2_license_scan,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_decontaminate": op4_decontaminate,
    "op5_toxicity": op5_toxicity,
    "op6_chat_format": op6_chat_format,
    "op7_url_filter": op7_url_filter,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_lattice_likelihood": op10_lattice_likelihood,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_html_extraction": op12_html_extraction,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLES = {
    "op1_warc_salvage": oracles.WARC_SALVAGE,
    "op2_license_scan": oracles.LICENSE_SCAN,
    "op6_chat_format": oracles.CHAT_FORMAT,
    "op7_url_filter": oracles.URL_FILTER,
    "op13_prefix_trie": oracles.PREFIX_TRIE,
}
