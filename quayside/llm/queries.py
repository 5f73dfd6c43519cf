"""The registered queries of the text operators: each applies its operator to the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (
    decontaminate, language_id, licenses, manifest, mixing, ngram_join, packing, quality, sharding, sql, substring_dedup, toxicity,
    url_filter, whitening,
)
from quayside.llm.common import table

VOCABULARY = "word_bpe_49k.json"
URL_RULES = [
    url_filter.Rule("org", "/", "allow"), url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"), url_filter.Rule("com", "/fr/", "allow"), url_filter.Rule("com", "/de/", "block"),
]
URL_GLOBS = [
    url_filter.Rule(host, path, "block", glob=True)
    for host, path in [("*free-bets*", "*"), ("*casino*", "*"), ("*", "*/login*"), ("*", "*.exe")]
]
SHARDS = [f"shard-{i:03d}" for i in range(96)]


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_texts(table(spark, sf_dir, "documents"), vocabulary_path())


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES, URL_GLOBS)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_groups(table(spark, sf_dir, "documents")).drop("_hash")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return decontaminate.leak_digest(found)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(documents, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    scored = toxicity.score_toxicity(documents, model, keep=["doc_id"])
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"), SHARDS)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest_repeats(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    out = language_id.id_remainder("doc_id", 4) == 2
    model = language_id.learn(documents, ~out)
    return language_id.identify(documents, model, keep=["doc_id"]).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return manifest.verify_documents(table(spark, sf_dir, "documents"), tampered)


QUERIES = {
    f.__name__: f
    for f in (op1_best_fit_packing, op2_url_filter, op3_ngram_jaccard_join, op4_decontamination, op5_toxicity, op6_sharding, op7_license_scan, op8_substring_dedup,
              op9_language_id, op10_quality_rules, op11_embedding_whitening, op12_source_mixing, op13_merkle_manifest)
}
ORACLES = {
    "op2_url_filter": sql.URL_FILTER, "op3_ngram_jaccard_join": sql.NGRAM_JOIN, "op4_decontamination": sql.DECONTAMINATION,
    "op7_license_scan": sql.LICENSE_SCAN, "op8_substring_dedup": sql.SUBSTRING_DEDUP,
    "op12_source_mixing": sql.SOURCE_MIXING, "op13_merkle_manifest": sql.MERKLE_MANIFEST,
}
