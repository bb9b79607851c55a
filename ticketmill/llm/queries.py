"""One registered query per operator: the whole table in, the full result out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontamination, fingerprints, interpolation, licenses, manifest, minhash, mixing, negatives, oracles, packing, substrings, token_files, toxicity, vectors
from .common import shared_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = dict(oracles.ORACLES)


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's vocabulary file, the same on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op7_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


@query
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                        F.array_join("base", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), "score")


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), True, 2)
    return packing.pack(cut)


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), folder, vocabulary("word_bpe_49k.json"), False, 1)
    return token_files.digests(spark, folder)


@query
def op8_vector_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op10_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substrings.without_repeats(docs, with_text=False)
    return found.select("doc_id", F.col("_words").alias("n_words"), F.col("_removed").alias("n_removed"),
                        F.col("_digest").alias("kept_sha256"))


@query
def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = interpolation.held_out_scores(table(spark, sf_dir, "documents"))
    return found.select("doc_id", (F.col("part") == 0).alias("held_out"), "n_tokens", "n_known",
                        "train_tokens", "base_score", "score")


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda s, n: s + n)
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.tampering_found(table(spark, sf_dir, "documents"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(negatives.relabelled(table(spark, sf_dir, "embeddings")))
