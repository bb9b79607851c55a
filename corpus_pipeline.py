"""A training corpus from raw documents, in five stages that are each one operator.

Each stage reads all that the one before kept and wrote; all but the last return the columns of
`documents`. Columns besides doc_id, text and source are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ticketmill.llm import minhash, mixing, packing, substrings, toxicity
from ticketmill.llm.common import WORD, restored, shared_path, stored, table, with_rest
from ticketmill.llm.queries import vocabulary


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5; nulls and empty texts are scored like any others."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = model.score(with_rest(docs, ["doc_id", "text"]))
    return restored(scored.where("_score < 0.5"), docs.columns, ["doc_id", "text"])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group: of those with the smallest id, null ids last, one by its content.
    Repeated rows are copies like any others. Texts without words are in no group and stay.

    A row has the component of its text, told by both halves of a 128-bit hash, so that it has one with
    an id or without; only texts whose component has others are looked up, the rest are their own groups.
    """
    t1, t2 = F.xxhash64("text").alias("_t1"), F.xxhash64(F.lit(1), "text").alias("_t2")
    rows = with_rest(docs, ["doc_id", "text"]).select("*", t1, t2)
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    found = minhash.classes(rows.where(worded).select("doc_id", "text")).select("t1", "t2", "component").distinct()
    found = stored(found, "near-texts")
    shared = found.groupBy("component").agg(F.count("*").alias("_n")).where("_n > 1").select("component")
    groups = stored(found.join(shared, "component", "left_semi").select(
        F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), F.col("component").alias("_group")), "near-groups")
    placed = rows.where(worded).join(groups, ["_t1", "_t2"], "left")
    alone = [F.when(F.col("_group").isNull(), F.col(c)).alias(f"_own{c}") for c in ("_t1", "_t2")]
    placed = placed.select("*", *alone)
    order = Window.partitionBy("_group", "_own_t1", "_own_t2").orderBy(
        F.asc_nulls_last("doc_id"), "_t1", F.xxhash64(F.to_json(F.struct("_rest"))))
    first = placed.withColumn("_rank", F.row_number().over(order)).where("_rank = 1")
    kept = rows.where(~worded).select("doc_id", "text", "_rest").unionByName(first.select("doc_id", "text", "_rest"))
    return restored(kept, docs.columns, ["doc_id", "text"])


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows that stand elsewhere too; n_chars follows the text. A
    text of which nothing is left stays as an empty one."""
    counted = "n_chars" in docs.columns
    needed = ["doc_id", "text"] + ["n_chars"] * counted
    cleaned = substrings.without_repeats(with_rest(docs, needed))
    if counted:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.when(
            F.col("_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return restored(cleaned, docs.columns, needed)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 1024 tokens."""
    return packing.pack(packing.pieces(docs, vocabulary("byte_bpe_50k.json"), True, 2))


STAGES = [
    ("toxicity", reject_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# The learned scores and the packing are not SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
