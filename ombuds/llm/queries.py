"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ombuds.llm import bpe, context_tree, conversation_repair, decontaminate, html_text, line_chunks, line_crf, neighbours, personal_data, simhash_groups, token_counts, training_order, whitening
from ombuds.llm.common import table
from ombuds.session import scratch

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: The same vocabulary as ranks, its pattern, and the id that ends a text.
RANKS, PATTERN, END = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 50256
#: Documents from this quality on are kept.
QUALITY = 0.3


def _fold(folds: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % folds == 0


def quality_weights(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Learned from the labels outside the held-out fold."""
    return line_crf.fit(docs, labels, F.crc32(F.col("key").cast("string")) % 5 != 0)


def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = line_crf.score(docs, quality_weights(docs, table(spark, sf_dir, "labels")))
    predicted = F.when(F.col("score") >= QUALITY, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", F.coalesce(_fold(5), F.lit(False)).alias("held_out"), "score", predicted)


def op2_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score_texts(table(spark, sf_dir, "documents"), _fold(10))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, TOKENIZER)
    return counted.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 512).alias("over_limit"),
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("doc.id").alias("doc_id"), "item_id", "similarity", "start")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.where("vec_id % 100 = 0"))


def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per sequence: where it is, and a digest of its record as read from that place of the shard's file."""
    out = scratch(spark, "shards")
    training_order.materialise(table(spark, sf_dir, "documents"), out, RANKS, PATTERN, END)
    place = (F.col("slot") % training_order.SHARD_SLOTS) * (2 * training_order.LENGTH)
    digests = training_order.records(spark, out).select("slot", F.md5("record").alias("record_md5"))
    found = training_order.index(spark, out).join(digests, "slot")
    return found.select("doc_id", "seq_no", "slot", "shard", place.alias("offset"), "n_tokens", "record_md5")


def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = line_chunks.dedup_lines(docs, report=True)
    counts = ("n_lines", "n_chunks", "removed_chunks", "removed_lines")
    return cut.select("doc_id", *counts, F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def op8_whole_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op8_line_chunks`` with the borders of passages."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = line_chunks.dedup_lines(docs, report=True, borders=True)
    counts = ("n_lines", "n_chunks", "removed_chunks", "removed_lines")
    return cut.select("doc_id", *counts, F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, bits=2)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_decode(docs, TOKENIZER)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def told(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"),
        *(number(kind) for kind in personal_data.KINDS),
        F.sha2(told("base"), 256).alias("base_sha256"),
        told("spans").alias("spans"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with a fault in some rows, by a hash of their conversation and turn: dropped, emptied, without ends of
    sentences, repeated, or of another role."""
    space = F.lit(" ")
    conv, turn, role, text = (F.coalesce(F.col(name).cast("string"), space) for name in ("conv_id", "turn", "role", "text"))
    fault = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    some = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault")).where("fault != 0")
    return some.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "")
        .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def op12_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repaired = conversation_repair.repair(damaged(turns))
    every = turns.select("conv_id").distinct().select(F.col("conv_id").alias("every"))
    same = F.col("every").eqNullSafe(F.col("conv_id"))
    found = every.join(repaired.conversations, same, "left").drop("conv_id")
    found = found.join(conversation_repair.digests(repaired.pieces), same, "left")
    none, counts = F.lit(0).cast("long"), ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        F.col("every").alias("conv_id"),
        *(F.coalesce(name, none).alias(name) for name in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_crf": op1_line_crf,
    "op2_context_tree": op2_context_tree,
    "op3_token_counts": op3_token_counts,
    "op4_decontaminate": op4_decontaminate,
    "op5_html_text": op5_html_text,
    "op6_neighbours": op6_neighbours,
    "op7_training_order": op7_training_order,
    "op8_line_chunks": op8_line_chunks,
    "op8_whole_passages": op8_whole_passages,
    "op9_simhash_groups": op9_simhash_groups,
    "op10_bpe": op10_bpe,
    "op11_personal_data": op11_personal_data,
    "op12_role_repair": op12_role_repair,
    "op13_whitening": op13_whitening,
}

ORACLE: dict[str, str] = {"op4_decontaminate": decontaminate.ORACLE, "op8_line_chunks": line_chunks.ORACLE}
