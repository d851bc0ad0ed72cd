"""A training corpus out of raw documents, in five stages.

Each stage is a function of the session, the rows the stage before it kept, and the folder of the other tables. Its
result is written as Parquet and read again as the next one's rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ombuds.llm import bpe, decontaminate, line_chunks, line_crf, simhash_groups
from ombuds.llm.common import free_name, table, written
from ombuds.llm.queries import QUALITY, TOKENIZER, quality_weights


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier doesn't reject.

    It learns from the labelled documents of ``docs``. Null and empty texts are scored like any other.
    """
    weights = quality_weights(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "__quality")
    scored = line_crf.score(docs, weights, out=score)
    return scored.where(F.col(score) >= QUALITY).select(*(F.col(f"`{name}`") for name in docs.columns))


def _filled(text: str) -> Column:
    return F.col(text).rlike(r"\S")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str, borders: bool = False) -> DataFrame:
    """Documents without chunks of lines that another one has already, or with ``borders`` without any passage that one
    has; ``n_chars`` follows the text.

    A document of which nothing is left goes, as all it had is in others. One that was empty before stays.
    """
    was = free_name(docs, "__filled")
    filled = docs.withColumn(was, F.coalesce(_filled("text"), F.lit(False)))
    cut = line_chunks.dedup_lines(filled, borders=borders).where(~F.col(was) | _filled("text")).drop(was)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return simhash_groups.keep_one(docs, shingle=3, bits=2)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage like a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, their number, and whether they decode to its text."""
    coded = bpe.encode_decode(docs, TOKENIZER, ids="ids", decoded="__decoded")
    same = F.col("__decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), same.alias("decodes"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("tokens", tokens),
]

#: The fitted classifier, SimHash and BPE can't be told in SQL; the tests repeat each stage by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
