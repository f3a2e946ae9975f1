"""From raw documents to token counts: five stages, each of which works on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.llm.bpe import encode_decode, token_digests
from acreage.llm.chosen_path import jaccard_classes
from acreage.llm.decontam import drop_contaminated
from acreage.llm.line_dedup import drop_lines
from acreage.llm.quality import grade_of, keep_quality
from acreage.llm.scratch import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are well-formed and not toxic."""
    return keep_quality(docs, grade_of(spark.read.parquet(f"{sf_dir}/labels.parquet")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line is similar to; n_chars follows the text."""
    return drop_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class of near duplicates."""
    gone = jaccard_classes(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of what is left."""
    return token_digests(encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("tokens", tokens)
]

#: The stages fit a model, join sets by similarity and merge tokens: no SQL gives their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
