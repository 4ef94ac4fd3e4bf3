"""A corpus pipeline: quality, language, near-copies, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as
Parquet in the shared checkpoint folder and read again as the next stage's
docs. All but the last return the columns of documents.

* ``quality`` drops documents whose quality score is below the operator's
  threshold; labels come from ``sf_dir``.
* ``language`` drops documents that are in none of the learned languages:
  null texts, texts without a letter, and texts of some length of which the
  classifier's landmarks span too little; it learns from the stage's own input.
* ``near_copies`` keeps one document of each SimHash group.
* ``mix`` gives each document as often as the mix takes it: not at all, once
  or twice, whole.
* ``tokens`` adds the number of tokens and the digests of ids and decoded
  bytes.

An empty input gives an empty output with the same columns; extra columns of
documents are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm import byte_bpe, language_id, quality_classifier, queries, simhash_dedup, source_mixing
from runlens.llm.common import stored


def whole(docs: DataFrame) -> DataFrame:
    """Each document as one struct ``row`` and its ``text``: columns that a stage adds clash with none of a document's."""
    return docs.select(F.struct("*").alias("row"), "text")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = queries.quality_model(docs, queries.table(spark, sf_dir, "labels"))
    scored = quality_classifier.score(whole(docs), model, out="quality")
    return scored.where(F.col("quality") >= queries.QUALITY_SCORE).select("row.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = whole(docs)
    found = rows.withColumn("language", language_id.language_column(rows, queries.language_model(docs)))
    return found.where("language.known").select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.one_per_group(docs, shingle=3, radius=2).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = stored(source_mixing.sized(docs), "mix-sizes")
    return source_mixing.Mix(rows, **queries.MIX).repeated(docs).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.Tokens(docs, queries.RANKS, queries.PATTERN).digests(whole(docs), out="tokens")
    counted = ["n_tokens", "ids_sha256", "decoded_sha256"]
    return encoded.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in counted], "tokens.*")


STAGES = [("quality", quality), ("language", language), ("near_copies", near_copies), ("mix", mix), ("tokens", tokens)]

#: The stages' models and hashes have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
