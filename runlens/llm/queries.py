"""Registered queries of this subpackage and their DuckDB restatements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (balanced_sharding, byte_bpe, embedding_dedup, html_extraction, language_id, line_dedup, merkle_manifest,
               oracle, prefix_forest, quality_classifier, quotation_linking, simhash_dedup, source_mixing, whitening)
from .common import crc_bucket, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: A document is predicted to be of quality from this score on.
QUALITY_SCORE = 0.3
MIX = {"weights": (3.0, 1.0, 2.0), "budget": 1.5, "most": 2.0, "fills": 2}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_html_extraction")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extraction.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def quality_model(docs: DataFrame, labels: DataFrame) -> quality_classifier.Model:
    return quality_classifier.fit(docs, labels, "quality", learn=crc_bucket("doc_id", 5) != 0)


@register("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_classifier.score(docs, quality_model(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_bucket("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= QUALITY_SCORE).cast("int").alias("predicted"))


@register("op3_embedding_near_dedup", oracle.NEAR_COPIES)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_copies(table(spark, sf_dir, "embeddings"))


@register("op4_quotation_linking", oracle.conversations("SELECT conv_id, turn, role, text FROM conversations"))
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotation_linking.rebuilt(table(spark, sf_dir, "conversations"))


@register("quoted_conversations", oracle.conversations(oracle.QUOTED_MESSAGES))
def quoted_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over replies that quote, made from the table: each message quotes the one before it, and every
    third one the message before that too, a level deeper."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    quoted = lambda column, marks: F.concat(F.lit(marks), F.regexp_replace(column, "\n", "\n" + marks))
    earlier = lambda n: said.select("conv_id", (F.col("turn") + n).alias("turn"), F.col("text").alias(f"back{n}"))
    joined = said.join(earlier(1), ["conv_id", "turn"], "left").join(earlier(2), ["conv_id", "turn"], "left")
    deep = F.when(F.col("turn") % 3 == 2, F.concat(quoted(F.col("back2"), "> > "), F.lit("\n")))
    reply = F.concat(F.coalesce(deep, F.lit("")), F.coalesce(F.concat(quoted(F.col("back1"), "> "), F.lit("\n")), F.lit("")),
                     F.col("text"))
    return quotation_linking.rebuilt(joined.select("conv_id", "turn", "role", reply.alias("text")))


@register("op5_balanced_sharding")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_sharding.shard_documents(table(spark, sf_dir, "documents"))


@register("op6_simhash_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.groups(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register("op7_byte_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.Tokens(docs, RANKS, PATTERN).digests(docs).select("doc_id", "tokens.*")


def language_model(docs: DataFrame) -> language_id.Model:
    return language_id.fit(docs, learn=crc_bucket("doc_id", 3) != 1)


@register("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id.predict(docs.select("doc_id", "text"), language_model(docs))
    return found.select("doc_id", (crc_bucket("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@register("op9_source_mixing", oracle.mixing(**MIX))
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(source_mixing.sized(table(spark, sf_dir, "documents")), "mix-sizes")
    return source_mixing.Mix(rows, **MIX).taken(rows).select("doc_id", "size", "source_size", "target", "taken")


@register("op10_prefix_forest")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.nearest(table(spark, sf_dir, "embeddings"), queries=F.col("vec_id") % 20 == 0, k=20)


@register("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), components=16)


@register("op12_merkle_manifest", oracle.manifest())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return merkle_manifest.manifest(table(spark, sf_dir, "documents"),
                                    tampered=F.when(picked, F.replace("text", F.lit("\n"), F.lit(""))))


@register("op13_line_dedup", oracle.lines_dropped(min_docs=10, min_chars=1))
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.without_shared_lines(docs, min_docs=10, min_chars=1)
    return kept.select("doc_id", "kept.n_lines", "kept.n_dropped",
                       F.sha2(F.col("kept.text").cast("binary"), 256).alias("kept_sha256"))
