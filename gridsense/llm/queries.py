"""The registered queries of this folder: each operator on its whole table,
with production parameters, and digests of the operator's output where the
result itself is large."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsense.llm import (alignment, bpe, chat, decontaminate, jaccard, language, lexical, main_text, nearest,
                           quality, secret_scan, token_files, urls)
from gridsense.llm.oracle import ORACLE
from gridsense.llm.tables import held_out, keep, table

__all__ = ["ORACLE", "QUERIES"]

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    weights = quality.train(docs.where(~held_out()), labels.where(~held_out()))
    return quality.score(docs, weights).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest.nearest(vectors, F.col("vec_id") % 100 == 0)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages", "page_id", "url"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return main_text.extract(pages, main_text.train(pages))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.train(docs))
    base = F.filter("spans", lambda s: s["kind"] < len(secret_scan.BASE))

    def count(kind: str):
        k = secret_scan.KINDS.index(kind)
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, secret_scan.BASE),
                        F.sha2(secret_scan.named(base), 256).alias("base_sha256"),
                        secret_scan.named(F.col("spans")).alias("spans"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    labelled = language.labelled_text(docs.where(~held_out()))
    return language.identify(docs, labelled).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = bpe.tokenize(docs, bpe.read_vocabulary(VOCABULARY))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    vocabulary = bpe.read_vocabulary(VOCABULARY)
    return chat.read_back(chat.format_turns(rows.unionByName(extra), vocabulary), vocabulary)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    ids = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return lexical.search(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    back = token_files.read_tokens(token_files.write_tokens(docs, bpe.read_vocabulary(WORD_VOCABULARY)))
    return back.select("doc_id", "start", F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = alignment.read_model(PIECE_MODEL)
    found = alignment.align(docs, bpe.read_vocabulary(VOCABULARY), model)
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256))
    found = keep(found.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return alignment.weigh(found, alignment.model_size(model)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {
    "op1_quality": op1_quality,
    "op2_nearest": op2_nearest,
    "op3_url_filter": op3_url_filter,
    "op4_main_text": op4_main_text,
    "op5_secrets": op5_secrets,
    "op6_language": op6_language,
    "op7_jaccard": op7_jaccard,
    "op8_bpe": op8_bpe,
    "op9_chat": op9_chat,
    "op10_decontaminate": op10_decontaminate,
    "op11_search": op11_search,
    "op12_token_files": op12_token_files,
    "op13_alignment": op13_alignment,
}
