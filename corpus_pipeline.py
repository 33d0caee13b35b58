"""The corpus pipeline: ``documents`` through five stages, each one operator.

Every stage takes ``(spark, docs, sf_dir)`` and gives the documents it keeps,
with the columns they came with; the last gives their tokens. ``run`` writes
each stage's result to the shared work folder and hands what it reads back to
the next, so a lost executor costs no more than a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsense.llm import bpe, decontaminate, jaccard, language, secret_scan
from gridsense.llm.queries import VOCABULARY
from gridsense.llm.tables import held_out, keep, table, whole_rows


LANGUAGES: list[str] | None = None  # to keep


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of ``LANGUAGES`` stay (None: any that the labelled
    documents name); those of another or of none go. What stays has the language
    found as its ``lang``, whatever it was labelled."""
    labelled = language.labelled_text(docs.where(~held_out()))
    found = language.identify(whole_rows(docs), labelled, text="__row.text", carry=["__row"])
    kept = found.where(F.col("lang_pred") != language.UND if LANGUAGES is None else F.col("lang_pred").isin(LANGUAGES))
    return kept.select(*[F.col("lang_pred").alias(c) if c == "lang" else F.col(f"__row.`{c}`").alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of similar documents the one of smallest id stays."""
    return jaccard.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.without_hits(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; every document stays."""
    cols = docs.columns
    masked = secret_scan.redact(docs, secret_scan.train(docs))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*cols)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they give its text back."""
    out = bpe.tokenize(docs, bpe.read_vocabulary(VOCABULARY), carry=["doc_id", "lang", "source"], decode="compare")
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "lossless")


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("BPE encoding and decoding", tokens),
]

# The models of language ID and secret scans have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
