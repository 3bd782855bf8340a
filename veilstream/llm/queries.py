"""Queries of the operators on text (p4, p7, p8, p9)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut
from . import bpe, mixing, pii, toxicity

#: Where the public tokenizers' files lie.
TOKENIZERS = "/opt/tokenizers"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ranks_path(folder: str = TOKENIZERS, name: str = "byte_bpe_50k.tiktoken") -> str:
    return os.path.join(folder, name)


# --- p4: personal information ---------------------------------------------------------------


def pii_model(spark: SparkSession, folder: str) -> pii.PiiModel:
    notes, visits = table(spark, folder, "notes"), table(spark, folder, "appointments")
    people = [(table(spark, folder, "patients"), ["first_name", "middle_name"], ["last_name"]), (table(spark, folder, "providers"), [], [], ["full_name"])]
    return pii.fit([(notes, "note_id", "body", False), (visits, "appointment_id", "intake_answers", True)], people)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    model = pii_model(spark, folder)
    notes = pii.find(table(spark, folder, "notes"), "note_id", "body", False, "notes", model)
    return notes.unionByName(pii.find(table(spark, folder, "appointments"), "appointment_id", "intake_answers", True, "appointments", model))


def p4_redacted(spark: SparkSession, folder: str) -> DataFrame:
    model = pii_model(spark, folder)
    notes = pii.redact(table(spark, folder, "notes"), "note_id", "body", False, model).select(F.lit("notes").alias("source_table"), F.col("note_id").alias("row_id"), "redacted")
    visits = pii.redact(table(spark, folder, "appointments"), "appointment_id", "intake_answers", True, model)
    return notes.unionByName(visits.select(F.lit("appointments").alias("source_table"), F.col("appointment_id").alias("row_id"), "redacted"))


# --- p7: encoding --------------------------------------------------------------------------


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_corpus(table(spark, folder, "documents"), "doc_id", "text", ranks_path())


def p7_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose ids do not decode to their text (none, as every byte has a token)."""
    docs = table(spark, folder, "documents")
    ids = bpe.encode_corpus(docs, "doc_id", "text", ranks_path())
    back = bpe.decode_corpus(ids, "doc_id", "ids", ranks_path()).withColumnRenamed("text", "decoded")
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(back, "doc_id").where("text <> decoded").select("doc_id")


def p7_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """What the ids of every document decode to: its length and digest."""
    ids = bpe.encode_corpus(table(spark, folder, "documents"), "doc_id", "text", ranks_path())
    back = bpe.decode_corpus(ids, "doc_id", "ids", ranks_path())
    return back.select("doc_id", F.length(F.encode("text", "UTF-8")).cast("bigint").alias("n_bytes"), F.md5(F.encode("text", "UTF-8")).alias("digest"))


# --- p8: mixing ----------------------------------------------------------------------------


def sized_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, source, n_tokens; written once, as the plan and the sampling both read it."""
    return cut(bpe.count_tokens(table(spark, folder, "documents"), ["doc_id", "source"], "text", ranks_path()))


def _mixed(spark: SparkSession, folder: str) -> tuple[DataFrame, list[mixing.SourcePlan]]:
    sized = sized_documents(spark, folder)
    plan = mixing.plan_sources(sized, table(spark, folder, "mix_targets"))
    return mixing.mix(sized, plan), plan


def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    return _mixed(spark, folder)[0]


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.shares(*_mixed(spark, folder))


# --- p9: abusive, hateful, sexual content ---------------------------------------------------


def _scored(spark: SparkSession, folder: str, keep: tuple[str, ...] = ()) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs), keep=keep)


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.found(_scored(spark, folder))


def p9_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder)


def p9_rates(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.rates(_scored(spark, folder, ("source",)))


def p9_review(spark: SparkSession, folder: str) -> DataFrame:
    """Reviewers' labels against what was found: labels per category, and how many of them agree."""
    labels = table(spark, folder, "doc_labels").select("doc_id", "category").distinct()
    found = p9_found(spark, folder).withColumn("hit", F.lit(True))
    any_hit = found.select("doc_id").distinct().withColumn("any_hit", F.lit(True))
    both = labels.join(found, ["doc_id", "category"], "left").join(any_hit, "doc_id", "left")
    agree = F.when(F.col("category") == "none", F.col("any_hit").isNull()).otherwise(F.col("hit").isNotNull())
    return both.groupBy("category").agg(F.count(F.lit(1)).alias("n_labels"), F.sum(agree.cast("int")).alias("n_agree"))


QUERIES = {"p4_found": p4_found, "p4_redacted": p4_redacted, "p9_found": p9_found, "p9_scores": p9_scores, "p9_rates": p9_rates, "p9_review": p9_review, "p7_ids": p7_ids, "p7_round_trip": p7_round_trip, "p7_decoded": p7_decoded, "p8_mix": p8_mix, "p8_shares": p8_shares}
SQL = {
    "p7_round_trip": "SELECT doc_id FROM documents WHERE false",
    "p7_decoded": "SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS n_bytes, md5(coalesce(text, '')) AS digest FROM documents",
}
