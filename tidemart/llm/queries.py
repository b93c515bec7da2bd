"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import (
    backoff, best_fit, collocations, decontaminate, packing, quality, secrets, simhash, simple8b, sql, toxicity, transducer, warc,
    whitening,
)
from tidemart.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality(docs, table(spark, sf_dir, "labels")).drop("text")


def op2_simhash_vantage(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


def op4_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), every=packing.QUERY_EVERY)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", decontaminate.items_digest().alias("items_sha256"), "contaminated"
    )


def op6_simple8b_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.round_trip(table(spark, sf_dir, "documents"))


def op7_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)

    def count(kind: str):
        number = secrets.KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.listed("base"), 256).alias("base_sha256"), secrets.listed("spans").alias("spans"),
    )


def op8_transducer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op9_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.scores(table(spark, sf_dir, "documents"))


def op10_convolutional_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op11_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op12_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_stripe_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_line_field": op1_line_field,
    "op2_simhash_vantage": op2_simhash_vantage,
    "op3_warc_derivatives": op3_warc_derivatives,
    "op4_retrieval_packing": op4_retrieval_packing,
    "op5_decontaminate": op5_decontaminate,
    "op6_simple8b_files": op6_simple8b_files,
    "op7_linked_secrets": op7_linked_secrets,
    "op8_transducer_counts": op8_transducer_counts,
    "op9_stupid_backoff": op9_stupid_backoff,
    "op10_convolutional_toxicity": op10_convolutional_toxicity,
    "op11_best_two_fit": op11_best_two_fit,
    "op12_qdwh_whitening": op12_qdwh_whitening,
    "op13_stripe_collocations": op13_stripe_collocations,
}
SQL: dict[str, str] = {
    "op3_warc_derivatives": sql.warc_derivatives(),
    "op5_decontaminate": sql.decontaminated(),
    "op7_linked_secrets": sql.secrets_found(),
    "op13_stripe_collocations": sql.phrases(),
}
