"""Sensitive word checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.text import last_token
from tidemart.operators.joins import keyed_join

GRADE = "P0"  # fixed value: grade of every violation


def word_set(words: DataFrame) -> DataFrame:
    """Distinct non-empty words."""
    return words.select(F.col("word")).filter("word <> ''").distinct()


def words_exist(df: DataFrame, words: DataFrame, column: str = "word") -> DataFrame:
    """Membership of each value in the word set as ``exists``.

    The set is broadcast while Spark measures it below the broadcast limit; beyond
    it both sides are shuffled and a frequent value is split.
    """
    known = word_set(words).select(F.col("word").alias("_known"))
    return (
        keyed_join(df, known, [column], ["_known"], "left")
        .withColumn("exists", F.col("_known").isNotNull())
        .drop("_known")
    )


def flag_sensitive(df: DataFrame, words: DataFrame, text: str = "commentTxt") -> DataFrame:
    """Check the last comma-separated token of a comment against the words."""
    checked = words_exist(df.withColumn("_token", last_token(F.col(text))), words, "_token")
    violated = F.col("exists")
    return checked.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("info_consignee").alias("consignee"),
        F.col("ts_ms").cast("bigint").alias("ts_ms"),
        "ds",
        F.col(text).alias("msg"),
        violated.cast("int").alias("is_violation"),
        F.when(violated, GRADE).otherwise("").alias("violation_grade"),
        F.when(violated, F.col("_token")).otherwise("").alias("violation_msg"),
    )
