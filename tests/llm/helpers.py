"""Small tables and plain brute-force versions for the operators' tests."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SF_DIR = "/root/testdata/sf0.001"


def documents(spark: SparkSession, texts: list[tuple[int | None, str | None]], extra: str = "") -> DataFrame:
    """A table of documents; ``extra`` names one more column, such as one an operator adds."""
    rows = [(i, t, "en", "src", len(t or "")) + (("kept",) if extra else ()) for i, t in texts]
    schema = "doc_id long, text string, lang string, source string, n_chars long" + (f", {extra} string" if extra else "")
    return spark.createDataFrame(rows, schema)


def spaced_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower_ascii(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


ODD_TEXTS = [
    None, "", " \n\t ", "one", "one two three", "Ärger über ÉTÉ ÉTÉ", "a\x0bb\x0cc\rd", "x" * 5000, "word " * 3000, "line one\n" * 40,
    "a a", "don't 'S ''s <|endoftext|> é ́x İstanbul ΑΣ", "\U0001f600\U0001f600 ok", "1 2 3 ½ １２",
]
