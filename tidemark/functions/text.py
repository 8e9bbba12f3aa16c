"""Splitting and tokenising."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_trimmed(text: Column, pattern: str) -> Column:
    """Split, dropping trailing empty parts but keeping leading and inner ones.

    A text without any match stays whole, even when it is empty. ``pattern`` matches
    one separator of bounded length. Separators at the end go first, so that the
    text is split only once.
    """
    trimmed = F.regexp_replace(text, f"(?<!{pattern})(?:{pattern})+$", "")
    none = F.array().cast("array<string>")
    return F.when(text.rlike(f"^(?:{pattern})+$"), none).otherwise(F.split(trimmed, pattern))


def words(df: DataFrame, column: str, pattern: str = r"\s", name: str = "word") -> DataFrame:
    """One row per token; one whitespace character separates tokens by default."""
    return df.select(
        *[c for c in df.columns if c != column],
        F.explode(split_trimmed(F.col(column), pattern)).alias(name),
    )


def words_with_length(df: DataFrame, column: str, separator: str) -> DataFrame:
    """The row with each of its parts and the part's length."""
    parts = split_trimmed(F.col(column), separator)
    return df.select("*", F.explode(parts).alias("word")).withColumn(
        "length", F.length("word")
    )
