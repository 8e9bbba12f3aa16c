"""Named functions for SQL, as SQL functions: their plans hold built-in expressions only."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.functions.hashing import STRING_HASH_SEED


def register_string_hash(spark: SparkSession, name: str, factor: int) -> None:
    """A scalar hash function for SQL, parameterised when it is registered.

    The same value as ``hashing.string_hash``.
    """
    word, sign = 1 << 32, 1 << 31
    units = """CASE WHEN length(text) = octet_length(text)
      THEN transform(filter(split(text, ''), c -> c <> ''), c -> cast(ascii(c) AS bigint))
      ELSE transform(regexp_extract_all(hex(encode(text, 'UTF-16BE')), '([0-9A-F]{4})', 1),
                     u -> cast(conv(u, 16, 10) AS bigint)) END"""
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS INT RETURN
        aggregate({units}, 0L, (h, unit) -> (h * {STRING_HASH_SEED} + unit) % {word}L,
          h -> cast(pmod(cast(h AS decimal(20, 0)) * {factor % word} + {sign}, {word}L)
                    - {sign} AS int))"""
    )


def register_splitter(spark: SparkSession, name: str, separator: str) -> None:
    """A table function for SQL: text to rows of (word, length).

    ``separator`` is plain text; trailing empty parts go, as in ``split_trimmed``.
    """
    one = "".join(f"\\\\{c}" if not c.isalnum() and c != " " else c for c in separator)
    one = one.replace("'", "\\'")
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING)
        RETURNS TABLE(word STRING, length INT) RETURN
        SELECT part, length(part) FROM (SELECT explode(
          CASE WHEN text RLIKE '^(?:{one})+$' THEN cast(array() AS array<string>)
          ELSE split(regexp_replace(text, '(?<!{one})(?:{one})+$', ''), '{one}') END) AS part)"""
    )
