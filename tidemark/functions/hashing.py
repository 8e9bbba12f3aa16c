"""Polynomial string hashes with 32-bit arithmetic, as built-in expressions.

Both hashes fold ``h * seed + code_unit`` over the UTF-16 code units of a
string. Only the low bits are kept, and those are the same whether the
arithmetic wraps at 32 bits or is reduced by a modulus, so 64-bit arithmetic
with a modulus gives the exact value without overflow.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Multipliers and map size of the two hash functions.
STRING_HASH_SEED = 31
BITMAP_SEED = 61
BITMAP_BITS = 1 << 29

_WORD = 1 << 32
_SIGN = 1 << 31


def _units(text: Column) -> Column:
    """UTF-16 code units; plain characters when the text is all ASCII."""
    ascii_units = F.transform(
        F.filter(F.split(text, ""), lambda c: c != ""),
        lambda c: F.ascii(c).cast("long"),
    )
    wide = F.regexp_extract_all(
        F.hex(F.encode(text, "UTF-16BE")), F.lit("([0-9A-F]{4})"), F.lit(1)
    )
    wide_units = F.transform(wide, lambda u: F.conv(u, 16, 10).cast("long"))
    return F.when(F.length(text) == F.octet_length(text), ascii_units).otherwise(
        wide_units
    )


def polynomial(text: Column, seed: int, modulus: int) -> Column:
    return F.aggregate(
        _units(text),
        F.lit(0).cast("long"),
        lambda acc, unit: (acc * seed + unit) % modulus,
    )


def string_hash(text: Column, factor: int = 1) -> Column:
    """The 31-polynomial string hash times ``factor``, as a signed 32-bit int."""
    low = polynomial(text, STRING_HASH_SEED, _WORD)
    product = F.pmod(low * F.lit(factor % _WORD).cast("decimal(20,0)"), F.lit(_WORD))
    if factor == 1:
        product = low
    wrapped = product.cast("long")
    return F.when(wrapped >= _SIGN, wrapped - _WORD).otherwise(wrapped).cast("int")


def bit_offset(text: Column, bits: int = BITMAP_BITS, seed: int = BITMAP_SEED) -> Column:
    """The bit of a 2^k-bit map that a string falls on."""
    return polynomial(text, seed, bits)
