"""Hex quantities as chain nodes print them (``0x`` + digits, any width)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_LIMB = 1_000_000_000  # decimal digits are carried in groups of nine
_CHUNK = 7  # hex digits folded in per step: limb * 16^7 stays far below 2^63


def _body(value: Column) -> Column:
    return F.regexp_replace(value, "^0x", "")


def _without_leading_zeros(digits: Column) -> Column:
    trimmed = F.ltrim(digits, F.lit("0"))
    return F.when(trimmed == "", F.lit("0")).otherwise(trimmed)


def hex_to_uint64(value: Column) -> Column:
    """decimal(20,0); NULL where the text is empty, not hex, or wider than 64 bits."""
    body = _body(value)
    digits = _without_leading_zeros(body)
    ok = body.rlike(r"^[0-9a-fA-F]+\z") & (F.length(digits) <= 16)
    return F.when(ok, F.conv(digits, 16, 10).cast("decimal(20,0)"))


def hex_to_timestamp(value: Column) -> Column:
    """Unix seconds in hex as a timestamp; NULL where unreadable or past year 9999."""
    seconds = hex_to_uint64(value)
    return F.when(
        seconds <= F.lit(253_402_300_799), F.timestamp_seconds(seconds.cast("bigint"))
    )


def _wide_hex_to_decimal(digits: Column) -> Column:
    """Base conversion for any width with nine-digit limbs, least significant first."""
    n_chunks = F.ceil(F.length(digits) / F.lit(_CHUNK)).cast("int")
    padded = F.lpad(digits, n_chunks * _CHUNK, "0")
    chunks = F.transform(
        F.sequence(F.lit(0), n_chunks - 1),
        lambda i: F.conv(F.substring(padded, i * _CHUNK + 1, F.lit(_CHUNK)), 16, 10).cast("bigint"),
    )

    def fold(limbs: Column, chunk: Column) -> Column:
        def carry_step(acc: Column, limb: Column) -> Column:
            v = limb * F.lit(16**_CHUNK) + acc["carry"]
            return F.struct(
                F.call_function("div", v, F.lit(_LIMB)).alias("carry"),
                F.array_append(acc["limbs"], v % F.lit(_LIMB)).alias("limbs"),
            )

        start = F.struct(chunk.alias("carry"), F.array().cast("array<bigint>").alias("limbs"))
        return F.aggregate(
            limbs,
            start,
            carry_step,
            lambda acc: F.when(
                acc["carry"] > 0, F.array_append(acc["limbs"], acc["carry"])
            ).otherwise(acc["limbs"]),
        )

    limbs = F.aggregate(chunks, F.array(F.lit(0).cast("bigint")), fold)
    text = F.array_join(
        F.transform(F.reverse(limbs), lambda v: F.lpad(v.cast("string"), 9, "0")), ""
    )
    return _without_leading_zeros(text)


def hex_to_decimal_string(value: Column) -> Column:
    """Decimal digits of a hex quantity of any width.

    Empty text is ``"0"``; NULL where the text is not hex. The limb
    conversion runs only for quantities wider than 124 bits.
    """
    body = _body(value)
    digits = _without_leading_zeros(F.regexp_replace(body, "^[+-]", ""))
    high = F.conv(F.substring(F.lpad(digits, 31, "0"), 1, 15), 16, 10).cast("decimal(19,0)")
    low = F.conv(F.substring(F.lpad(digits, 31, "0"), 16, 16), 16, 10).cast("decimal(20,0)")
    middle = (high * F.lit(Decimal(1 << 64)) + low).cast("decimal(38,0)")
    unsigned = (
        F.when(F.length(digits) <= 16, F.conv(digits, 16, 10))
        .when(F.length(digits) <= 31, middle.cast("string"))
        .otherwise(_wide_hex_to_decimal(digits))
    )
    signed = F.when(
        body.startswith("-") & (digits != "0"), F.concat(F.lit("-"), unsigned)
    ).otherwise(unsigned)
    return F.when(body == "", F.lit("0")).when(body.rlike(r"^[+-]?[0-9a-fA-F]+\z"), signed)
