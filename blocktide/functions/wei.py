"""Exact sums of decimal-digit amounts that outgrow decimal(38).

Amounts of up to 26 characters, practically all of them, go straight into a
decimal sum; 10^12 of the largest still fit. Longer ones are split into three
26-digit limbs (78 digits, the width of a 256-bit number) that are summed
apart and carried once per group. Digits beyond that are summed as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DIGITS = 26
_BASE = f"1{'0' * _DIGITS}BD"

PARTS = ("wei_small", "wei_lo", "wei_mid", "wei_hi", "wei_beyond")


def with_parts(rows: DataFrame, column: str = "value_wei") -> DataFrame:
    """Replace the amount by its addends ``PARTS``; NULL where a part does not apply.

    Text that is not an optionally signed run of digits adds nothing. The rare
    long amounts go through array functions, which keeps the generated code of
    the common path small enough to be compiled.
    """
    kept = [c for c in rows.columns if c != column]
    long_digits = "ltrim('0', regexp_replace(_text, '^[+-]', ''))"
    # Most significant limb first; NULL limbs for text of more than three limbs.
    limbs = f"""
        transform(array(0, 1, 2), i ->
            if(length({long_digits}) <= {3 * _DIGITS},
               cast(try_cast(substring(lpad({long_digits}, {3 * _DIGITS}, '0'),
                                       i * {_DIGITS} + 1, {_DIGITS}) as decimal({_DIGITS}, 0))
                    * if(startswith(_text, '-'), -1, 1) as decimal(38, 0)),
               null))"""
    beyond = f"""
        transform(array(_text), t ->
            if(length({long_digits}) > {3 * _DIGITS}, try_cast(t as double), null))"""
    return rows.selectExpr(
        *kept, f"if({column} rlike '^[+-]?[0-9]+\\\\z', {column}, null) AS _text"
    ).selectExpr(
        *kept,
        f"length(_text) > {_DIGITS} AS _wide",
        "if(_wide, null, try_cast(_text as decimal(38, 0))) AS wei_small",
        f"if(_wide, {limbs}, null) AS _limbs",
        f"if(_wide, {beyond}, null) AS _beyond",
        "get(_limbs, 2) AS wei_lo",
        "get(_limbs, 1) AS wei_mid",
        "get(_limbs, 0) AS wei_hi",
        "get(_beyond, 0) AS wei_beyond",
    ).select(*kept, *PARTS)


def sum_parts() -> list[Column]:
    return [F.sum(name).alias(name) for name in PARTS]


def with_totals(sums: DataFrame) -> DataFrame:
    """Replace summed ``PARTS`` by ``wei_exact`` (digits) and ``wei_value`` (nearest double).

    ``wei_exact`` is NULL where a double had to step in. Limbs are carried one
    after the other, each alias building on the ones before it; a negative
    total shows the digits of its magnitude.
    """
    kept = [c for c in sums.columns if c not in PARTS]
    dec = "decimal(38, 0)"
    return sums.selectExpr(
        *kept,
        "wei_beyond",
        "wei_mid IS NULL AS _narrow",
        f"cast(coalesce(wei_small, 0) + coalesce(wei_lo, 0) as {dec}) AS _low",
        f"cast(pmod(_low, {_BASE}) as {dec}) AS _r0",
        f"""cast(coalesce(wei_mid, 0)
            + cast(cast(_low - _r0 as {dec}) / {_BASE} as {dec}) as {dec}) AS _mid""",
        f"cast(pmod(_mid, {_BASE}) as {dec}) AS _r1",
        f"""cast(coalesce(wei_hi, 0)
            + cast(cast(_mid - _r1 as {dec}) / {_BASE} as {dec}) as {dec}) AS _top""",
        "_top < 0 AS _negative",
        "if(_negative AND _r0 > 0, 1, 0) AS _b0",
        f"if(_negative, cast(_b0 * {_BASE} - _r0 as {dec}), _r0) AS _m0",
        "if(_negative AND _r1 + _b0 > 0, 1, 0) AS _b1",
        f"if(_negative, cast(_b1 * {_BASE} - _r1 - _b0 as {dec}), _r1) AS _m1",
        f"if(_negative, cast(-_top - _b1 as {dec}), _top) AS _m2",
        f"""ltrim('0', concat(_m2, lpad(cast(_m1 as string), {_DIGITS}, '0'),
                              lpad(cast(_m0 as string), {_DIGITS}, '0'))) AS _digits""",
        """CASE WHEN wei_beyond IS NOT NULL THEN null
                WHEN _narrow THEN cast(_low as string)
                WHEN _digits = '' THEN '0'
                ELSE concat(if(_negative, '-', ''), _digits) END AS wei_exact""",
        f"""coalesce(cast(wei_exact as double),
                     wei_beyond + cast(_low as double)
                     + cast(coalesce(wei_mid, 0) as double) * 1e{_DIGITS}D
                     + cast(coalesce(wei_hi, 0) as double) * 1e{2 * _DIGITS}D) AS wei_value""",
    ).select(*kept, "wei_exact", "wei_value")
