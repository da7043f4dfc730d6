"""Exact-decimal and seeded-draw expressions.

Money is DECIMAL(22,2) in storage and DECIMAL(38,2) after aggregation; it is
never a double inside the library (registered jobs turn exact amounts into
doubles only at their output edge, see ``plans.registry.present``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(22, 2)
MONEY_SUM = DecimalType(38, 2)
# widest amount whose product with a DECIMAL(10,6) rate stays exact (26 + 10 + 1 <= 38 digits)
MONEY_WIDE = DecimalType(26, 2)
RATE = DecimalType(10, 6)


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def dec(value, precision: int, scale: int) -> Column:
    """A decimal literal of an exact, narrow type (``F.lit(0.8)`` would be double)."""
    return F.lit(Decimal(str(value))).cast(DecimalType(precision, scale))


def money(c) -> Column:
    """``CAST(x AS DECIMAL(22,2))`` — rounds half away from zero."""
    return _c(c).cast(MONEY)


def safe_ratio(num, den, digits: int = 6) -> Column:
    """num / den as a double rounded to ``digits``; NULL when den is 0 or NULL."""
    n = _c(num).cast("double")
    d = _c(den).cast("double")
    return F.round(n / F.nullif(d, F.lit(0.0)), digits)


def seeded_digest(seed, *keys) -> Column:
    """md5 hex of 'seed|k1|k2..' — one digest can feed several independent draws.

    Replaces the non-repeatable ``ABS(CHECKSUM(NEWID()))`` of the source model;
    identical in any engine with md5 and hex parsing.
    """
    parts = [F.lit(str(seed))] + [_c(k).cast("string") for k in keys]
    return F.md5(F.concat_ws("|", *parts))


def _word(digest: Column, slot: int) -> Column:
    """The ``slot``-th 32-bit word of a hex digest as a non-negative bigint."""
    return F.conv(F.substring(digest, 1 + 8 * slot, 8), 16, 10).cast("bigint")


def seeded_draw(seed, *keys, modulus) -> Column:
    """Repeatable integer in [0, modulus) from the first word of the digest."""
    return (_word(seeded_digest(seed, *keys), 0) % F.lit(modulus)).cast("int")


def draw_from(digest: Column, slot: int, span) -> Column:
    """Centered draw in [-span/2, span/2 - 1] from one word of a digest (the source noise shape)."""
    span_c = F.lit(span) if isinstance(span, int) else span
    half = F.lit(span // 2) if isinstance(span, int) else F.floor(span / 2).cast("int")
    return (_word(digest, slot) % span_c).cast("int") - half
