"""Exact money arithmetic in decimal cents.

Money arrives as double.  Sums and ranks run on exact decimals, so the order of addition
(which differs with partitioning) cannot change a total or break a tie, and no amount is
cut: an amount counts with up to ten decimals (the shortest decimal text of its double),
not with two.  NaN, infinite amounts and amounts above ``LIMIT``, where a double no longer
resolves cents, fail the job; so does a sum that overflows, whatever the session's ANSI
setting.  ``cents_sql`` is the one rule; the DataFrame and the SQL formulation share it.

Sums take a short way for whole cents, which nearly all amounts are: those add up as 64-bit
integers, and only the rest as decimals.  ``floor(x * 100 + 0.5) / 100 = x`` holds exactly
for the doubles nearest to a whole number of cents.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMIT = 9e13
OVERFLOW = "money total overflows"
RANGE = "money amount overflows: not a number, infinite or above 9e13"

# cents with eight decimals; a sum has ten more digits before the point
CENTS = "decimal(26,8)"
TOTAL = "decimal(34,8)"


def cents_sql(c: str) -> str:
    """SQL text: money ``c`` (double) as exact cents, an error if out of range."""
    return (
        f"CASE WHEN isnan({c}) OR abs({c}) > {LIMIT:.0f} THEN CAST(raise_error('{RANGE}') AS {CENTS}) "
        f"ELSE CAST(CAST({c} AS DECIMAL(24,10)) * 100 AS {CENTS}) END"
    )


def sum_sql(c: str, kind: str = TOTAL) -> str:
    """SQL text, an aggregate: the sum of ``c`` as ``kind``; NULL for no input, an error on
    overflow in whatever ANSI mode."""
    return (
        f"CASE WHEN count({c}) > 0 AND try_cast(try_sum({c}) AS {kind}) IS NULL "
        f"THEN CAST(raise_error('{OVERFLOW}') AS {kind}) ELSE try_cast(try_sum({c}) AS {kind}) END"
    )


def total_sql(c: str) -> str:
    """SQL text, an aggregate: the exact sum of money ``c`` in cents, NULL for no input."""
    whole = f"floor({c} * 100 + 0.5D)"
    is_whole = f"(abs({c}) <= {LIMIT:.0f} AND {whole} / 100 = {c})"
    plain = sum_sql(f"CASE WHEN {is_whole} THEN CAST({whole} AS BIGINT) END")
    rest = sum_sql(f"CASE WHEN NOT {is_whole} THEN {cents_sql(c)} END")
    return (
        f"CASE WHEN count({c}) > 0 THEN CAST(coalesce({plain}, 0) + coalesce({rest}, 0) AS {TOTAL}) END"
    )


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(c: Column | str) -> Column:
    """Money (double) to exact cents (decimal)."""
    c = _col(c)
    bad = F.isnan(c) | (F.abs(c) > LIMIT)
    exact = (c.cast("decimal(24,10)") * F.lit(100)).cast(CENTS)
    return F.when(bad, F.raise_error(F.lit(RANGE)).cast(CENTS)).otherwise(exact)


def checked(c: Column) -> Column:
    """``c`` unless it is NULL, which here means an overflow: then fail the job."""
    return F.when(c.isNull(), F.raise_error(F.lit(OVERFLOW))).otherwise(c)


def _sum(c: Column, kind: str) -> Column:
    """Aggregate: sum as ``kind``; NULL for no input, an error on overflow."""
    s = F.try_sum(c).try_cast(kind)
    return F.when(s.isNull() & (F.count(c) > 0), F.raise_error(F.lit(OVERFLOW)).cast(kind)).otherwise(s)


def sum_cents(c: Column | str) -> Column:
    """Aggregate: exact sum of a cents column; NULL for no input, an error on overflow."""
    return _sum(_col(c), TOTAL)


def total(c: Column | str) -> Column:
    """Aggregate: exact sum of a money column, in cents; NULL for no input."""
    c = _col(c)
    whole = F.floor(c * 100 + F.lit(0.5))
    is_whole = (F.abs(c) <= LIMIT) & (whole.cast("double") / 100 == c)
    plain = _sum(F.when(is_whole, whole), TOTAL)
    rest = _sum(F.when(~is_whole, cents(c)), TOTAL)
    zero = F.lit(0).cast(TOTAL)
    both = (F.coalesce(plain, zero) + F.coalesce(rest, zero)).try_cast(TOTAL)
    return F.when(F.count(c) > 0, checked(both))


def as_double(c: Column | str) -> Column:
    """Cents back to a double amount (exact division, one final rounding)."""
    return (_col(c).cast(TOTAL) / F.lit(100)).cast("double")
