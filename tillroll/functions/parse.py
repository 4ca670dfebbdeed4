"""Per-field parsers as Column expressions.

The input files carry money as loosely formatted text (``$1,449``, ``4995``, empty),
timestamps as ``MM/dd/yyyy HH:mm:ss`` and quantities as integers. Every parser here is a
plain Catalyst expression, so parsing stays inside whole-stage codegen and never starts a
Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The money cleaner keeps ASCII digits and the dot, nothing else.
MONEY_DROP = r"[^0-9.]+"
# Accepted timestamp layout, month/day/year hour:minute:second,
# one or two digits for every part except the four-digit year.
TIMESTAMP_LAYOUT = r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}:\d{1,2}:\d{1,2})$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str, signed: bool = False) -> Column:
    """Text to double: keep digits and dots, cast, 0.0 when empty or not a number.

    As in the reference, a minus sign or accounting parentheses are dropped with the other
    characters, so ``-5`` gives 5.0. ``signed=True`` keeps the sign for those two forms.
    """
    c = _col(c)
    value = F.coalesce(
        F.regexp_replace(c, MONEY_DROP, "").try_cast("double"), F.lit(0.0)
    )
    if not signed:
        return value
    negative = F.coalesce(c.rlike(r"^\s*(-|\()"), F.lit(False))
    # a sign factor keeps ``value`` outside CASE branches, so it is evaluated once
    sign = F.when(negative, F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.when(value == 0.0, value).otherwise(value * sign)


def timestamp(c: Column | str) -> Column:
    """``M/d/yyyy H:m:s`` text to ``timestamp_ntz``; NULL when the text does not parse.

    Zone-free: the wall clock in the file is the value, whatever the session time zone.
    Out-of-range parts (month 13, second 60) give NULL instead of rolling over.
    """
    c = _col(c)
    # one expression: the layout's parts in ISO order, then a cast that checks each part
    iso = F.regexp_replace(c, TIMESTAMP_LAYOUT, "$3-$1-$2 $4")
    return F.when(c.rlike(TIMESTAMP_LAYOUT), iso).try_cast("timestamp_ntz")


def integer(c: Column | str) -> Column:
    """Text to int; NULL for empty or non-numeric text (the caller decides if that is bad)."""
    return _col(c).try_cast("int")


def is_bad_integer(c: Column | str) -> Column:
    """True when the text is non-empty but not an integer."""
    c = _col(c)
    return (F.length(c) > 0) & integer(c).isNull()


def format_timestamp(c: Column | str, padded: bool = True) -> Column:
    """``timestamp_ntz`` back to the file layout (``MM/dd/yyyy HH:mm:ss``, or unpadded).

    Built from the calendar parts, which read the wall clock directly: ``date_format``
    would go through the session time zone and shift times that zone skips.
    """
    c = _col(c)

    def part(x: Column, width: int) -> Column:
        text = x.cast("string")
        return F.lpad(text, width, "0") if padded else text

    return F.concat(
        part(F.month(c), 2), F.lit("/"), part(F.dayofmonth(c), 2), F.lit("/"),
        F.lpad(F.year(c).cast("string"), 4, "0"), F.lit(" "),
        part(F.hour(c), 2), F.lit(":"), part(F.minute(c), 2), F.lit(":"),
        part(F.second(c), 2),
    )
