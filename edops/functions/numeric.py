"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Decimal numbers in text; a trailing type letter such as "1.5d" is not a number.
_NUMBER = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))$"


def rnd(value: Column, digits: int) -> Column:
    """Round half to even on the scaled double (the same result in any SQL engine)."""
    factor = float(10**digits)
    return F.rint(value.cast("double") * F.lit(factor)) / F.lit(factor)


def code_number(text: Column) -> Column:
    """Whole number in text; unparsable or negative (a missing code) becomes NULL."""
    number = text.try_cast("int")
    return F.when(number >= 0, number)


def scaled_number(text: Column, scale: int = 1) -> Column:
    """Implied-decimal number: ``0986`` with scale 10 is 98.6."""
    return code_number(text).cast("double") / F.lit(float(scale))


def real_number(text: Column) -> Column:
    """Real number in text; unparsable or negative becomes NULL."""
    number = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return F.when(number >= 0, number)


def first_non_zero(*values: Column) -> Column:
    """First value that is neither NULL nor 0, else 0."""
    return F.coalesce(*[F.nullif(v.cast("double"), F.lit(0.0)) for v in values], F.lit(0.0))


def safe_ratio(part: Column, whole: Column, digits: int) -> Column:
    """Rounded ``part / whole``, NULL when ``whole`` is 0."""
    return rnd(F.try_divide(part, F.nullif(whole, F.lit(0.0))), digits)
