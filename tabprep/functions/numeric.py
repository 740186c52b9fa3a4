"""Recognizing and coercing numbers in text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number in text.  The guard keeps engine-specific
# spellings out (`1d`, `0x10`, `1_000`), and is cheap: no exception per bad value.
NUMBER_PATTERN = (
    r"\A\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*\z"
    r"|\A[+-]?(?i:inf|infinity)\z"
)
INTEGER_PATTERN = r"\A\s*[+-]?[0-9]+\s*\z"
# Spellings of truth values in untyped text.
BOOLEANS = ("True", "TRUE", "true", "False", "FALSE", "false")


def _may_be_number(c: Column) -> Column:
    """Cheap test of the first character (digit, sign, dot, space, or the i of infinity).

    Plain comparisons settle most words, so the regex runs on few of them.
    """
    return (
        (c < ":") | ((c >= "I") & (c < "J")) | ((c >= "i") & (c < "j"))
    )


def looks_numeric(c: Column) -> Column:
    return _may_be_number(c) & c.rlike(NUMBER_PATTERN)


def looks_boolean(c: Column) -> Column:
    return c.isin(*BOOLEANS)


def text_to_double(c: Column) -> Column:
    """Parsed value, or null where the text is no number."""
    return F.when(looks_numeric(c), c.try_cast("double"))


def text_to_long(c: Column) -> Column:
    """Parsed value, or null where the text is no 64-bit integer."""
    return F.when((c < ":") & c.rlike(INTEGER_PATTERN), c.try_cast("bigint"))


#: Whole numbers beyond this are not all exact as floating-point numbers.
EXACT_WHOLE = 2**53
#: The widest type of whole numbers, with 38 digits.
WIDE = "decimal(38,0)"


def long_digits(c: Column) -> Column:
    """Whole numbers of enough characters to be beyond ``EXACT_WHOLE``; a cheap test settles most values."""
    return (F.char_length(c) >= len(str(EXACT_WHOLE))) & (c < ":") & c.rlike(INTEGER_PATTERN)


def long_whole(c: Column) -> Column:
    """Whole numbers that a floating-point number may not hold."""
    value = c.try_cast(WIDE)
    return long_digits(c) & (value.isNull() | (F.abs(value) > F.lit(EXACT_WHOLE)))


def beyond_long(c: Column) -> Column:
    """Whole numbers that are no 64-bit integer."""
    return long_digits(c) & c.try_cast("bigint").isNull()


def beyond_wide(c: Column) -> Column:
    """Whole numbers with more digits than any number type has."""
    return long_digits(c) & c.try_cast(WIDE).isNull()


def text_to_wide(c: Column) -> Column:
    """Parsed value, or null where the text is no whole number of at most 38 digits."""
    return F.when((c < ":") & c.rlike(INTEGER_PATTERN), c.try_cast(WIDE))


def fill_number(c: Column, dtype: str, fill: float = 0) -> Column:
    """Replace null (and NaN for floating types) by ``fill``, keeping the type."""
    value = F.lit(fill).cast(dtype)
    if dtype in ("double", "float"):
        c = F.nanvl(c, value)
    return F.coalesce(c, value)
