"""Rounding and printing of doubles with 15 significant digits.

The measurements are doubles, the published values are decimals: a double is first
taken to 15 significant digits and then rounded half away from zero. The first step
also hides the last-bit noise a distributed sum picks up from its shuffle order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 15 significant digits in scientific form, the decimal wide enough to
# hold them for any magnitude below 1e15, and the shape of a decimal literal.
FIFTEEN_DIGITS = "0.00000000000000E0"
WIDE_DECIMAL = "decimal(38,22)"
DECIMAL_LITERAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
PLAIN_LIMIT = 1e15
TRAILING_ZEROS = r"\.?0+$"
# Magnitudes printed without an exponent: what 15 digits round to at least 0.0001 and to
# less than 1e15.
SMALLEST_PLAIN, LARGEST_PLAIN = 9.999999999999995e-05, 999999999999999.4


def _scientific(value: Column) -> Column:
    # DecimalFormat rounds the exact binary value; format_string('%.14e') rounds the
    # shortest decimal text of it, which is off by one in the last digit now and then.
    return F.call_function("format_number", value, F.lit(FIFTEEN_DIGITS))


def _rounded(value: Column, digits: int) -> Column:
    return F.round(_scientific(value).try_cast(WIDE_DECIMAL), digits)


def round_numeric(value: Column, digits: int) -> Column:
    """``value`` at 15 significant digits, rounded half away from zero, as a double."""
    value = value.cast("double")
    # From 1e15 on 15 digits leave no decimals to round. NaN and infinities stay.
    return F.when(
        F.abs(value) < F.lit(PLAIN_LIMIT), _rounded(value, digits).cast("double")
    ).otherwise(F.coalesce(_scientific(value).try_cast("double"), value))


def numeric_text(value: Column, digits: int) -> Column:
    """Text of :func:`round_numeric`, trailing zeros kept (``50.00``)."""
    value = value.cast("double")
    scientific = _scientific(value)
    mantissa = F.substring_index(scientific, "E", 1)
    exponent = F.substring_index(scientific, "E", -1).cast("int")
    whole = F.rpad(F.regexp_replace(mantissa, "[-.]", ""), exponent + 1, F.lit("0"))
    large = F.concat(
        F.when(value < 0, "-").otherwise(""),
        whole,
        F.lit("." + "0" * digits if digits else ""),
    )
    return (
        F.when(F.abs(value) < F.lit(PLAIN_LIMIT), _rounded(value, digits).cast("string"))
        .when(F.abs(value) < F.lit(float("inf")), large)
        .otherwise(value.cast("string"))
    )


def float_text(value: Column) -> Column:
    """Shortest text with at most 15 significant digits, e.g. ``50``, ``0.1``, ``5e-05``."""
    value = value.cast("double")
    scientific = _scientific(value)
    plain = F.regexp_replace(
        scientific.cast("decimal(38,19)").cast("string"), TRAILING_ZEROS, ""
    )
    exponent = F.substring_index(scientific, "E", -1).cast("int")
    size = F.abs(exponent).cast("string")
    raised = F.concat(
        F.regexp_replace(F.substring_index(scientific, "E", 1), TRAILING_ZEROS, ""),
        F.when(exponent < 0, "e-").otherwise("e+"),
        F.when(F.length(size) < 2, F.lpad(size, 2, "0")).otherwise(size),
    )
    return (
        F.when(F.isnan(value), "NaN")
        .when(value == 0, F.when(scientific.startswith("-"), "-0").otherwise("0"))
        .when(F.abs(value).between(SMALLEST_PLAIN, LARGEST_PLAIN), plain)
        .when(F.abs(value) < F.lit(float("inf")), raised)
        .otherwise(F.when(value > 0, "Infinity").when(value < 0, "-Infinity"))
    )


def is_numeric(text: Column) -> Column:
    """True for decimal literals and, as in the system replaced, for NULL."""
    return F.coalesce(text.rlike(DECIMAL_LITERAL), F.lit(True))
