"""Percentages, rates and rounding."""

from pyspark.sql import Column, functions as F

_SPLIT = float(2 ** 27 + 1)  # cuts a double into two halves whose products are exact
_LARGE = float(2 ** 45)  # from here on a hundredth is finer than a double's spacing or close to it


def round_scaled(value: Column, scale: int) -> Column:
    """Scale, round half to even, scale back: what array libraries do."""
    factor = F.lit(float(10 ** scale))
    return F.rint(value * factor) / factor


def round_exact(value: Column, scale: int) -> Column:
    """Round the double's exact value, half to even: what ``round`` does on a Python float.

    2.675 is a little less than its text says, so it becomes 2.67. The product with the power of ten is kept
    as rounded product plus exact error, and the error decides where the rounded product looks like a tie.
    """
    factor = F.lit(float(10 ** scale))
    product = value * factor
    big = value * _SPLIT
    high = big - (big - value)
    error = (high * factor - product) + (value - high) * factor
    whole = F.floor(product).cast("double")
    rest = product - whole
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & (F.pmod(whole, F.lit(2.0)) == 1))))
    return F.when(F.abs(value) < _LARGE, (whole + up.cast("double")) / factor).otherwise(value)


def rate(part: Column, whole: Column) -> Column:
    """Unrounded percentage, null where the whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    """Rounded percentage, null where the whole is 0."""
    return round_scaled(rate(part, whole), scale)


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))
