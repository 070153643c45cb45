"""Exact sums and decimal rounding.

Sums run over decimals, so neither the order of rows nor the number of partitions can
move a result; one division to double comes last.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_avg(value: Column) -> Column:
    """Average of a decimal column as double; NULL for no rows."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def ratio_of(total: Column, n: Column) -> Column:
    """exact_avg from an already summed total and count."""
    return F.try_divide(total.cast("double"), n.cast("double"))


def round_half_even(value: Column, places: int) -> Column:
    """Round a double by its exact binary value, ties to even, as Python's round() does.

    Spark's round() goes through the shortest decimal text (2.675 -> 2.68, though the
    double is below the tie). Here value * 10^places is taken as product + error, both
    exact (the multiplier has few bits, so splitting the value in two halves suffices),
    and the error decides where the product looks like a tie.
    """
    scale = F.lit(float(10**places))
    product = value * scale
    carry = value * F.lit(134217729.0)  # 2^27 + 1 splits a double's 53 bits
    high = carry - (carry - value)
    low = value - high
    error = (high * scale - product) + low * scale
    nearest = F.rint(product)
    beyond = product - nearest
    corrected = (
        F.when((beyond == 0.5) & (error > 0), nearest + 1)
        .when((beyond == -0.5) & (error < 0), nearest - 1)
        .otherwise(nearest)
    )
    return corrected / scale + F.lit(0.0)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def sample_std(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from exact decimal moments."""
    spread = (n * squares - total * total).cast("double")
    return F.sqrt(F.try_divide(spread, (n * (n - 1)).cast("double")))
