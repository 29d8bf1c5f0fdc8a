"""Number expressions. Division by zero and unreadable text give NULL, never NaN."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``; NULL when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def sum_then_rate(parts: Sequence[Column], denominator: Column) -> Column:
    """The sum of ``parts`` over ``denominator``; NULL when a part is NULL."""
    total = parts[0].cast("double")
    for part in parts[1:]:
        total = total + part.cast("double")
    return ratio(total, denominator)


def coerce_numeric(column: Column) -> Column:
    """The number a text holds; NULL for other text and for NaN."""
    number = column.try_cast("double")
    return F.when(~F.isnan(number), number)


def strip_thousands(text: Column) -> Column:
    """Text without thousands separators."""
    return F.translate(text, ",", "")


def percent_to_ratio(text: Column) -> Column:
    """``'70.50%'`` gives 0.705."""
    return F.translate(text, "%", "").try_cast("double") / F.lit(100.0)


def trunc_decimals(column: Column, digits: int = 3) -> Column:
    """Cut toward zero after ``digits`` decimals."""
    scale = F.lit(float(10 ** digits))
    return F.signum(column) * F.floor(F.abs(column) * scale) / scale


def clip(column: Column, lower: float = 0.0, upper: float = 1.0) -> Column:
    """Limit to [lower, upper]; NULL stays NULL."""
    limited = F.greatest(F.lit(float(lower)), F.least(F.lit(float(upper)), column))
    return F.when(column.isNotNull(), limited)


def argmax(*columns: Column) -> Column:
    """The position (from 0) of the largest column; the first one on a tie."""
    values = F.array(*columns)
    return (F.array_position(values, F.array_max(values)) - F.lit(1)).cast("int")


def choose_greater(first: Column, second: Column) -> Column:
    """0 when ``first`` is greater, otherwise 1 (also on a tie)."""
    return F.when(first > second, F.lit(0)).otherwise(F.lit(1))


def equality_label(left: Column, right: Column) -> Column:
    """1 when equal, else 0; a NULL on either side counts as not equal."""
    return F.coalesce((left == right).cast("int"), F.lit(0))
