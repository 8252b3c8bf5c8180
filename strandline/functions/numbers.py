"""Numeric expressions: missing values are NULL, never NaN, and a division never fails."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nan_to_null(df: DataFrame, *columns: str) -> DataFrame:
    """NaN becomes NULL in the named columns, or in all floating-point ones."""
    names = columns or [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in names})


def ratio(a: Column, b: Column) -> Column:
    """a / b; NULL where b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def normalised_difference(a: Column, b: Column) -> Column:
    """(a - b) / (a + b), the form of all two-band indices."""
    return ratio(a - b, a + b)


def tidy(value: Column, digits: int) -> Column:
    """Rounded half to even, without a negative zero."""
    return F.bround(value, digits) + F.lit(0.0)


def half_even(value: Column, digits: int) -> Column:
    """Rounded half to even in floating point, as NumPy's ``round`` and DuckDB's ``round_even`` do: scaled, rounded, scaled back.

    ``bround`` rounds the shortest text of a double instead; 33.535 * 100 is 3353.4999999999995, no tie, though its text looks like one.
    Values too large to scale stay as they are.
    """
    scale = F.lit(10.0**digits)
    return F.when(F.abs(value) < 1e300, F.rint(value * scale) / scale).otherwise(value)


def polynomial(x: Column, *coefficients: float) -> Column:
    """c0 + c1 x + c2 x² + … in Horner form."""
    return reduce(lambda acc, c: acc * x + F.lit(c), reversed(coefficients[:-1]), F.lit(coefficients[-1]))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it.

    A Column used twice is a tree copied twice; formulas that reuse long intermediate results would grow exponentially.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
