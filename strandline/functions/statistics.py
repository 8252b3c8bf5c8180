"""Statistical expressions over columns and aggregates."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def student_p(t: Column, df: Column) -> Column:
    """Two-sided p-value of Student's t for whole degrees of freedom, by the finite series in theta = atan(|t| / sqrt(df)).

    NULL below one degree of freedom.
    """
    df = df.cast("int")
    theta = F.atan(F.abs(t) / F.sqrt(df.cast("double")))
    c2, s, c = F.pow(F.cos(theta), F.lit(2.0)), F.sin(theta), F.cos(theta)
    odd = df % 2 == 1
    terms = F.when(odd, (df - 1) / 2).otherwise(df / 2).cast("int")
    zero = F.struct(F.when(odd, c).otherwise(F.lit(1.0)).alias("term"), F.lit(0.0).alias("sum"))

    def step(acc, k):
        # an odd series multiplies by 2k/(2k+1), an even one by (2k-1)/2k
        factor = F.when(odd, 2.0 * k / (2 * k + 1)).otherwise((2.0 * k - 1) / (2 * k))
        return F.struct((acc["term"] * factor * c2).alias("term"), (acc["sum"] + acc["term"]).alias("sum"))

    total = F.aggregate(F.when(terms >= 1, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>")), zero, step)["sum"]
    p = F.when(odd, 1 - (2 / math.pi) * (theta + s * total)).otherwise(1 - s * total)
    return F.when(df >= 1, F.greatest(F.lit(0.0), p))


def ols(x: Column, y: Column) -> dict[str, Column]:
    """Aggregates of a least-squares line: n, slope, intercept, sxx, syy, sxy over rows where both are known."""
    both = x.isNotNull() & y.isNotNull()
    return {
        "n": F.count(F.when(both, 1)),
        "slope": F.regr_slope(y, x),
        "intercept": F.regr_intercept(y, x),
        "sxx": F.regr_sxx(y, x),
        "syy": F.regr_syy(y, x),
        "sxy": F.regr_sxy(y, x),
    }


def ols_error(n: Column, sxx: Column, syy: Column, sxy: Column) -> Column:
    """Standard error of the slope; 0 for two points or an exact fit, NULL below."""
    free = (n - 2).cast("double")
    r2 = F.least(F.lit(1.0), sxy * sxy / F.nullif(sxx * syy, F.lit(0.0)))
    spread = F.sqrt(F.greatest(F.lit(0.0), (1 - F.coalesce(r2, F.lit(1.0))) * syy / F.nullif(sxx, F.lit(0.0)) / F.nullif(free, F.lit(0.0))))
    return F.when(n > 2, spread).when(n == 2, F.lit(0.0))


def ols_p(n: Column, slope: Column, error: Column, syy: Column) -> Column:
    """p-value of a slope of 0: 1 if y is constant, 0 if the fit is exact."""
    t = F.try_divide(slope, error)
    p = F.when(syy == 0, 1.0).when((n == 2) | (error == 0), 0.0).otherwise(student_p(t, n - 2))
    return F.when(n >= 2, p)


def circular(angle: Column, period: float = 180.0) -> tuple[Column, Column]:
    """Aggregates: circular mean in [0, period) and standard deviation of angles with a period."""
    turn = angle * (2 * math.pi / period)
    s, c = F.avg(F.sin(turn)), F.avg(F.cos(turn))
    length = F.least(F.lit(1.0), F.sqrt(s * s + c * c))
    mean = F.pmod(F.atan2(s, c) * (period / (2 * math.pi)), F.lit(period))
    return mean, F.sqrt(-2 * F.ln(length)) * (period / (2 * math.pi))
