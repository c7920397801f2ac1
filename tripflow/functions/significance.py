"""p-values as column expressions, meant for small result tables (one row per tested column)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SERIES_DEGREES = 10_000


def kolmogorov_sf(distance: Column, n_reference: Column, n_current: Column) -> Column:
    """Asymptotic two-sample Kolmogorov–Smirnov p-value."""
    size = n_reference.cast("double") * n_current / (n_reference + n_current)
    scaled = F.sqrt(size) * distance
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda total, k: total
        + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(F.lit(-2.0) * k * k * scaled * scaled),
    )
    # Below 0.2 the alternating series has not converged; the true value there is 1 to 12 digits.
    p = F.when(scaled < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series)))
    return F.when(distance.isNotNull(), p)


def _log_gamma_next(degrees: Column) -> Column:
    """ln Γ(degrees/2 + 1) for a whole number of degrees, by the recurrence from Γ(1) or Γ(1/2)."""
    half = degrees / F.lit(2.0)
    even = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.lit(1), (degrees / 2).cast("int"))), F.lit(0.0), lambda s, i: s + F.log(i)
    )
    odd = F.aggregate(
        F.sequence(F.lit(0), F.floor(half).cast("int")),
        F.lit(0.5 * math.log(math.pi)),
        lambda s, i: s + F.log(i + F.lit(0.5)),
    )
    return F.when(degrees % 2 == 0, even).otherwise(odd)


def chi_square_sf(statistic: Column, degrees: Column) -> Column:
    """P(χ² > statistic), at any number of degrees.

    Up to ``SERIES_DEGREES`` one minus the series of the regularised lower incomplete gamma function,
    whose length grows with the degrees; beyond, the cube root of χ² over its degrees is taken as normal,
    which is off by less than 1e-6 there.
    """
    z = _cube_root_z(statistic, degrees.cast("double"))
    # A normal tail is half of the two-sided one, which is the tail of a χ² with one degree.
    two_sided = _series_sf(z * z, F.lit(1))
    normal = F.when(z > 0, two_sided / 2.0).otherwise(1.0 - two_sided / 2.0)
    series = _series_sf(statistic, F.least(degrees, F.lit(SERIES_DEGREES)))
    return F.when(statistic.isNull() | (degrees <= SERIES_DEGREES), series).otherwise(F.when(statistic <= 0, 1.0).otherwise(normal))


def _cube_root_z(statistic: Column, degrees: Column) -> Column:
    spread = F.try_divide(F.lit(2.0), 9.0 * degrees)
    return F.try_divide(F.pow(F.try_divide(statistic, degrees), F.lit(1.0 / 3.0)) - 1.0 + spread, F.sqrt(spread))


def _series_sf(statistic: Column, degrees: Column) -> Column:
    degrees = degrees.cast("int")
    half_df, half_x = degrees / F.lit(2.0), statistic / F.lit(2.0)
    # Past this point the tail is below 1e-300.
    hopeless = half_x > half_df + 42.0 * F.sqrt(half_df) + 1000.0
    near = F.least(half_x, half_df + 42.0 * F.sqrt(half_df) + 1000.0)
    terms = F.ceil(near + 10.0 * F.sqrt(near) + 100.0).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] * near / (half_df + i)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    total = F.aggregate(F.sequence(F.lit(1), terms), start, step, lambda acc: acc["total"])
    log_lower = half_df * F.log(near) - near - _log_gamma_next(degrees) + F.log(total)
    p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1.0 - F.exp(log_lower)))
    return (
        F.when(statistic.isNull() | (degrees < 1), F.lit(None).cast("double"))
        .when(statistic <= 0, 1.0)
        .when(hopeless, 0.0)
        .otherwise(p)
    )


def two_sided_normal_p(z: Column) -> Column:
    return _series_sf(z * z, F.lit(1))
