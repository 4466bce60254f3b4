"""Numbers that may be missing, vectors and calibration, as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Coefficients of the perceptual scores' calibration, highest power first.
CALIBRATION = {
    "sig": (-0.08397278, 1.22083953, 0.0052439),
    "bak": (-0.13166888, 1.60915514, -0.39604546),
    "ovrl": (-0.06766283, 1.11546468, 0.04602535),
}


def finite(value: Column) -> Column:
    """The value as a double, or null where it is null, NaN or infinite."""
    number = value.cast("double")
    return F.when(number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf")), number)


def polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    """Horner's rule, highest power first."""
    total = F.lit(float(coefficients[0]))
    for c in coefficients[1:]:
        total = total * x + F.lit(float(c))
    return total


def dot(a: Column, b: Column) -> Column:
    pairs = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    """Cosine within -1 to 1; null for a zero vector."""
    value = F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: mean of finite values by positive finite weights; null if there are none."""
    v, w = finite(value), finite(weight)
    good = v.isNotNull() & (w > 0)
    return F.try_divide(F.sum(F.when(good, v * w)), F.sum(F.when(good, w)))


def rate_warning(source: Column, target: Column) -> Column:
    """What converting a sample rate loses or can't restore; null if the rates are equal."""
    up = F.format_string("upsampling from %d Hz to %d Hz does not restore missing bandwidth", source, target)
    down = F.format_string("downsampling from %d Hz to %d Hz keeps content below %s Hz", source, target, (target / 2).cast("long").cast("string"))
    return F.when(source < target, up).when(source > target, down)
