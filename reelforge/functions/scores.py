"""Calibrations of raw quality measures to 0..100, and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (h, a, s, x0, w) of the measures' sigmoids h * (a + s * sigmoid((x - x0) / w)).
SIGMOIDS = {
    "sharpness": (1.0, -14.0, 115.0, -20.0, 15.0),
    "compression": (1.0, -0.0278, 103.0, 0.3308, 0.092),
    "expression": (100.0, 0.0, 1.0, -5000.0, 5000.0),
}
# Thresholds and slope of the head covering measure.
COVERING = (0.0, 0.95, 0.02, 0.1)


def logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def clipped(x: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def unified_face_score(magnitude: Column, middle: float = 23.0, width: float = 2.6) -> Column:
    return logistic((magnitude - middle) / width) * 100


def measure_quality(x: Column, measure: str) -> Column:
    h, a, s, x0, w = SIGMOIDS[measure]
    return clipped((logistic((x - x0) / w) * s + a) * h)


def covering_quality(share: Column) -> Column:
    """100 for a bare head, 0 for a covered one, a logistic step between the thresholds."""
    low, high, middle, width = COVERING
    step = 1 / (1 + F.exp((share - middle) / width))
    top, bottom = 1 / (1 + F.exp(F.lit((low - middle) / width))), 1 / (1 + F.exp(F.lit((high - middle) / width)))
    return F.when(share <= low, F.lit(100.0)).when(share >= high, F.lit(0.0)).otherwise((step - bottom) / (top - bottom) * 100)


def pose_quality(degrees: Column) -> Column:
    c = F.greatest(F.cos(F.radians(degrees)), F.lit(0.0))
    return F.rint(c * c * 100).cast("long")


def occlusion_quality(mask: Column) -> Column:
    return F.rint(F.aggregate(mask, F.lit(0.0), lambda s, x: s + F.when(x >= 0, 1.0).otherwise(0.0)) / F.size(mask) * 100).cast("long")


def band(score: Column) -> Column:
    return F.when(score >= 70, "green").when(score >= 40, "amber").otherwise("red")


def documented_band(score: Column) -> Column:
    """Thirds of the scale, as the documents tell them."""
    return F.when(score <= 33, "low").when(score <= 66, "middle").otherwise("high")


def palette(number: Column, colours: int = 8) -> Column:
    return F.pmod(number, F.lit(colours)).cast("long")


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation of two arrays, member by member; null for constant ones."""
    n = F.size(a)

    def mean(c: Column) -> Column:
        return F.aggregate(c, F.lit(0.0), lambda s, x: s + x) / n

    ma, mb = mean(a), mean(b)
    pairs = F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y")))

    def total(f) -> Column:
        return F.aggregate(pairs, F.lit(0.0), lambda s, p: s + f(p["x"] - ma, p["y"] - mb))

    xy, xx, yy = total(lambda x, y: x * y), total(lambda x, y: x * x), total(lambda x, y: y * y)
    return F.try_divide(xy, F.sqrt(xx * yy))
