"""Scalar rules on fires, detections, weather and risk."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds of the four lower risk levels and the level names.
RISK_BOUNDS = [0.2, 0.4, 0.6, 0.8]
RISK_LABELS = ["LOW", "MEDIUM_LOW", "MEDIUM", "MEDIUM_HIGH", "HIGH"]
# Eight compass points clockwise from north.
COMPASS = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"]


def kelvin_to_celsius(k: Column) -> Column:
    return k - F.lit(273.15)


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def compass8(degrees: Column) -> Column:
    """Nearest of eight directions, halves up."""
    i = F.floor(degrees / F.lit(45.0) + F.lit(0.5)).cast("int") % 8
    return F.get(F.array(*[F.lit(c) for c in COMPASS]), i)


def size_class(area_ha: Column) -> Column:
    return (
        F.when(area_ha <= 0, F.lit(None).cast("string"))
        .when(area_ha <= 10, "small").when(area_ha <= 100, "medium")
        .when(area_ha <= 1000, "large").when(area_ha > 1000, "mega")
    )


def log_area(area_ha: Column) -> Column:
    return F.log1p(area_ha)


def modis_confidence_band(v: Column) -> Column:
    return F.when(v <= 30, "l").when(v >= 70, "h").when(v.isNotNull(), "n")


def confidence_code(band: Column) -> Column:
    return F.when(band == "l", 1).when(band == "n", 2).when(band == "h", 3)


def daynight_code(flag: Column) -> Column:
    return F.when(flag == "D", 0).when(flag == "N", 1)


def risk_level(p: Column) -> Column:
    level = F.when(p < RISK_BOUNDS[0], 0)
    for i, bound in enumerate(RISK_BOUNDS[1:], start=1):
        level = level.when(p < bound, i)
    return level.when(p.isNotNull(), len(RISK_BOUNDS))


def risk_label(level: Column) -> Column:
    known = level.between(0, len(RISK_LABELS) - 1)
    return F.when(known, F.get(F.array(*[F.lit(x) for x in RISK_LABELS]), level)).otherwise("UNKNOWN")


def risk_factor(level: Column) -> Column:
    """Display convention: 1 is extreme, 5 very low."""
    return F.lit(5) - level


def risk_vectors(probabilities: Column, threshold: float = 0.5) -> Column:
    """All per-step outputs of a forecast row; burning means strictly above the threshold."""
    levels = F.transform(probabilities, risk_level)
    n = F.size(probabilities)
    mean = F.when(n > 0, F.aggregate(probabilities, F.lit(0.0), lambda a, p: a + p) / n)
    return F.struct(
        levels.alias("risk_levels"),
        F.transform(levels, risk_label).alias("risk_labels"),
        F.transform(levels, risk_factor).alias("risk_factor"),
        mean.alias("risk_score"),
        F.transform(probabilities, lambda p: p > F.lit(threshold)).alias("is_burning_predicted"),
    )


def first_horizon_factor(factors: Column) -> Column:
    """First step's factor, NULL unless it lies in 1..5."""
    first = F.get(factors, F.lit(0)).cast("int")
    return F.when(first.between(1, 5), first)
